"""What the operators of this subpackage share: cutting lineage, bounded broadcasts and shipping of Python functions."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.lineage import cut, shared_dir, sweep

__all__ = ["BROADCAST_BYTES", "bounded", "by_value", "cut", "key128", "share", "shared_dir", "sweep"]

#: The most bytes a table may have, by its own count, to be broadcast.
BROADCAST_BYTES = 32 << 20


def by_value(module) -> None:
    """Functions of this module travel to the executors with their code, so no executor needs the package installed."""
    cloudpickle.register_pickle_by_value(module)


def share(spark: SparkSession, value):
    """A broadcast of an object together with the code of its class; pickle.loads(share.value) gives it back."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast df only if its counted rows times row_bytes stay below BROADCAST_BYTES; else leave the join to the planner."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def key128(*cols: Column) -> Column:
    """A 128-bit key of the columns as a struct of two longs."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(7919), *cols).alias("b"))
