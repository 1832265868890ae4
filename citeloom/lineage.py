"""Cutting lineage: tables written to the folder that all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="citeloom-")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only on a single machine whose session names none (tests). Raises on a cluster without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_dir()


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/citeloom/{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it again: lineage ends here and lost executors cost nothing."""
    path = f"{_run_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Delete the tables this application has written; call it when no result that rests on them is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
