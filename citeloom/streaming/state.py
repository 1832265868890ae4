"""Incremental maintenance as Structured Streaming; batch functions do the merging."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeloom.operators.keep import upsert
from citeloom.sources.files import exists
from citeloom.sources.sinks import replace


def source(spark: SparkSession, folder: str, glob: str, schema, kind: str = "parquet") -> DataFrame:
    """A stream of the files that appear in a folder."""
    return spark.readStream.format(kind).schema(schema).option("pathGlobFilter", glob).load(folder)


def keep_current(stream: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str, eligible: Callable[[], DataFrame] | None = None) -> StreamingQuery:
    """Keep the newest row of every key in a table. Replayed batches change nothing, as the merge is idempotent."""

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        current = spark.read.parquet(path) if exists(spark, path) else batch.limit(0)
        replace(upsert(current, batch, keys, order, eligible() if eligible else None), path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def snapshots(stream: DataFrame, path: str, keys: list[str], time: str, checkpoint: str, late: str = "30 days") -> StreamingQuery:
    """Append dated snapshots once per key and time; the watermark bounds what is remembered."""
    once = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicates([*keys, time])
    return once.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """An extension: counts per tumbling window and group."""
    t = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return t.groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))
