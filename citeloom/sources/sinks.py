"""Writing tables: fixed columns, JSON, swap on success, manifest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def replace(df: DataFrame, path: str, kind: str = "parquet", **options) -> None:
    """Write beside the target, then swap: readers see the old table or the new one, and df may read the old one."""
    spark = df.sparkSession
    fresh, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    df.write.format(kind).options(**options).save(fresh)
    fs, target = _fs(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(old)
    if fs.exists(target):
        fs.rename(target, aside)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(fresh), target):
        fs.rename(aside, target)
        raise OSError(f"{path} could not be replaced")
    fs.delete(aside, True)


def csv(df: DataFrame, path: str, columns: list[str]) -> None:
    replace(df.select(*columns), path, "csv", header="true", quote='"', escape='"')


def json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    if append:
        df.write.mode("append").json(path)
    else:
        replace(df, path, "json")


def no_nan(df: DataFrame) -> DataFrame:
    """df with NaN and infinities as null, as JSON has neither."""
    for c, t in df.dtypes:
        if t in ("double", "float"):
            df = df.withColumn(c, F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)))
    return df


def manifest(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(file, n_bytes, sha256) of a folder's files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    return files.select(F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def download_status(code: F.Column, content: F.Column, limit: int = 100 << 20) -> F.Column:
    """What a download is: downloaded, too_large, not_pdf, http_N or network."""
    head = F.substring(content, 1, 5)
    return F.when(code.isNull(), "network").when(code != 200, F.concat(F.lit("http_"), code.cast("string"))).when(F.octet_length(content) > limit, "too_large").when(head == F.lit(b"%PDF-"), "downloaded").otherwise("not_pdf")
