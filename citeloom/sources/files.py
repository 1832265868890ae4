"""Reading files: tables with fixed schemas, logs, documents, PDF and DOCX."""

from __future__ import annotations

import io
import json
import shutil
import subprocess
import sys
import tempfile
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citeloom.operators.keep import latest

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p)) if any(c in path for c in "*?[{") else bool(fs.exists(p))


def csv(spark: SparkSession, path: str, schema: StructType | str, required: bool = False) -> DataFrame:
    """A CSV table with quoted cells, line breaks in cells and a header; '' is null, all-blank rows go.

    A missing file is an empty table unless required.
    """
    if not required and not exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False, emptyValue=None, nullValue="")
    return df.dropna(how="all")


def json_log(spark: SparkSession, path: str, schema: StructType | str, key: str, sequence: str) -> DataFrame:
    """An append-only JSON-lines log: malformed lines and lines without key are skipped, the last line of a key wins."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    s = spark.createDataFrame([], schema).schema.add("_corrupt_record", "string")
    rows = spark.read.schema(s).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    return latest(rows.where(f"_corrupt_record is null and {key} is not null").drop("_corrupt_record"), [key], [sequence])


def json_document(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON document (or array) per file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def sheet(rows: DataFrame, required: list[str]) -> DataFrame:
    """A table read from a spreadsheet export: required columns must be there, blank rows go."""
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return rows.dropna(how="all")


def binaries(spark: SparkSession, folder: str, glob: str, limit: int | None = None) -> DataFrame:
    """(path, content) of a folder's files in the order of their names; lock files (~$) are skipped."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).where(~F.substring_index("path", "/", -1).startswith("~$")).select("path", "content")
    return df.orderBy("path").limit(limit) if limit else df


def pdf_pages(files: DataFrame) -> DataFrame:
    """(path, page, text) of PDF files by the pdftotext tool, which must be on the executors."""

    def scan(batches):
        tool = shutil.which("pdftotext")
        if not tool:
            raise RuntimeError("pdftotext is required to read PDF files")
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
                    f.write(content)
                    f.flush()
                    text = subprocess.run([tool, "-layout", "-enc", "UTF-8", f.name, "-"], check=True, capture_output=True).stdout.decode("utf-8", "replace")
                rows += [(path, n, page) for n, page in enumerate(text.split("\f"), 1)]
            yield pd.DataFrame(rows, columns=["path", "page", "text"])

    return files.mapInPandas(scan, "path string, page int, text string")


def docx_rows(content: bytes) -> list[tuple[int, str, str, bool, str]]:
    """(idx, text, style, bold, source) of a DOCX file's paragraphs and table rows, in document order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body")
    tidy = lambda s: " ".join(s.replace("­", "").split())
    text = lambda node: tidy("".join(t.text or "" for t in node.iter(f"{W}t")))
    out = []
    for node in body if body is not None else []:
        if node.tag == f"{W}p" and (t := text(node)):
            style = node.find(f"{W}pPr/{W}pStyle")
            runs = [r for r in node.iter(f"{W}r") if tidy("".join(t.text or "" for t in r.iter(f"{W}t")))]
            out.append((len(out), t, style.get(f"{W}val", "") if style is not None else "", bool(runs) and all(r.find(f"{W}rPr/{W}b") is not None for r in runs), "paragraph"))
        elif node.tag == f"{W}tbl":
            for row in node.iter(f"{W}tr"):
                if t := " | ".join(x for x in (text(c) for c in row.findall(f"{W}tc")) if x):
                    out.append((len(out), t, "", False, "table"))
    return out


def docx_blocks(files: DataFrame) -> DataFrame:
    """(path, idx, text, style, bold, source) of DOCX files."""

    def scan(batches):
        for pdf in batches:
            rows = [(path, *r) for path, content in zip(pdf["path"], pdf["content"]) for r in docx_rows(content)]
            yield pd.DataFrame(rows, columns=["path", "idx", "text", "style", "bold", "source"])

    return files.mapInPandas(scan, "path string, idx int, text string, style string, bold boolean, source string")


def json_list(text: F.Column, schema: str) -> F.Column:
    """A JSON array in a cell; bad JSON and other things give an empty array."""
    return F.coalesce(F.from_json(text, f"array<{schema}>"), F.array().cast(f"array<{schema}>"))


def authorships(text: F.Column) -> F.Column:
    """An authorship list with null-safe parts."""
    raw = json_list(text, "struct<author:struct<id:string,display_name:string,orcid:string>,author_position:string,is_corresponding:boolean,raw_author_name:string,institutions:array<struct<id:string,display_name:string,ror:string,country_code:string,type:string>>>")
    return F.transform(raw, lambda a: F.struct(F.coalesce(a["author"]["id"], F.lit("")).alias("author_id"), F.coalesce(a["author"]["display_name"], a["raw_author_name"], F.lit("")).alias("name"), a["author"]["orcid"].alias("orcid"), F.coalesce(a["is_corresponding"], F.lit(False)).alias("is_corresponding"), F.coalesce(F.transform(a["institutions"], lambda i: F.coalesce(i["id"], i["ror"], F.lit(""))), F.array().cast("array<string>")).alias("institutions")))


def compact_json(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, allow_nan=False, separators=(",", ":"))


# functions travel with their code, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
