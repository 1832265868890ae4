import io
import json
import zipfile

from pyspark.sql import functions as F

from citeloom.sources import files, sinks
from citeloom.streaming import state


def docx(*paragraphs):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:rPr>{"<w:b/>" if b else ""}</w:rPr><w:t>{t}</w:t></w:r></w:p>' for t, s, b in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}<w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>y</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>')
    return out.getvalue()


def test_docx_and_lock_files(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(docx(("Ann Lee", "ReportHeader", True), ("Text", "", False)))
    (tmp_path / "~$a.docx").write_bytes(b"lock")
    got = files.docx_blocks(files.binaries(spark, str(tmp_path), "*.docx")).orderBy("idx").collect()
    assert [(r.text, r.style, r.bold, r.source) for r in got] == [("Ann Lee", "ReportHeader", True, "paragraph"), ("Text", "", False, "paragraph"), ("x | y", "", False, "table")]


def test_csv_json_and_replace(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([("1", 'a "quoted", line\nbreak'), ("2", None)], "id string, t string")
    sinks.csv(df, p, ["id", "t"])
    assert sorted(map(tuple, files.csv(spark, p, "id string, t string").collect())) == [("1", 'a "quoted", line\nbreak'), ("2", None)]
    sinks.csv(files.csv(spark, p, "id string, t string").where("id = '1'"), p, ["id", "t"])
    assert files.csv(spark, p, "id string, t string").count() == 1
    assert files.csv(spark, str(tmp_path / "none"), "id string").count() == 0
    (tmp_path / "log.jsonl").write_text('{"k":"a","seq":1,"v":1}\nnot json\n{"seq":3}\n{"k":"a","seq":2,"v":2}\n')
    assert [(r.k, r.v) for r in files.json_log(spark, str(tmp_path / "log.jsonl"), "k string, seq int, v int", "k", "seq").collect()] == [("a", 2)]
    m = sinks.manifest(spark, p, "*.csv").collect()
    assert m and all(len(r.sha256) == 64 and r.n_bytes > 0 for r in m)
    s = spark.createDataFrame([(200, b"%PDF-1.4"), (200, b"<html>"), (404, b""), (None, None)], "code int, c binary").select(sinks.download_status(F.col("code"), F.col("c")).alias("s"))
    assert [r.s for r in s.collect()] == ["downloaded", "not_pdf", "http_404", "network"]
    assert sinks.no_nan(spark.createDataFrame([(float("nan"),)], "x double")).first().x is None
    assert json.loads(files.compact_json({"a": "é"})) == {"a": "é"}


def test_streams(spark, tmp_path):
    src, out, chk = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "chk")
    spark.createDataFrame([("a", 1, "x")], "k string, seq int, v string").write.parquet(src)
    run = lambda: state.keep_current(state.source(spark, src, "*.parquet", "k string, seq int, v string"), out, ["k"], ["seq"], chk).awaitTermination()
    run()
    spark.createDataFrame([("a", 2, "y"), ("b", 1, "z")], "k string, seq int, v string").write.mode("append").parquet(src)
    run()
    run()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("a", 2, "y"), ("b", 1, "z")]
    snap = str(tmp_path / "snap")
    spark.sql("select 'a' as k, timestamp'2024-01-01 00:00:00' as t union all select 'a', timestamp'2024-01-01 00:00:00' union all select 'a', timestamp'2024-01-02 00:00:00'").coalesce(1).write.parquet(str(tmp_path / "obs"))
    state.snapshots(state.source(spark, str(tmp_path / "obs"), "*.parquet", "k string, t timestamp"), snap, ["k"], "t", str(tmp_path / "chk2")).awaitTermination()
    assert spark.read.parquet(snap).count() == 2
