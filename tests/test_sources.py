"""Readers, markup, sinks and the incremental run."""

import datetime
import io
import json
import zipfile

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reconlake.sources import markup as M
from reconlake.sources import readers, sinks
from reconlake.streaming import incremental

ITEM = StructType([StructField("id", StringType()), StructField("n", LongType())])


def test_json_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"version": 1, "items": [{"id": "x", "n": 1}, {"id": "y"}]}))
    assert sorted((r.id, r.n) for r in readers.json_envelope(spark, str(tmp_path / "a.json"), ITEM).collect()) == [("x", 1), ("y", None)]
    assert readers.json_envelope(spark, str(tmp_path / "none.json"), ITEM, missing_ok=True).schema == ITEM
    (tmp_path / "m.json").write_text(json.dumps({"map": {"k": {"id": "x", "n": 2}}}))
    assert [tuple(r) for r in readers.keyed_envelope(spark, str(tmp_path / "m.json"), ITEM, "map", "key").collect()] == [("k", "x", 2)]


def test_delimited_and_lines(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes("﻿name\tv\nä\t\n\"q\tr\"\t2\n".encode())
    rows = readers.delimited(spark, str(tmp_path / "a.tsv"), ["name", "v"]).collect()
    assert sorted((r.name, r.v or "") for r in rows) == [("q\tr", "2"), ("ä", "")]
    (tmp_path / "l.txt").write_text(" a \n\nb\na\n")
    assert sorted(r.value for r in readers.line_list(spark, str(tmp_path / "l.txt")).collect()) == ["a", "b"]


PAGE = """<html><head><title> T &amp; U </title><script>var x="<td>"</script></head><body><h2>East</h2><h3>Clinic A</h3><h4>P1</h4><h4>P2</h4><h3>Clinic B</h3>
<h2>West</h2><h3>Clinic C</h3><h4>P3</h4><table><tr><td>a</td><td>b <a href="/f.pdf#x">file</a></td></tr><tr><td>only</td></tr></table>
<a href="fee.html">price list</a><a href="https://other.example/fee">price</a><a href="fee.html#2">again</a><p>end<style>p{}</style></body>"""


def test_markup(spark):
    df = spark.createDataFrame([(1, "https://h.example/d/index.html", PAGE), (2, None, None)], "k long, url string, html string")
    t = df.select("k", M.page_text("html").alias("t")).orderBy("k").collect()
    assert t[0].t.title == "T & U" and "var x" not in t[0].t.text and "p{}" not in t[0].t.text and t[0].t.text.endswith("end") and t[1].t.text is None
    rows = M.table_rows(df, "k", "html", 2).collect()
    assert len(rows) == 1 and [c.text for c in rows[0].cells] == ["a", "b file"] and rows[0].cells[1].links[0].url == "/f.pdf"
    links = M.same_host_links(df, "k", "url", "html", "price|fee").collect()
    assert [(r.label, r.url) for r in links] == [("price list", "https://h.example/d/fee.html")]
    got = sorted((r.entry_no, r["group"], r.entry, tuple(r.details)) for r in M.headed_entries(df.where("k = 1"), "k", "html", "h2", "h3", "h4").collect())
    assert got == [(1, "East", "Clinic A", ("P1", "P2")), (2, "East", "Clinic B", ()), (3, "West", "Clinic C", ("P3",))]


def test_labelled_records(spark):
    lines = ["x", "Name", "A", "Town", "T1", "Name", "B"]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(lines)], "k long, i long, line string")
    got = sorted((r.record_no, r.name, r.town) for r in M.labelled_records(df, "k", "i", "line", "Name", {"name": "Name", "town": "Town"}).collect())
    assert got == [(1, "A", "T1"), (2, "B", None)]


def test_office_text_and_kinds(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", "<w:p><w:t>one</w:t></w:p><w:p><w:t>two</w:t></w:p>")
    (tmp_path / "a.docx").write_bytes(buf.getvalue())
    (tmp_path / "b.html").write_text("<!DOCTYPE html><p>x")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4")
    docs = readers.documents(spark, str(tmp_path))
    assert {r.path.rsplit("/", 1)[1]: r.kind for r in docs.collect()} == {"a.docx": "zip", "b.html": "html", "c.pdf": "pdf"}
    assert docs.where("kind = 'zip'").select(M.office_text("content")).first()[0] == "one\ntwo"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", [("x", 1)]), ("b", [])], "k string, p array<struct<n:string,v:int>>")
    assert sorted(tuple(r) for r in sinks.exploded(df, "p", ["k"]).collect()) == [("a", "x", 1), ("b", None, None)]
    assert sinks.exploded(df, "p", ["k"], placeholder=False).count() == 1
    t = spark.createDataFrame([("a", ["x", "y"], 1)], "k string, l array<string>, extra int")
    sinks.write_delimited(t, str(tmp_path / "t"), ["k", "l"])
    assert readers.delimited(spark, str(tmp_path / "t"), ["k", "l"]).first().l == "x|y"
    sinks.write_routes(spark.createDataFrame([(1, "r"), (2, "s")], "k int, route string"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r") + "/route=r").count() == 1
    sinks.write_snapshot(t, str(tmp_path / "z"))
    assert spark.read.json(str(tmp_path / "z")).count() == 1


def test_incremental_run_resumes(spark, tmp_path):
    land, state, check = (str(tmp_path / x) for x in ("land", "state", "check"))
    schema = StructType([StructField("k", StringType()), StructField("v", LongType()), StructField("n", LongType())])
    spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], schema).coalesce(1).write.mode("append").parquet(land)
    assert incremental.run_available(spark, land, schema, state, check, "k", "n") == 2
    spark.createDataFrame([("a", 2, 2), ("c", 1, 1)], schema).coalesce(1).write.mode("append").parquet(land)
    assert incremental.run_available(spark, land, schema, state, check, "k", "n") == 3
    assert incremental.run_available(spark, land, schema, state, check, "k", "n") == 3
    assert {r.k: r.v for r in incremental.current_state(spark, state).collect()} == {"a": 2, "b": 1, "c": 1}


def test_windowed_counts(spark):
    t = datetime.datetime(2025, 1, 1, 0, 10)
    df = spark.createDataFrame([(t, "a"), (t, "a"), (t + datetime.timedelta(hours=1), "a")], "t timestamp, kind string")
    assert sorted(r.n for r in incremental.windowed_counts(df, "t", "kind").collect()) == [1, 2]
    assert df.where(F.lit(False)).count() == 0
