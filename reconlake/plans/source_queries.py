"""Readers and writers over whole tables: what is written in each format, or made into pages, is read again.

Each query writes to (or builds) the format from a table and reads it back through the reader; the SQL gives the
same rows from the table itself. Files go to the shared folder that also holds checkpoints.
"""

from __future__ import annotations

import io
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from reconlake.plans.register import collector
from reconlake.session import ensure_checkpoint_dir, load
from reconlake.sources import markup, pdf, readers, sinks

QUERIES, ORACLES, query = collector()

_PLAN = StructType([StructField(c, StringType()) for c in ("plan_id", "facility", "address", "treatment")])
_PLAN_SQL = "SELECT plan_id, facility, address, treatment FROM treatment_plan"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "treatment_plan").select(*_PLAN.names)


def _escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


# ---------------------------------------------------------------- files


@query(_PLAN_SQL)
def json_envelope_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that hold an array of items, one file each."""
    path = _folder(spark, "envelope")
    # an object for each hundredth of the plans: no array grows with the table
    part = F.pmod(F.xxhash64("plan_id"), F.lit(100))
    _plans(spark, sf_dir).groupBy(part.alias("part")).agg(F.collect_list(F.struct(*_PLAN.names)).alias("items")).select("items").write.json(path)
    return spark.read.schema(StructType([StructField("items", ArrayType(_PLAN))])).json(path).select(F.explode("items").alias("i")).select("i.*")


@query("SELECT CAST(0 AS BIGINT) AS n")
def missing_envelope_is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing file gives an empty table where that is allowed."""
    return readers.json_envelope(spark, _folder(spark, "none"), _PLAN, missing_ok=True).agg(F.count("*").alias("n"))


@query("SELECT plan_id, facility, address, treatment FROM treatment_plan")
def snapshot_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compressed snapshot."""
    path = _folder(spark, "snapshot")
    sinks.write_snapshot(_plans(spark, sf_dir), path)
    return spark.read.schema(_PLAN).option("mode", "FAILFAST").json(path)


@query("SELECT CAST(count(*) AS BIGINT) AS items, CAST(count(DISTINCT facility) AS BIGINT) AS facilities, true AS same FROM treatment_plan")
def envelope_with_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and a summary of one row below one folder."""
    path, p = _folder(spark, "items"), _plans(spark, sf_dir)
    sinks.write_envelope(p, p.agg(F.count("*").alias("n"), F.countDistinct("facility").alias("f")), path)
    said = spark.read.schema("n bigint, f bigint").json(f"{path}/summary").first()
    back = spark.read.schema(_PLAN).json(f"{path}/items").agg(F.count("*").alias("items"), F.countDistinct("facility").alias("facilities"))
    return back.withColumn("same", (F.col("items") == said.n) & (F.col("facilities") == said.f))


@query("SELECT plan_id, facility, coalesce(address, '') AS address, treatment FROM treatment_plan")
def delimited_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated files with a header; an empty field stays empty."""
    path = _folder(spark, "delimited")
    sinks.write_delimited(_plans(spark, sf_dir).na.fill(""), path, list(_PLAN.names))
    return readers.delimited(spark, path, list(_PLAN.names)).na.fill("")


@query("SELECT DISTINCT trim(facility) AS facility FROM treatment_plan WHERE trim(facility) <> ''")
def line_list_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "lines")
    _plans(spark, sf_dir).select(F.concat(F.lit("  "), F.coalesce("facility", F.lit("")), F.lit(" ")).alias("value")).write.text(path)
    return readers.line_list(spark, path, "facility")


@query("SELECT c_nationkey, arg_min(c_name, c_custkey) AS first_name, arg_max(c_name, c_custkey) AS last_name FROM customer GROUP BY c_nationkey")
def first_and_last_by_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in order of their paths, rows in order within them: the first and the last row of each key."""
    path = _folder(spark, "ordered")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    c.repartitionByRange(7, "c_custkey").sortWithinPartitions("c_custkey").select(F.col("c_nationkey").cast("string"), "c_name").write.option("header", True).csv(path)
    rows = readers.in_file_order(readers.delimited(spark, path, ["c_nationkey", "c_name"], sep=","))
    kind = dict(c.dtypes)["c_nationkey"]
    return rows.groupBy(F.col("c_nationkey").cast(kind).alias("c_nationkey")).agg(F.min_by("c_name", "src_place").alias("first_name"), F.max_by("c_name", "src_place").alias("last_name"))


@query("SELECT category AS kind, CAST(count(*) AS BIGINT) AS n, true AS reused FROM treatment_plan WHERE category IS NOT NULL GROUP BY 1")
def index_reused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index that is stored with rows of every kind is read instead of built."""
    path, built = _folder(spark, "index"), []

    def build() -> DataFrame:
        built.append(1)
        return load(spark, sf_dir, "treatment_plan").where("category is not null").groupBy(F.col("category").alias("kind")).agg(F.count("*").alias("n"))

    kinds = [r[0] for r in load(spark, sf_dir, "treatment_plan").where("category is not null").select("category").distinct().limit(1000).collect()]
    readers.reuse_index(spark, path, "kind", kinds, build)
    return readers.reuse_index(spark, path, "kind", kinds, build).withColumn("reused", F.lit(len(built) == 1))


@query("SELECT row_id, CASE WHEN amount IS NULL THEN 'fetch' ELSE 'keep' END AS route FROM price_stage")
def routes_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written to one folder a route and read from all of them."""
    path = _folder(spark, "routes")
    p = load(spark, sf_dir, "price_stage").select("row_id", F.when(F.col("amount").isNull(), "fetch").otherwise("keep").alias("route"))
    sinks.write_routes(p, path)
    return spark.read.schema("row_id bigint, route string").parquet(path)


# ---------------------------------------------------------------- pages


@query("SELECT plan_id, facility, coalesce(prefecture, '') AS prefecture, coalesce(address, '') AS address, coalesce(treatment, '') AS treatment, CAST(coalesce(len(document_urls_source), 0) AS BIGINT) AS n_links FROM treatment_plan".replace("coalesce(address, '')", "trim(regexp_replace(coalesce(address, ''), '[\\s　]+', ' ', 'g'))").replace("SELECT plan_id, facility,", "SELECT plan_id, trim(regexp_replace(coalesce(facility, ''), '[\\s　]+', ' ', 'g')) AS facility,"))
def html_tables_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page with a table of eight cells a row for each plan; rows with fewer cells are passed over."""
    t = load(spark, sf_dir, "treatment_plan")
    cell = lambda c: F.concat(F.lit("<td>"), _escaped(F.coalesce(c, F.lit(""))), F.lit("</td>"))
    links = F.array_join(F.transform(F.coalesce("document_urls_source", F.array().cast("array<struct<label:string,url:string>>")), lambda x: F.concat(F.lit('<a href="'), _escaped(x["url"]), F.lit('">'), _escaped(x["label"]), F.lit("</a>"))), " ")
    empty = F.lit("<td></td>")
    row = F.concat(F.lit("<tr>"), cell(F.col("facility")), cell(F.col("prefecture")), cell(F.col("address")), empty, cell(F.col("treatment")), empty, empty, F.lit("<td>"), links, F.lit("</td></tr>"))
    html = F.concat(F.lit("<html><body><table><tr><th>x</th></tr>"), row, F.lit("<tr><td>short</td></tr></table></body></html>"))
    r = markup.table_rows(t.select("plan_id", html.alias("html")), "plan_id", "html", 8)
    text = lambda i: F.get("cells", F.lit(i))["text"]
    return r.select("plan_id", text(0).alias("facility"), text(1).alias("prefecture"), text(2).alias("address"), text(4).alias("treatment"), F.size(F.get("cells", F.lit(7))["links"]).cast("bigint").alias("n_links"))


_VISIBLE = "list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[\\s　\\x{a0}]+', ' ', 'g'))), lambda x: x <> '')"


@query(f"SELECT doc_id, md5(array_to_string({_VISIBLE}, chr(10))) AS text_md5, CAST(len({_VISIBLE}) AS BIGINT) AS n_lines FROM documents")
def visible_text_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages with scripts and styles; what can be seen is the text."""
    d = load(spark, sf_dir, "documents")
    lines = F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("<p>"), _escaped(x), F.lit("</p><script>var x = '<p>';</script>")))
    html = F.concat(F.lit("<html><head><title>t</title><style>p {}</style></head><body>"), F.array_join(lines, ""), F.lit("</body></html>"))
    t = d.select("doc_id", markup.page_text(html).alias("t")).select("doc_id", F.col("t.text").alias("text"))
    return t.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"))


@query("""WITH l AS (SELECT plan_id, unnest(document_urls_source) AS l, unnest(generate_series(1, len(document_urls_source))) AS i FROM treatment_plan), o AS (SELECT plan_id, l.url AS url, min(i) AS i FROM l GROUP BY 1, 2), r AS (SELECT plan_id, url, row_number() OVER (PARTITION BY plan_id ORDER BY i) AS n FROM o)
SELECT plan_id, url FROM r WHERE n <= 2""")
def first_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two links of each plan's page that lead to its own host, each target once; the bound is the feature."""
    t = load(spark, sf_dir, "treatment_plan").where("document_urls_source is not null")
    links = F.array_join(F.transform("document_urls_source", lambda x: F.concat(F.lit('<a href="'), _escaped(x["url"]), F.lit('#part">'), _escaped(x["label"]), F.lit("</a>"))), "<br>")
    html = F.concat(F.lit('<a href="https://elsewhere.example/x">料金</a>'), links)
    pages = t.select("plan_id", F.lit("https://plan-registry.example/top").alias("url"), html.alias("html"))
    return markup.same_host_links(pages, "plan_id", "url", "html", ".", 2).select("plan_id", "url")


@query("""SELECT prefecture, row_number() OVER (PARTITION BY prefecture ORDER BY facility_id) AS entry_no, facility_id AS entry, coalesce(plan_count, 0) AS plans FROM nonqueue_facility WHERE prefecture <> ''""")
def headed_entries_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list with the prefecture as heading, facilities below it and details below these, read in the order of the document."""
    f = load(spark, sf_dir, "nonqueue_facility").where("prefecture <> ''")
    entry = F.concat(F.lit("<h3>"), "facility_id", F.lit("</h3><h4>"), F.coalesce(F.col("plan_count").cast("string"), F.lit("0")), F.lit("</h4>"))
    page = f.groupBy("prefecture").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("facility_id", entry.alias("e")))), lambda x: x["e"]), "").alias("e"))
    html = page.select("prefecture", F.concat(F.lit("<h2>"), "prefecture", F.lit("</h2>"), "e").alias("html"))
    h = markup.headed_entries(html, "prefecture", "html", "h2", "h3", "h4")
    return h.select(F.col("group").alias("prefecture"), "entry_no", "entry", F.get("details", F.lit(0)).cast("bigint").alias("plans"))


@query("""SELECT source, row_number() OVER (PARTITION BY source ORDER BY locator_id) AS record_no, trim(name) AS name, locator_id AS code FROM locator WHERE source IS NOT NULL AND trim(name) <> ''""")
def labelled_records_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finder entries as lines of labels and values in turn."""
    l = load(spark, sf_dir, "locator").where("source is not null and trim(name) <> ''").select("source", "locator_id", F.trim("name").alias("name"))
    parts = F.array(F.lit("名称"), F.col("name"), F.lit("コード"), F.col("locator_id"), F.lit("備考"))
    lines = l.select("source", F.posexplode(parts).alias("i", "line"), "locator_id").select("source", F.concat_ws("-", "locator_id", "i").alias("place"), "line")
    r = markup.labelled_records(lines, "source", "place", "line", "名称", {"name": "名称", "code": "コード"})
    return r.select("source", "record_no", "name", "code")


def _office_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Word-processing files of one paragraph a line."""
    from xml.sax.saxutils import escape

    for b in batches:
        out = []
        for t in b["text"]:
            f = io.BytesIO()
            with zipfile.ZipFile(f, "w") as z:
                z.writestr("word/document.xml", "<w:document>" + "".join(f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r></w:p>" for x in t.split("\n")) + "</w:document>")
            out.append(f.getvalue())
        yield pd.DataFrame({"doc_id": b["doc_id"], "content": out})


@query("SELECT doc_id, 'zip' AS kind, md5(trim(text, ' ' || chr(10) || chr(9) || chr(13) || '　')) AS text_md5 FROM documents")
def office_text_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = load(spark, sf_dir, "documents").select("doc_id", "text").mapInPandas(_office_files, "doc_id bigint, content binary")
    return files.select("doc_id", readers.kind_of(F.col("content")).alias("kind"), F.md5(markup.office_text("content").cast("binary")).alias("text_md5"))


def _pdf_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """PDF files with a page for the plan and one for its code, in a font that tells what its codes mean."""

    def built(pages: list[str]) -> bytes:
        letters = sorted(set("".join(pages)))
        code = {c: i + 1 for i, c in enumerate(letters)}
        cmap = b"1 beginbfchar\n" + b"".join(f"<{i:04X}> <{c.encode('utf-16-be').hex()}>\n".encode() for c, i in code.items()) + b"endbfchar"
        kids = " ".join(f"{5 + 2 * i} 0 R" for i in range(len(pages)))
        objects = [b"<< /Type /Catalog /Pages 2 0 R >>", f"<< /Type /Pages /Kids [{kids}] /Count {len(pages)} >>".encode(), b"<< /Type /Font /Subtype /Type0 /ToUnicode 4 0 R >>", b"<< /Length %d >>\nstream\n%s\nendstream" % (len(cmap), cmap)]
        for i, text in enumerate(pages):
            shown = " T* ".join("<" + "".join(f"{code[c]:04X}" for c in line) + "> Tj" for line in text.split("\n"))
            z = zlib.compress(f"BT /F1 12 Tf 72 700 Td {shown} ET".encode())
            objects += [f"<< /Type /Page /Parent 2 0 R /Resources << /Font << /F1 3 0 R >> >> /Contents {6 + 2 * i} 0 R >>".encode(), b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(z), z)]
        return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (i + 1, o) for i, o in enumerate(objects)) + b"%%EOF"

    for b in batches:
        yield pd.DataFrame({"plan_id": b["plan_id"], "content": [built([f"{t}\nplan", c]) for t, c in zip(b["treatment"], b["code"], strict=True)]})


@query("SELECT plan_id, 'pdf' AS kind, treatment || chr(10) || 'plan' AS first_page, mhlw_plan_code AS second_page FROM treatment_plan WHERE treatment <> ''")
def pdf_pages_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load(spark, sf_dir, "treatment_plan").where("treatment <> ''").select("plan_id", "treatment", F.col("mhlw_plan_code").alias("code"))
    files = t.mapInPandas(_pdf_files, "plan_id string, content binary").withColumn("p", pdf.pdf_pages("content"))
    return files.select("plan_id", readers.kind_of(F.col("content")).alias("kind"), F.get("p.pages", F.lit(0)).alias("first_page"), F.get("p.pages", F.lit(1)).alias("second_page"))


@query("""SELECT doc_id, length(trim(text, ' ')) < 500 OR NOT contains(text, '円') AS recognise, CASE WHEN n_chars % 2 = 0 THEN 'parsed' WHEN length(text) > 500 THEN 'raw' ELSE 'error' END AS kind FROM documents""")
def texts_to_recognise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts are too little, and where the bytes stand in for a text that could not be parsed."""
    d = load(spark, sf_dir, "documents")
    text = F.when(F.col("n_chars") % 2 == 0, F.col("text"))
    return d.select("doc_id", readers.needs_recognition(F.col("text")).alias("recognise"), readers.text_or_raw(text, F.encode("text", "UTF-8"))["kind"].alias("kind"))


# ---------------------------------------------------------------- crawls, searches, fetches


@query("""WITH l AS (SELECT plan_id, unnest(document_urls_source).url AS url, unnest(generate_series(1, len(document_urls_source))) AS i FROM treatment_plan), c AS (SELECT plan_id, url FROM (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY i, url) AS n FROM l) WHERE n <= 6),
w AS (SELECT plan_id, url, min(d) AS depth FROM (SELECT plan_id, document_url_source AS url, 0 AS d FROM treatment_plan UNION ALL SELECT plan_id, url, 1 FROM c) GROUP BY 1, 2)
SELECT plan_id, url, CAST(depth AS BIGINT) AS depth, n FROM w JOIN (SELECT document_url AS url, CAST(count(*) AS BIGINT) AS n FROM price_stage GROUP BY 1) USING (url)""")
def crawled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of each plan and those of its first six links, as far as they are among the pages at hand."""
    t = load(spark, sf_dir, "treatment_plan")
    seeds = t.select("plan_id", F.col("document_url_source").alias("url"))
    links = t.select(F.col("document_url_source").alias("url"), F.posexplode("document_urls_source").alias("place", "l")).select("url", "place", F.col("l.url").alias("target"))
    pages = load(spark, sf_dir, "price_stage").groupBy(F.col("document_url").alias("url")).agg(F.count("*").alias("n"))
    return readers.with_first_children(seeds, links, pages, "plan_id", "url").select("plan_id", "url", F.col("depth").cast("bigint").alias("depth"), "n")


@query("""WITH r AS (SELECT match_id, source_facility_name AS q, CASE source_operator WHEN 'Orthenna' THEN 0 WHEN 'Kitasolva' THEN 1 WHEN 'Zelvane Medical' THEN 2 END AS o FROM locator_match WHERE source_facility_name IS NOT NULL)
SELECT match_id, q AS query FROM (SELECT *, min(o) OVER (PARTITION BY q) AS b FROM r WHERE o IS NOT NULL) WHERE o = b""")
def first_engine_with_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several sources of results for a query the first that has any."""
    m = load(spark, sf_dir, "locator_match").where("source_facility_name is not null")
    return readers.search_results(m, "source_facility_name", "source_operator", ["Orthenna", "Kitasolva", "Zelvane Medical"]).select("match_id", F.col("source_facility_name").alias("query"))


@query("""WITH p AS (SELECT CASE lane WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 END AS page, prefecture AS link FROM price_stage WHERE lane IS NOT NULL), f AS (SELECT link, min(page) AS page FROM p WHERE link IS NOT NULL GROUP BY 1), h AS (SELECT DISTINCT page FROM f),
g AS (SELECT page FROM (SELECT page, page - (SELECT min(page) FROM p) - row_number() OVER (ORDER BY page) + 1 AS gap FROM h) WHERE gap = 0)
SELECT link, CAST(page AS BIGINT) AS page FROM f JOIN g USING (page)""")
def links_until_nothing_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a numbered listing up to the first page that shows no new one."""
    page = F.when(F.col("lane") == "A", 1).when(F.col("lane") == "B", 2).when(F.col("lane") == "C", 3).cast("bigint")
    p = load(spark, sf_dir, "price_stage").where("lane is not null").select(page.alias("page"), F.col("prefecture").alias("link"))
    return readers.until_nothing_new(p, "page", "link").select("link", "page")


def _offline() -> object:
    """A connector without a network: some pages are busy at the first try, some are not there."""
    tried: dict[str, int] = {}

    def get(url: str) -> tuple[int, bytes]:
        tried[url] = tried.get(url, 0) + 1
        if url.endswith("/0") and tried[url] == 1:
            return 503, b""
        return (404, b"") if url.endswith("/1") else (200, url.encode())

    return get


def _no_wait(seconds: float) -> None:
    return None


@query("""SELECT url, CASE WHEN url LIKE '%/1' THEN 404 ELSE 200 END AS status, url NOT LIKE '%/1' AS found FROM (SELECT DISTINCT l.url AS url FROM (SELECT unnest(document_urls_source) AS l FROM treatment_plan))""")
def fetched_through_a_connector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All linked pages through a connector, tried again where the answer is worth it."""
    urls = load(spark, sf_dir, "treatment_plan").select(F.explode("document_urls_source").alias("l")).select(F.col("l.url").alias("url")).where("url is not null").distinct()
    got = readers.fetched(urls, "url", _offline, sleep=_no_wait)
    return got.select("url", "status", F.col("content").isNotNull().alias("found"))
