"""Readers: JSON envelopes, delimited files, line lists, globs in file order, documents.

A missing path gives an empty table with the schema where `missing_ok`; schemas are always declared.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _or_empty(spark: SparkSession, read, schema: StructType, missing_ok: bool) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if missing_ok and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def json_envelope(spark: SparkSession, path: str, items: StructType, field: str = "items", missing_ok: bool = False) -> DataFrame:
    """The rows of the array `field` of files holding one object each. Broken files fail."""
    from pyspark.sql.types import ArrayType

    schema = StructType([StructField(field, ArrayType(items))])

    def read() -> DataFrame:
        raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True)
        return raw.select(F.explode(field).alias("_i")).select("_i.*")

    return _or_empty(spark, read, items, missing_ok)


def keyed_envelope(spark: SparkSession, path: str, value: StructType, field: str, key: str) -> DataFrame:
    """The entries of an object that maps keys to records, the key as a column of its own."""
    from pyspark.sql.types import MapType

    schema = StructType([StructField(field, MapType(StringType(), value))])
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True)
    return raw.select(F.explode(field).alias(key, "_v")).select(key, "_v.*")


def delimited(spark: SparkSession, path: str, columns: list[str], sep: str = "\t", missing_ok: bool = False) -> DataFrame:
    """Text columns of files with a header row; a byte order mark is no part of the first name; empty stays empty."""
    schema = StructType([StructField(c, StringType()) for c in columns])

    def read() -> DataFrame:
        return spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", True).option("emptyValue", "").option("nullValue", "\u0000").option("enforceSchema", True).schema(schema).csv(path)

    return _or_empty(spark, read, schema, missing_ok)


def in_file_order(df: DataFrame) -> DataFrame:
    """df, as read from files, with the file of each row and its place: by path, block of the file, row of the block.

    The place is an orderable struct that does not depend on how files are packed into partitions: a block is read by one
    task in its order, and the running number counts only inside it. For rules in which the first or last row wins.
    """
    place = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", F.col("_metadata.file_path").alias("src_file"), place.alias("src_place"))


def line_list(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Distinct trimmed lines that are not blank."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "").distinct()


def documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, content, kind) of files below a folder; kind by their first bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", "content", kind_of(F.col("content")).alias("kind"))


def kind_of(content: Column) -> Column:
    """pdf, zip (office files), html, json or text, by the first bytes."""
    head = F.hex(F.substring(content, 1, 8))
    text = F.lower(F.trim(F.decode(F.substring(content, 1, 200), "UTF-8")))
    return (
        F.when(head.startswith("25504446"), "pdf").when(head.startswith("504B0304"), "zip")
        .when(text.rlike(r"(?s)^.?\s*<(?:!doctype html|html|head|body|table|div)"), "html").when(text.rlike(r"^[\[{]"), "json").otherwise("text")
    )


def reuse_index(spark: SparkSession, path: str, kind: str, kinds: list[str], build) -> DataFrame:
    """The index stored at path if it has rows of every kind, else the one that build() gives, stored there for the next run."""
    def stored() -> DataFrame | None:
        try:
            df = spark.read.parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise
        found = {r[0] for r in df.where(F.col(kind).isin(kinds)).select(kind).distinct().collect()}  # at most the kinds asked for
        return df if found == set(kinds) else None

    df = stored()
    if df is None:
        build().write.mode("overwrite").parquet(path)
        df = spark.read.parquet(path)
    return df


def needs_recognition(text: Column, least: int = 500, sign: str = "円") -> Column:
    """Whether a document's text is too little to be its whole text, so that its pictures must be read; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    return (F.length(F.trim(t)) < least) | ~F.contains(t, F.lit(sign))


def text_or_raw(text: Column, content: Column, least: int = 500) -> Column:
    """(text, kind): the parsed text, else the bytes read as text if they give more than `least` characters, else null with kind error."""
    raw = F.decode(content, "UTF-8")
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.struct(text.alias("text"), F.lit("parsed").alias("kind")))
        .when(F.length(raw) > least, F.struct(raw.alias("text"), F.lit("raw").alias("kind")))
        .otherwise(F.struct(F.lit(None).cast("string").alias("text"), F.lit("error").alias("kind")))
    )


def with_first_children(seeds: DataFrame, links: DataFrame, pages: DataFrame, key: str, url: str, most: int = 6) -> DataFrame:
    """(key, url, depth, rest of pages): the pages of each seed and of its first `most` links, each page of a key once.

    seeds and pages have the column url; links (url, place, target) are those of the seed pages. Pages that are missing give no row.
    """
    near = F.row_number().over(Window.partitionBy(key).orderBy("place", "target"))
    children = seeds.join(links, url).select(key, "place", "target").withColumn("_n", near).where(F.col("_n") <= most)
    wanted = seeds.select(key, url, F.lit(0).alias("depth")).unionByName(children.select(key, F.col("target").alias(url), F.lit(1).alias("depth")))
    return wanted.groupBy(key, url).agg(F.min("depth").alias("depth")).join(pages, url)


def search_results(results: DataFrame, query: str, engine: str, engines: list[str]) -> DataFrame:
    """The rows of the first engine in the list that has any for a query; results (query, engine, rank, ...) come from a connector."""
    order = F.lit(None).cast("int")
    for i, e in enumerate(engines):
        order = F.when(F.col(engine) == e, i).otherwise(order)
    known = results.withColumn("_o", order).where(F.col("_o").isNotNull())
    best = known.groupBy(query).agg(F.min("_o").alias("_b"))
    return known.join(best, query).where("_o = _b").drop("_o", "_b")


def until_nothing_new(pages: DataFrame, page: str, link: str) -> DataFrame:
    """(link, page): each link with the page that first shows it, up to the first page that shows no new one.

    Pages are numbered without gaps; a page that is missing ends the list like one without a new link.
    """
    first = pages.where(F.col(link).isNotNull()).groupBy(link).agg(F.min(page).alias(page))
    have = first.groupBy(page).count().select(page)
    start = pages.agg(F.min(page)).first()[0]  # one number
    rank = Window.orderBy(page)  # one row for each page of one listing
    run = have.withColumn("_gap", F.col(page) - F.lit(start) - F.row_number().over(rank) + 1).where("_gap = 0").select(page)
    return first.join(run, page)


# --- fixed values: answers worth another try, and the pauses before it in seconds ---
RETRIED = (403, 429, 500, 502, 503, 504)
FIRST_PAUSE, ERROR_PAUSE, LONGEST_PAUSE = 5, 4, 45


def pause_before(attempt: int, status: int | None, retries: int = 5) -> float | None:
    """Seconds to wait after attempt (from 0) gave the status (None: an error), or None if it was the last word."""
    if status is not None and status not in RETRIED or attempt + 1 >= retries:
        return None
    return float(min(LONGEST_PAUSE, (FIRST_PAUSE if status is not None else ERROR_PAUSE) * 2**attempt))


def fetched(urls: DataFrame, url: str, make_context, retries: int = 5, reset_every: int = 5, reset_on: tuple[int, ...] = (403,), sleep=None) -> DataFrame:
    """(url, status, content, error) through a connector: make_context() gives a function of a url that returns (status, bytes).

    A context is made anew every `reset_every` urls and after an answer in reset_on. Errors are values: a url that cannot be
    read has none or its last status and the error's text; the job goes on. Null urls give no row.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        wait = sleep or time.sleep
        get, used = make_context(), 0
        for b in batches:
            out = []
            for u in b[url]:
                if used >= reset_every:
                    get, used = make_context(), 0
                used += 1
                status, content, error = None, None, None
                for attempt in range(retries):
                    try:
                        (status, content), error = get(u), None
                    except Exception as e:  # kept as a value
                        status, content, error = None, None, f"{type(e).__name__}: {e}"[:300]
                    if status in reset_on:
                        get, used = make_context(), 0
                    if status is not None and status < 400:
                        break
                    pause = pause_before(attempt, status, retries)
                    if pause is None:
                        break
                    wait(pause)
                ok = status is not None and status < 400
                out.append((u, status, content if ok else None, error or (None if ok else f"HTTP {status}")))
            yield pd.DataFrame(out, columns=[url, "status", "content", "error"])

    return urls.where(F.col(url).isNotNull()).select(url).mapInPandas(run, f"{url} string, status int, content binary, error string")
