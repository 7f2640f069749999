"""Text, tables, links and sections of HTML and office documents.

Python is needed for parsing; the functions run Arrow-batched, one document at a time. A document that cannot be
read gives its error as text beside empty results rather than ending the job. Fetching, browsers and text
recognition are connectors outside this library: their results come in as (path, content) tables.
"""

from __future__ import annotations

import html as html_entities
import io
import re
import zipfile
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_SILENT = {"script", "style", "noscript", "svg", "template", "head"}
_BREAK = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "table", "section", "article", "ul", "ol", "dt", "dd"}
_VOID = {"br", "img", "hr", "input", "meta", "link"}


class _Page(HTMLParser):
    def __init__(self, base: str = "") -> None:
        super().__init__(convert_charrefs=True)
        self.base, self.text, self.links, self.rows, self.sections = base, [], [], [], []
        self.quiet, self.title, self._tag = 0, "", ""
        self._row, self._cell, self._href, self._label = None, None, None, []
        self._cell_links: list = []

    def handle_starttag(self, tag: str, attrs) -> None:
        self._tag = tag
        if tag in _SILENT and tag not in _VOID:
            self.quiet += 1
        if tag in _BREAK:
            self.text.append("\n")
        if tag == "a":
            self._href, self._label = dict(attrs).get("href"), []
        elif tag == "tr":
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._cell, self._cell_links = [], []
        elif re.fullmatch("h[1-6]", tag):
            self.sections.append((tag, ""))

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT and self.quiet:
            self.quiet -= 1
        if tag in _BREAK:
            self.text.append("\n")
        if tag == "a" and self._href:
            link = (" ".join("".join(self._label).split()), urldefrag(urljoin(self.base, self._href))[0])
            self.links.append(link)
            self._cell_links.append(link)
            self._href = None
        elif tag in ("td", "th") and self._cell is not None and self._row is not None:
            self._row.append((" ".join("".join(self._cell).split()), list(self._cell_links)))
            self._cell = None
        elif tag == "tr" and self._row is not None:
            self.rows.append(self._row)
            self._row = None
        self._tag = ""

    def handle_data(self, data: str) -> None:
        if self._tag == "title":
            self.title += data
        if self.quiet:
            return
        self.text.append(data)
        if self._href is not None:
            self._label.append(data)
        if self._cell is not None:
            self._cell.append(data)
        if self.sections and re.fullmatch("h[1-6]", self._tag or ""):
            tag, seen = self.sections[-1]
            self.sections[-1] = (tag, " ".join((seen + " " + data).split()))


def parse_page(html: str, base: str = "") -> _Page:
    page = _Page(base)
    page.feed(html)
    page.close()
    return page


def visible_text(html: str) -> str:
    lines = "".join(parse_page(html).text).split("\n")
    return "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)


_LINK = StructType([StructField("label", StringType()), StructField("url", StringType())])
_TEXT = StructType([StructField("text", StringType()), StructField("title", StringType()), StructField("error", StringType())])
_CELL = StructType([StructField("text", StringType()), StructField("links", ArrayType(_LINK))])
_HEAD = ArrayType(StructType([StructField("tag", StringType()), StructField("text", StringType())]))


@F.pandas_udf(_TEXT)
def page_text(html: pd.Series) -> pd.DataFrame:
    """Visible text by lines, title, and the error if a page could not be read."""
    out = []
    for h in html:
        if not isinstance(h, str):
            out.append((None, None, None))
            continue
        try:
            out.append((visible_text(h), " ".join(parse_page(h).title.split()), None))
        except Exception as e:  # kept as a value, the job goes on
            out.append((None, None, f"{type(e).__name__}: {e}"[:300]))
    return pd.DataFrame(out, columns=["text", "title", "error"])


@F.pandas_udf(ArrayType(_LINK))
def page_links(html: pd.Series, base: pd.Series) -> pd.Series:
    """Links in order, resolved, without fragments, each target once."""
    def one(h, b):
        if not isinstance(h, str):
            return None
        seen: dict = {}
        for label, url in parse_page(h, b or "").links:
            seen.setdefault(url, label)
        return [(label, url) for url, label in seen.items()]

    return pd.Series([one(h, b) for h, b in zip(html, base, strict=True)])


@F.pandas_udf(ArrayType(ArrayType(_CELL)))
def page_rows(html: pd.Series) -> pd.Series:
    """Table rows as cells of text and links."""
    return html.map(lambda h: parse_page(h).rows if isinstance(h, str) else None)


@F.pandas_udf(_HEAD)
def page_headings(html: pd.Series) -> pd.Series:
    return html.map(lambda h: parse_page(h).sections if isinstance(h, str) else None)


@F.pandas_udf(StringType())
def office_text(content: pd.Series) -> pd.Series:
    """Text of word-processing files (zip with word/document.xml); empty for others."""
    def one(b):
        try:
            with zipfile.ZipFile(io.BytesIO(b)) as z:
                xml = z.read("word/document.xml").decode("utf-8", "replace")
        except (zipfile.BadZipFile, KeyError, TypeError):
            return ""
        xml = re.sub(r"</w:p>|<w:br[^>]*/>", "\n", xml)
        return html_entities.unescape(re.sub(r"<[^>]+>", "", xml)).strip()

    return content.map(one)


def table_rows(pages: DataFrame, key: str, html: str, cells: int) -> DataFrame:
    """(key, place, cells): table rows with at least that many cells."""
    rows = pages.select(F.col(key), F.posexplode(page_rows(html)).alias("place", "cells"))
    return rows.where(F.size("cells") >= cells)


def same_host_links(pages: DataFrame, key: str, url: str, html: str, wanted: str, most: int = 6) -> DataFrame:
    """(key, label, url): the first links to the page's own host whose label or target matches; the bound is the feature."""
    host = lambda c: F.parse_url(c, F.lit("HOST"))
    links = pages.select(F.col(key), F.col(url).alias("_page"), page_links(html, F.col(url)).alias("_l"))
    own = F.filter("_l", lambda x: (host(x["url"]) == host(F.col("_page"))) & (x["label"].rlike(wanted) | x["url"].rlike(wanted)))
    return links.select(key, F.explode(F.slice(own, 1, most)).alias("l")).select(key, "l.label", "l.url")


def headed_entries(pages: DataFrame, key: str, html: str, group: str, entry: str, detail: str) -> DataFrame:
    """(key, entry_no, group, entry, details): headings read in order; a group heading holds until the next one, an entry until the next."""
    h = pages.select(F.col(key), F.posexplode(page_headings(html)).alias("_p", "_h")).select(key, "_p", "_h.tag", F.col("_h.text").alias("t"))
    w = Window.partitionBy(key).orderBy("_p")
    h = h.withColumn("group", F.last(F.when(F.col("tag") == group, F.col("t")), True).over(w))
    h = h.withColumn("entry_no", F.sum((F.col("tag") == entry).cast("bigint")).over(w)).where("entry_no > 0")
    name = F.max(F.when(F.col("tag") == entry, F.col("t"))).alias("entry")
    of = F.max(F.when(F.col("tag") == entry, F.col("group"))).alias("group")
    details = F.transform(F.array_sort(F.collect_list(F.when(F.col("tag") == detail, F.struct("_p", "t")))), lambda s: s["t"]).alias("details")
    return h.groupBy(key, "entry_no").agg(of, name, details)


def labelled_records(lines: DataFrame, key: str, order: str, line: str, first: str, fields: dict[str, str], reach: int = 12) -> DataFrame:
    """(key, record_no, fields): label and value on successive lines; a record begins at each line that is `first` and is looked
    at for at most `reach` lines after it. Of a label that occurs again in a record the first occurrence counts."""
    w = Window.partitionBy(key).orderBy(order)
    r = lines.withColumn("_i", F.row_number().over(w)).withColumn("record_no", F.sum((F.col(line) == first).cast("bigint")).over(w)).withColumn("_v", F.lead(line).over(w))
    r = r.where("record_no > 0").withColumn("_s", F.min("_i").over(Window.partitionBy(key, "record_no"))).where(F.col("_i") - F.col("_s") <= reach)
    return r.groupBy(key, "record_no").agg(*[F.min_by("_v", F.when(F.col(line) == label, F.col("_i"))).alias(name) for name, label in fields.items()])


def same_site(url: Column, other: Column) -> Column:
    return F.parse_url(url, F.lit("HOST")) == F.parse_url(other, F.lit("HOST"))


def host(url: str) -> str:
    return urlparse(url).hostname or ""
