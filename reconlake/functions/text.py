"""Column functions for names, addresses, codes and urls. Null in, null out, unless said otherwise."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

# --- fixed values ---
LEGAL_FORMS = (
    "社会医療法人社団", "社会医療法人", "医療法人社団", "医療法人財団", "医療法人", "一般社団法人", "一般財団法人", "公益財団法人", "公益社団法人", "社会福祉法人", "学校法人",
    "国立大学法人", "公立大学法人", "地方独立行政法人", "独立行政法人国立病院機構", "独立行政法人地域医療機能推進機構", "独立行政法人", "国家公務員共済組合連合会", "公立学校共済組合", "株式会社",
)
GENERIC_WORDS = ("クリニック", "病院", "医院", "診療所", "整形外科")
#: signs left out of keys: of names and treatments, the same with trade marks, of names and addresses in lists, and all of them
KEY_SIGNS = "[\\s　・･\\-‐–—―_()（）\\[\\]【】「」『』,.，。、:：/／]"
KEY_SIGNS_MARKS = "[\\s　・･\\-‐–—―_()（）\\[\\]【】「」『』,.，。、:：/／®™]"
LIST_SIGNS = "[\\s　・･\\-‐‑–—―,，.。()（）「」『』【】\\[\\]•＆&]"
PUNCTUATION = "[\\s　・･\\-‐–—―_()（）\\[\\]【】「」『』,.，。、:：/／&＆•®™]"
PLACEHOLDERS = ("未確認", "不明", "UNKNOWN")
PLAN_URL = "/download/([^/]+)/"
REGIONS = {
    "北海道": "北海道",
    "東北": "青森県 岩手県 宮城県 秋田県 山形県 福島県",
    "関東": "茨城県 栃木県 群馬県 埼玉県 千葉県 東京都 神奈川県",
    "中部": "新潟県 富山県 石川県 福井県 山梨県 長野県 岐阜県 静岡県 愛知県",
    "近畿": "三重県 滋賀県 京都府 大阪府 兵庫県 奈良県 和歌山県",
    "中国": "鳥取県 島根県 岡山県 広島県 山口県",
    "四国": "徳島県 香川県 愛媛県 高知県",
    "九州": "福岡県 佐賀県 長崎県 熊本県 大分県 宮崎県 鹿児島県 沖縄県",
}
PREFECTURES = tuple(p for r in REGIONS.values() for p in r.split())


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility normalisation; no built-in function has it."""
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of a against b (not symmetric)."""
    return pd.Series([
        difflib.SequenceMatcher(None, x, y).ratio() if isinstance(x, str) and isinstance(y, str) else None
        for x, y in zip(a, b, strict=True)
    ], dtype="float64")


_SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("hit", StringType())]))


def regex_spans(pattern: str):
    """A function of a text column: all matches with their places, which built-in functions do not give."""
    import regex

    compiled = regex.compile(pattern)

    @F.pandas_udf(_SPANS)
    def spans(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [(m.start(), m.end(), m[0]) for m in compiled.finditer(t)] if isinstance(t, str) else None)

    return spans


def collapse_space(c: Column) -> Column:
    """Runs of any white space to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, "[ \t\n\r\f　 ]+", " "))


def compact(c: Column, signs: str = PUNCTUATION) -> Column:
    """Compatibility form in lower case without white space and the given signs."""
    return F.lower(F.regexp_replace(nfkc(c), signs, ""))


def plain_form(c: Column) -> Column:
    """Compatibility form, trimmed; case and signs stay."""
    return F.trim(F.regexp_replace(nfkc(c), "^\\s+|\\s+$", ""))


def no_separators(c: Column) -> Column:
    """Lower case without white space and middle dots, commas of one width; widths of letters stay."""
    return F.lower(F.replace(F.regexp_replace(c, "[\\s　・･]", ""), F.lit("，"), F.lit(",")))


def strip_legal(c: Column, forms: tuple[str, ...] = LEGAL_FORMS) -> Column:
    """The legal forms of the list removed one after the other, wherever they stand."""
    for f in forms:
        c = F.replace(c, F.lit(f), F.lit(""))
    return c


def facility_key(prefecture: Column, facility: Column) -> Column:
    """prefecture|compact stripped name; missing parts count as empty."""
    return F.concat_ws("|", F.coalesce(prefecture, F.lit("")), F.coalesce(strip_legal(compact(facility)), F.lit("")))


def address_key(address: Column, prefecture: Column | None = None) -> Column:
    """Address in compatibility form without postal code, the stated prefecture, signs and the words that part its numbers."""
    a = F.regexp_replace(nfkc(address), r"〒?[0-9]{3}-?[0-9]{4}", "")
    if prefecture is not None:
        a = F.when(prefecture != "", F.replace(a, prefecture, F.lit(""))).otherwise(a)
    return F.regexp_replace(F.lower(F.regexp_replace(a, LIST_SIGNS, "")), "丁目|番地|番|号", "")


def address_digits_key(address: Column) -> Column:
    """Address in compatibility form, of letters and digits only, without the words that part its numbers."""
    return F.regexp_replace(F.regexp_replace(F.lower(nfkc(address)), "丁目|番地|番|号", ""), "[^0-9a-z一-龥ぁ-んァ-ヶ]", "")


def prefecture_of(address: Column) -> Column:
    """First prefecture of the list that the address contains; null if none."""
    return F.coalesce(*[F.when(F.contains(address, F.lit(p)), F.lit(p)) for p in PREFECTURES])


def region_of(prefecture: Column) -> Column:
    """Region of a prefecture; empty if it is none."""
    out = F.lit("")
    for region, names in REGIONS.items():
        out = F.when(prefecture.isin(names.split()), region).otherwise(out)
    return out


def repair_digits(c: Column) -> Column:
    """White space between digits, or between a digit and a comma, removed, as scanned text needs it."""
    return F.regexp_replace(c, r"(?<=[0-9])[ \t]+(?=[0-9,])", "")


def surrogate_key(prefix: str, *parts: Column) -> Column:
    """prefix + ten hex digits of the SHA-1 of the parts; missing parts count as empty."""
    joined = F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha1(joined.cast("binary")), 1, 10)))


def code_of_url(url: Column) -> Column:
    return F.regexp_extract(url, PLAN_URL, 1)


def host_of_url(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://([^/:?#]+)", 1)


def unwrap_redirect(url: Column) -> Column:
    """Target of a search engine's redirect link (uddg= in clear, u=a1 in base64); other links stay."""
    clear = F.regexp_extract(url, r"[?&]uddg=([^&]+)", 1)
    packed = F.regexp_extract(url, r"[?&]u=a1([^&]+)", 1)
    pad = F.concat(F.translate(packed, "-_", "+/"), F.substring(F.lit("==="), F.lit(1), (F.lit(4) - F.length(packed) % 4) % 4))
    return F.when(clear != "", F.url_decode(clear)).when(packed != "", F.unbase64(pad).cast("string")).otherwise(url)


def aliases(facility: Column, least: int = 5, bare: int | None = None, separators: str = "[・&＆/ 　]") -> Column:
    """Distinct spellings of a name, longest first (then by text): compact, without legal form, and the parts around separators.

    With `bare`, also the name without generic words (clinic, hospital and the like) if it keeps that many characters, and
    the parts are taken without them. All count from `least` characters.
    """
    def without(c: Column) -> Column:
        for w in GENERIC_WORDS if bare is not None else ():
            c = F.replace(c, F.lit(w), F.lit(""))
        return c

    full = compact(facility)
    short = strip_legal(full)
    parts = F.transform(F.split(strip_legal(F.trim(nfkc(facility))), separators), lambda p: without(strip_legal(F.lower(F.regexp_replace(p, PUNCTUATION, "")))))
    kept = F.filter(F.concat(F.array(full, short), parts), lambda a: F.length(a) >= least)
    if bare is not None:
        kept = F.concat(kept, F.filter(F.array(without(short)), lambda a: F.length(a) >= bare))
    key = F.transform(F.array_distinct(kept), lambda a: F.struct((-F.length(a)).alias("n"), a.alias("a")))
    return F.transform(F.array_sort(key), lambda s: s["a"])


def split_set(c: Column, drop: tuple[str, ...] = PLACEHOLDERS, separators: str = "[|/]") -> Column:
    """Distinct parts of a field in order, placeholders left out."""
    parts = F.transform(F.split(c, separators), lambda p: F.trim(p))
    return F.array_distinct(F.filter(parts, lambda p: (p != "") & ~p.isin(*drop)))


def query_string(*parts: Column) -> Column:
    """The parts that say something, joined by blanks, each quoted if it holds a blank; for search engines."""
    quoted = [F.when(F.contains(p, F.lit(" ")), F.concat(F.lit('"'), p, F.lit('"'))).otherwise(p) for p in parts]
    return F.array_join(F.filter(F.array(*[F.trim(q) for q in quoted]), lambda x: x.isNotNull() & (x != "")), " ")


def join_sorted(c: Column, sep: str = "|") -> Column:
    return F.array_join(F.array_sort(c), sep)


def canonical_unique(values: Column, mapping: Column) -> Column:
    """Ordered distinct canonical values; unknown ones stay."""
    return F.array_distinct(F.transform(values, lambda v: F.coalesce(F.element_at(mapping, v), v)))


def by_alias(df: DataFrame, column: str, known: DataFrame, alias: str, canonical: str, name: str = "canonical") -> DataFrame:
    """df with `name`: the canonical value of an alias written as given (case and runs of blanks apart), else of one whose
    compact form is the same, else the value itself. Of several canonical values of a form the first in order counts."""
    spaced = lambda c: F.lower(F.trim(F.regexp_replace(nfkc(c), "[\\s　]+", " ")))
    tight = lambda c: compact(c, LIST_SIGNS)

    def table(form, key: str, value: str) -> DataFrame:
        return known.select(form(F.col(alias)).alias(key), F.col(canonical).alias(value)).where(f"{key} != ''").groupBy(key).agg(F.min(value).alias(value))

    out = df.withColumn("_s", spaced(F.col(column))).withColumn("_t", tight(F.col(column)))
    out = out.join(table(spaced, "_s", "_sc"), "_s", "left").join(table(tight, "_t", "_tc"), "_t", "left")
    return out.withColumn(name, F.coalesce("_sc", "_tc", plain_form(F.col(column)))).drop("_s", "_t", "_sc", "_tc")
