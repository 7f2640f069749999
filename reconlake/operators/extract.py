"""Rows from text: lines with their neighbours, amounts, ranges, dictionary hits, snippets, chunks.

Null or empty texts give no rows. Lines are numbered after blank ones are dropped. All windows are bounded by one
document and taken on its array of lines, so no document has to be shuffled.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

# --- fixed values: amounts, what they may lie between, and the words beside them ---
AMOUNT = r"([0-9][0-9,]*)円"
TEN_THOUSANDS = r"([0-9]+(?:\.[0-9]+)?)万円"
YEN_AMOUNT = r"(?<![0-9])([0-9]{1,3}(?:,[0-9]{3})+|[0-9]{4,8})\s*円"
TEN_THOUSAND_AMOUNT = r"(?<![0-9])([0-9]+(?:\.[0-9]+)?)\s*万円"
LOWEST, HIGHEST = 1_000, 20_000_000
TAX_IN, TAX_OUT, TAX_UNKNOWN = "税込|消費税込", "税別|税抜|消費税別", "不明"
UNIT = r"((?:1|一)\s*回(?:\s*[（(][^）)]{0,20}[）)])?|(?:1|一)\s*部位|片側|両側|[0-9]+\s*回(?:分|コース)?|[0-9]+\s*クール)"
UNITS = (r"(片膝|両膝)", r"([12]\s*部位)", r"([12]\s*関節)", r"([12]\s*回)", r"(?i)([0-9,]+\s*万\s*(?:cells?|個))", r"(?i)([0-9]+\s*億\s*(?:cells?|個))")


def lines(df: DataFrame, key: str, text: str, reach: int = 2) -> DataFrame:
    """(key, line_no, line, near, before, after): near joins the lines within reach by blanks, line itself included."""
    ls = F.filter(F.transform(F.split(F.col(text), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    base = df.select(F.col(key), ls.alias("_l")).select(key, "_l", F.posexplode("_l").alias("_i", "line"))
    first = F.greatest(F.lit(1), F.col("_i") + 1 - reach)
    near = F.slice("_l", first, F.least(F.size("_l"), F.col("_i") + 1 + reach) - first + 1)
    return base.select(
        key, (F.col("_i") + 1).cast("bigint").alias("line_no"), "line", F.array_join(near, " ").alias("near"),
        F.when(F.col("_i") > 0, F.get("_l", F.col("_i") - 1)).otherwise("").alias("before"),
        F.coalesce(F.get("_l", F.col("_i") + 1), F.lit("")).alias("after"),
    )


def yen(col: Column) -> Column:
    return F.replace(col, F.lit(","), F.lit("")).try_cast("bigint")


def line_amounts(df: DataFrame, key: str, text: str, reach: int = 2) -> DataFrame:
    """(key, line_no, hit_no, amount, near): amounts in yen by line."""
    hit = lines(df, key, text, reach).select(key, "line_no", "near", F.posexplode(F.regexp_extract_all("line", F.lit(AMOUNT), 1)).alias("_h", "_a"))
    return hit.select(key, "line_no", (F.col("_h") + 1).cast("bigint").alias("hit_no"), yen(F.col("_a")).alias("amount"), "near")


def ten_thousand_amounts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, raw, cut, rounded): amounts stated in ten thousands, cut off and rounded."""
    d = F.col("raw").cast("double")
    raw = df.select(F.col(key), F.explode(F.regexp_extract_all(text, F.lit(TEN_THOUSANDS), 1)).alias("raw"))
    return raw.select(key, "raw", F.floor(d * 10000).cast("bigint").alias("cut"), F.round(d * 10000).cast("bigint").alias("rounded"))


RANGE = r"([0-9][0-9,]*)円?[~〜～から]+([0-9][0-9,]*)円"  # fixed value


def amounts_and_ranges(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind, low, high): ranges with ends in order, and amounts that are no part of a range."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(RANGE), 1).alias("a"), F.regexp_extract_all(text, F.lit(RANGE), 2).alias("b")
    )
    r = df.select(F.col(key), F.explode(pairs).alias("p")).select(key, yen(F.col("p.a")).alias("x"), yen(F.col("p.b")).alias("y"))
    ranges = r.select(key, F.lit("range").alias("kind"), F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high"))
    rest = F.regexp_replace(text, RANGE, " ")
    points = df.select(F.col(key), F.explode(F.regexp_extract_all(rest, F.lit(AMOUNT), 1)).alias("a"))
    points = points.select(key, F.lit("point").alias("kind"), yen(F.col("a")).alias("low"), yen(F.col("a")).alias("high"))
    return ranges.unionByName(points)


def tax_of(text: Column) -> Column:
    """Included wins over excluded; unknown if neither is stated. Null counts as unknown."""
    return F.when(text.rlike(TAX_IN), "税込").when(text.rlike(TAX_OUT), "税別").otherwise(TAX_UNKNOWN)


def unit_of(text: Column, pattern: str = UNIT) -> Column:
    """The first unit stated, empty if none."""
    return F.coalesce(F.regexp_extract(text, pattern, 1), F.lit(""))


def units_of(text: Column, patterns: tuple[str, ...] = UNITS, most: int = 3) -> Column:
    """The first hit of each pattern in their order, without blanks, each once, the first few joined by a middle dot."""
    hits = F.array(*[F.regexp_replace(F.regexp_extract(text, p, 1), r"\s+", "") for p in patterns])
    return F.array_join(F.slice(F.array_distinct(F.filter(hits, lambda h: h != "")), 1, most), "・")


def tokens_in(text: Column, tokens: Iterable[str], most: int = 4) -> Column:
    """The first `most` tokens, in the order of their list, that the text contains in any case; one inside another counts as well."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.slice(F.filter(F.array(*[F.lit(t) for t in tokens]), lambda t: F.contains(low, F.lower(t))), 1, most)


def context_score(line: Column, near: Column, rules: list[tuple[str, int, int]]) -> Column:
    """Sum over rules (pattern, points on the line, points near it) of the first of both that holds."""
    out = F.lit(0)
    for pattern, on, beside in rules:
        out = out + F.when(line.rlike(pattern), on).when(near.rlike(pattern), beside).otherwise(0)
    return out


def line_prices(df: DataFrame, key: str, text: str, rules: list[tuple[str, int, int]], tokens: Iterable[str], reach: int = 2, most: int = 30, low: int = LOWEST, high: int = HIGHEST) -> DataFrame:
    """(key, place, line_no, amount, tax, unit, tokens, score, line): amounts in yen or ten thousands by line, best first.

    Texts should be in compatibility form. Amounts follow no other digit, lie within bounds, are cut off to whole yen;
    tax, unit and tokens are those of the lines within reach. Equal (amount, tax, unit, line) count once; by score, then amount,
    then place in the text, the first `most` of a text are kept (a top-k is the feature).
    """
    flat = df.select(F.col(key), F.regexp_replace(text, "[ \t\f　\u00a0]+", " ").alias("_t"))
    found = lines(flat, key, "_t", reach)
    hits = None
    for k, (pattern, times) in enumerate(((YEN_AMOUNT, 1), (TEN_THOUSAND_AMOUNT, 10_000))):
        h = found.select(key, "line_no", "line", "near", F.posexplode(F.regexp_extract_all("line", F.lit(pattern), 1)).alias("_h", "_a"))
        value = F.floor(F.replace(F.col("_a"), F.lit(","), F.lit("")).try_cast("double") * times).cast("bigint")
        h = h.select(key, "line_no", "line", "near", F.lit(k).alias("_k"), "_h", value.alias("amount"))
        hits = h if hits is None else hits.unionByName(h)
    near = F.col("near")
    facts = hits.where(F.col("amount").between(low, high)).select(
        key, "line_no", "line", "_k", "_h", "amount", tax_of(near).alias("tax"), unit_of(near).alias("unit"), tokens_in(near, tokens).alias("tokens"),
        context_score(F.col("line"), near, rules).cast("bigint").alias("score"),
    )
    once = Window.partitionBy(key, "amount", "tax", "unit", "line").orderBy("line_no", "_k", "_h")
    rank = Window.partitionBy(key).orderBy(F.desc("score"), "amount", "line_no", "_k", "_h")
    kept = facts.withColumn("_o", F.row_number().over(once)).where("_o = 1").withColumn("place", F.row_number().over(rank).cast("bigint")).where(F.col("place") <= most)
    return kept.select(key, "place", "line_no", "amount", "tax", "unit", "tokens", "score", "line")


_PRICE = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("amount", LongType())]))


def amount_spans(rounded: bool = False):
    """A function of a text column in compatibility form: all amounts with their places, yen first, then ten thousands.

    Fractions of ten thousands are cut off or rounded. Built-in functions do not give places.
    """
    patterns = ((regex.compile(YEN_AMOUNT), 1), (regex.compile(TEN_THOUSAND_AMOUNT), 10_000))

    def one(t) -> list | None:
        if not isinstance(t, str):
            return None
        out = []
        for p, times in patterns:
            for m in p.finditer(t):
                v = float(m[1].replace(",", "")) * times
                out.append((m.start(), m.end(), round(v) if rounded else int(v)))
        return out

    @F.pandas_udf(_PRICE)
    def spans(s: pd.Series) -> pd.Series:
        return s.map(one)

    return spans


def amounts_in_context(df: DataFrame, key: str, text: str, rules: list[tuple[str, int]], tokens: Iterable[str], before: int = 150, after: int = 170, same: int | None = None, most: int = 20, low: int = LOWEST, high: int = HIGHEST, rounded: bool = False) -> DataFrame:
    """(key, place, amount, tax, unit, tokens, score, excerpt): amounts with the characters around them, best first.

    Equal (amount, first `same` characters of the excerpt; all if None) count once, and after sorting by score, amount and
    place in the text also equal (amount, tax, unit, tokens); the first `most` of a text are kept. Rules are (pattern, points).
    """
    hits = df.select(F.col(key), F.col(text).alias("_t"), F.posexplode(amount_spans(rounded)(text)).alias("_o", "_s"))
    start = F.greatest(F.col("_s.start") - before, F.lit(0))
    excerpt = F.trim(F.regexp_replace(F.substring("_t", start + 1, F.col("_s.end") + after - start), r"\s+", " "))
    hits = hits.where(F.col("_s.amount").between(low, high)).select(key, "_o", F.col("_s.amount").alias("amount"), excerpt.alias("excerpt"))
    c, points = F.col("excerpt"), F.lit(0)
    for pattern, p in rules:
        points = points + F.when(c.rlike(pattern), p).otherwise(0)
    facts = hits.select(key, "_o", "amount", "excerpt", tax_of(c).alias("tax"), unit_of(c).alias("unit"), tokens_in(c, tokens).alias("tokens"), points.cast("bigint").alias("score"))
    head = c if same is None else F.substring(c, 1, same)
    facts = facts.withColumn("_1", F.row_number().over(Window.partitionBy(key, "amount", head).orderBy("_o"))).where("_1 = 1")
    best = [F.desc("score"), F.col("amount"), F.col("_o")]
    facts = facts.withColumn("_2", F.row_number().over(Window.partitionBy(key, "amount", "tax", "unit", "tokens").orderBy(*best))).where("_2 = 1")
    facts = facts.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*best)).cast("bigint")).where(F.col("place") <= most)
    return facts.select(key, "place", "amount", "tax", "unit", "tokens", "score", "excerpt")


def augmented(rows: DataFrame, keys: list[str], amount: str, excerpt: str, reach: int = 90, low: int = LOWEST, high: int = HIGHEST) -> DataFrame:
    """rows and, with `synthetic` set, one row for each amount that an excerpt shows and no row of the same keys and excerpt has.

    Excerpts should be in compatibility form; `around` of an added row holds the characters around its amount. Columns not known of an added row are null.
    """
    base = rows.withColumn("synthetic", F.lit(False)).withColumn("around", F.lit(None).cast("string"))
    texts = rows.where(F.col(excerpt) != "").select(*keys, excerpt).distinct()
    found = texts.select(*keys, excerpt, F.explode(amount_spans(True)(F.col(excerpt))).alias("_s")).where(F.col("_s.amount").between(low, high))
    start = F.greatest(F.col("_s.start") - reach, F.lit(0))
    found = found.select(*keys, excerpt, F.col("_s.amount").cast(dict(rows.dtypes)[amount]).alias(amount), F.substring(F.col(excerpt), start + 1, F.col("_s.end") + reach - start).alias("around"), F.col("_s.start").alias("_p"))
    first = F.row_number().over(Window.partitionBy(*keys, excerpt, amount).orderBy("_p"))
    new = found.withColumn("_r", first).where("_r = 1").drop("_r", "_p").join(rows.select(*keys, amount, excerpt).distinct(), [*keys, amount, excerpt], "left_anti")
    return base.unionByName(new.withColumn("synthetic", F.lit(True)), allowMissingColumns=True)


def labelled_before(df: DataFrame, key: str, text: str, amounts: str, labels: dict[str, str], reach: int = 140) -> DataFrame:
    """(key, place, amount, kind, label): each match of `amounts` with the nearest label that ends at most reach characters before it.

    labels maps kinds to patterns; of labels equally near, the kind listed first wins. Without any, kind and label are null.
    """
    a_, l_ = regex.compile(amounts), [(k, regex.compile(p)) for k, p in labels.items()]
    kind = ArrayType(StructType([StructField(n, t) for n, t in (("place", IntegerType()), ("amount", StringType()), ("kind", StringType()), ("label", StringType()))]))

    @F.pandas_udf(kind)
    def pair(s: pd.Series) -> pd.Series:
        def one(t):
            if not isinstance(t, str):
                return None
            ends = [(name, [(m.end(), m[0]) for m in p.finditer(t)]) for name, p in l_]
            out = []
            for m in a_.finditer(t):
                best = None
                for name, hits in ends:
                    i = bisect.bisect_right(hits, (m.start(), "\U0010ffff")) - 1
                    if i >= 0 and (gap := m.start() - hits[i][0]) <= reach and (best is None or gap < best[0]):
                        best = (gap, name, hits[i][1])
                out.append((m.start(), m[0], *(best[1:] if best else (None, None))))
            return out

        return s.map(one)

    return df.select(F.col(key), F.explode(pair(text)).alias("_p")).select(key, "_p.*")


def best_amount_place(text: Column, amounts: Column, wanted: Column, tokens: Column, bonus: str, reach: int = 70, far: int = 999) -> Column:
    """The (start, end) at which an amount is best stated: one point if the surroundings show the bonus pattern, less a
    thousandth for each character since the last token before it (far if there is none); the first of equals; null if nowhere.

    amounts and tokens are arrays of matches with their places.
    """
    def score(s: Column) -> Column:
        before = F.array_max(F.transform(F.filter(tokens, lambda x: x["start"] < s["start"]), lambda x: x["end"]))
        left = F.greatest(s["start"] - reach, F.lit(0))
        shown = F.when(F.substring(text, left + 1, s["end"] + reach - left).rlike(bonus), 1.0).otherwise(0.0)
        return shown - F.coalesce(s["start"] - before, F.lit(far)) / 1000

    ranked = F.transform(F.filter(amounts, lambda s: s["amount"] == wanted), lambda s: F.struct((-score(s)).alias("n"), s["start"].alias("start"), s["end"].alias("end")))
    best = F.get(F.array_sort(ranked), F.lit(0))
    return F.when(best.isNotNull(), F.struct(best["start"].alias("start"), best["end"].alias("end")))


def hits_in_context(df: DataFrame, key: str, text: str, words: dict[str, str], context: str, near: Iterable[str] = (), exempt: Iterable[str] = (), reach: int = 180, windows: int = 4) -> DataFrame:
    """(key, word): words (name to pattern) that a text shows in a context.

    Those of `near` need the context within reach characters of one of their first `windows` matches, those of `exempt` none,
    all others anywhere in the text.
    """
    c_, w_ = regex.compile(context), [(n, regex.compile(p)) for n, p in words.items()]
    near, exempt = frozenset(near), frozenset(exempt)

    @F.pandas_udf(ArrayType(StringType()))
    def found(s: pd.Series) -> pd.Series:
        def one(t):
            if not isinstance(t, str):
                return None
            page, out = bool(c_.search(t)), []
            for name, p in w_:
                at = [m.span() for _, m in zip(range(windows), p.finditer(t))]
                if not at:
                    continue
                ok = name in exempt or (page if name not in near else any(c_.search(t[max(0, a - reach) : b + reach]) for a, b in at))
                if ok:
                    out.append(name)
            return out

        return s.map(one)

    return df.select(F.col(key), F.explode(found(text)).alias("word"))


def without_prices(df: DataFrame, key: str, text: str, target: str, price: str, contact: str, reach: int = 2, chars: int = 500, most: int = 5) -> DataFrame:
    """(key, place, excerpt): the first `most` distinct surroundings (their first `chars` characters) of lines in which the
    target, a price word and a request to get in touch stand together."""
    n = lines(df, key, text, reach).where(F.col("near").rlike(target) & F.col("near").rlike(price) & F.col("near").rlike(contact))
    n = n.select(key, "line_no", F.substring("near", 1, chars).alias("excerpt")).groupBy(key, "excerpt").agg(F.min("line_no").alias("line_no"))
    place = F.row_number().over(Window.partitionBy(key).orderBy("line_no"))
    return n.withColumn("place", place.cast("bigint")).where(F.col("place") <= most).select(key, "place", "excerpt")


def rejected_by_kind(kind: Column, text: Column, others: dict[str, str]) -> Column:
    """Whether the text names what competes with a row's kind; patterns by kind, unknown kinds reject nothing."""
    out = F.lit(False)
    for k, pattern in others.items():
        out = F.when(kind == k, F.coalesce(text.rlike(pattern), F.lit(False))).otherwise(out)
    return out


def is_official(title: Column, home: Column, names: Column, least: int = 5) -> Column:
    """Whether a page is the named facility's own: one of its names (of at least `least` characters) stands in the page's title or on the home page of its host.

    All three in compact form; a missing home page counts as empty.
    """
    long = F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda a: F.length(a) >= least)
    return F.exists(long, lambda a: F.contains(F.coalesce(title, F.lit("")), a) | F.contains(F.coalesce(home, F.lit("")), a))


def alternation(words: Iterable[str]) -> str:
    """One pattern of many words, the longest first, so that a longer name wins over one inside it."""
    return "|".join(re.escape(w).replace("\\ ", " ").replace("\\-", "-") for w in sorted(set(words), key=lambda w: (-len(w), w)))


def dictionary_hits(df: DataFrame, key: str, text: str, words: Iterable[str]) -> DataFrame:
    """(key, hits): the distinct words of a bounded list in each text, sorted; texts without any are left out."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("(" + alternation(words) + ")"), 1)))
    return df.select(F.col(key), found.alias("hits")).where(F.size("hits") > 0)


def gated_hits(df: DataFrame, key: str, text: str, words: Iterable[str], context: str, reach: int = 60) -> DataFrame:
    """Keys of texts in which a word stands within reach characters of the context pattern."""
    w = "(?:" + alternation(words) + ")"
    near = f"(?s)(?:{context}).{{0,{reach}}}{w}|{w}.{{0,{reach}}}(?:{context})"
    return df.where(F.col(text).rlike(near)).select(key)


def snippet(text: Column, pattern: str, before: int, after: int) -> Column:
    """The first hit with its surroundings; empty if there is none."""
    return F.regexp_extract(text, f"(?s)(.{{0,{before}}}(?:{pattern}).{{0,{after}}})", 1)


def best_occurrence(text: Column, spans: Column, bonus: str, reach: int = 40) -> Column:
    """The (start, hit) of the first match whose surroundings show the bonus pattern, else of the first match; null if there is none."""
    around = lambda s: F.substring(text, F.greatest(s["start"] - reach + 1, F.lit(1)), F.lit(2 * reach) + F.length(s["hit"]))
    ranked = F.transform(spans, lambda s: F.struct(F.when(around(s).rlike(bonus), 0).otherwise(1).alias("late"), s["start"].alias("start"), s["hit"].alias("hit")))
    best = F.get(F.array_sort(ranked), F.lit(0))
    return F.when(best.isNotNull(), F.struct(best["start"].alias("start"), best["hit"].alias("hit")))


def chunks(text: Column, boundary: str) -> Column:
    """The text cut before each boundary."""
    return F.filter(F.split(text, f"(?={boundary})"), lambda c: F.trim(c) != "")


def labels(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Labels whose pattern the text matches, joined by /, or the default."""
    found = F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(name)) for name, p in rules]))
    return F.when(F.size(found) > 0, F.array_join(found, "/")).otherwise(default)


def first_label(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The first label whose pattern matches."""
    out = F.lit(default)
    for name, p in reversed(rules):
        out = F.when(text.rlike(p), name).otherwise(out)
    return out


def nearest_before(df: DataFrame, key: str, text: str, marks: str, tokens: str, reach: int) -> DataFrame:
    """(key, place, mark, token): each match of marks with the last match of tokens that ends at most reach characters before it.

    Offsets of matches need Python; both patterns are walked once over the text, Arrow-batched.
    """
    m_, t_ = regex.compile(marks), regex.compile(tokens)
    kind = ArrayType(StructType([StructField("place", IntegerType()), StructField("mark", StringType()), StructField("token", StringType())]))

    @F.pandas_udf(kind)
    def pair(s: pd.Series) -> pd.Series:
        def one(t):
            if not isinstance(t, str):
                return None
            found = [(x.end(), x[0]) for x in t_.finditer(t)]
            ends = [e for e, _ in found]
            out = []
            for m in m_.finditer(t):
                i = bisect.bisect_right(ends, m.start()) - 1
                out.append((m.start(), m[0], found[i][1] if i >= 0 and m.start() - ends[i] <= reach else None))
            return out

        return s.map(one)

    return df.select(F.col(key), F.explode(pair(text)).alias("_p")).select(key, "_p.*")


NAME_BLOCK, NAME_CHARS = 100_000, 4_000_000  # names and their characters sent to the tasks at once


def name_mentions(df: DataFrame, key: str, text: str, names: DataFrame, name: str, least: int = 4) -> DataFrame:
    """(key, name): the names of a list that stand in each text, found by an automaton over blocks of the list.

    The list is a stated query set: each block of NAME_BLOCK names is sent to the tasks and run against all texts.
    """
    rows = names.select(name).where(F.length(name) >= least).distinct().orderBy(name)
    out = None

    def search(block: tuple[str, ...]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import ahocorasick

            a = ahocorasick.Automaton()
            for n in block:
                a.add_word(n, n)
            a.make_automaton()
            for b in batches:
                hits = [(k, n) for k, t in zip(b[key], b[text], strict=True) if isinstance(t, str) for n in sorted({n for _, n in a.iter(t)})]
                yield pd.DataFrame(hits, columns=[key, name])

        return run

    schema = f"{key} {dict(df.dtypes)[key]}, {name} string"

    def add(block: list[str], out: DataFrame | None) -> DataFrame:
        part = df.select(key, text).mapInPandas(search(tuple(block)), schema)
        return part if out is None else out.unionByName(part)

    block: list[str] = []
    chars = 0
    for r in rows.toLocalIterator():
        if block and (len(block) == NAME_BLOCK or chars + len(r[0]) > NAME_CHARS):
            out, block, chars = add(block, out), [], 0
        block.append(r[0])
        chars += len(r[0])
    if block:
        out = add(block, out)
    return out if out is not None else df.sparkSession.createDataFrame([], schema)
