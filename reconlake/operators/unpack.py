"""Several values packed in one field: one row per value with its place (problem 4).

Method: every ordinary character of a field is masked, which leaves the field's *delimiter skeleton*;
a splitting rule is resolved once per distinct skeleton; the (small, counted) rule table is joined back
and the values are cut out by position. Signs that belong to a known name, or stand inside quotes, are
moved to private code points before the skeleton is taken and moved back in the values.

Nulls and empty fields give no rows. Ties and repeated rows each give their own rows. An empty table
gives an empty result with the full schema.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconlake.functions.confusables import INVISIBLE, VARIATION, letter_class
from reconlake.session import cut, ship_package

# --- fixed values: what may separate values ---
STRONG = "|｜;；、\n\r\t"
WEAK = ",，/／・+＋"
SIGNS = STRONG + WEAK
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
# abbreviations that contain a sign and are one value
PLACEHOLDERS = ("N/A", "w/o", "c/o")

_MARK = "\ue0ff"  # stands for a number such as "1)" or "①" that starts a value
_SAFE = "".join(chr(0xE000 + i) for i in range(len(SIGNS)))
_PRIVATE = "[\ue000-\ue0ff]"
_TAKEN = "".join(chr(0xE000 + i) for i in range(256))
_ASIDE = "".join(chr(0xF000 + i) for i in range(256))  # where private signs of the data wait
_MAX_BROADCAST_RULES = 20_000  # rows; a skeleton row is under 1 kB after collapsing
_MAX_NAMES = 10_000
_LETTER = r"[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}\p{N}]"


def _cls(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "\\]^-[|/+" else c for c in chars) + "]"


def protected_patterns(names: Iterable[str]) -> list[tuple[str, list[str]]]:
    """(sign, patterns) for each sign inside a known name: the word before it in a group, the sign, and ahead the word after it."""
    gap = f"[{INVISIBLE}{VARIATION}]*"
    out: dict[str, set[str]] = {}
    for name in [*names, *PLACEHOLDERS]:
        for m in re.finditer(f"(\\w+)(\\s*)({_cls(SIGNS)})(\\s*)(?=(\\w+))", name or ""):
            left, right = (gap.join(letter_class(c) for c in m[i]) for i in (1, 5))
            blank_l, blank_r = ("\\s*" if m[i] else gap for i in (2, 4))
            wide = {"/": "[/／]", ",": "[,，]", "+": "[+＋]", ";": "[;；]", "|": "[|｜]"}.get(m[3], re.escape(m[3]))
            before = f"(?<!{_LETTER})" if m[1][0].isascii() else ""
            stem = re.search(r"(\w)\s+$", name[: m.start()])
            if before and stem:  # the name may be written without its blank
                before = f"(?:{before}|(?<={letter_class(stem[1])}))"
            after = f"(?!{_LETTER})" if m[5][-1].isascii() else ""
            out.setdefault(m[3], set()).add(f"{before}({left}{blank_l}){wide}(?={blank_r}{right}{after})")
    return [(sign, sorted(found, key=lambda p: (-len(p), p))) for sign, found in sorted(out.items())]


def known_names(registry: DataFrame, columns: Iterable[str]) -> list[str]:
    """Names of a reference list that contain a sign. The list is bounded; a larger one is refused."""
    cols = [F.col(c) for c in columns]
    names = registry.select(F.explode(F.array(*cols)).alias("n")).where(F.col("n").rlike(_cls(SIGNS))).distinct()
    rows = names.limit(_MAX_NAMES + 1).collect()
    if len(rows) > _MAX_NAMES:
        raise ValueError(f"more than {_MAX_NAMES} names contain separators")
    return sorted(r.n for r in rows)


def _masked(value: Column, names: list[str]) -> Column:
    """The field with enclosing signs removed and the signs that do not separate moved out of the way."""
    v = F.when(value.rlike(_PRIVATE), F.translate(value, _TAKEN, _ASIDE)).otherwise(value)  # the data's own private signs
    v = F.regexp_replace(v, r"(?s)^\s*\[(.*)\]\s*$", "$1")
    v = F.regexp_replace(v, r"(?s)^\s*\{(.*)\}\s*$", "$1")
    for sign, patterns in protected_patterns(names):  # one pattern a sign; the groups of alternatives that did not match are empty
        kept = "".join(f"${i + 1}" for i in range(len(patterns)))
        v = F.regexp_replace(v, "|".join(patterns), kept + _SAFE[SIGNS.index(sign)])
    n_quotes = F.length(v) - F.length(F.replace(v, F.lit('"'), F.lit("")))
    parts = F.transform(
        F.split(v, '"'),
        lambda p, i: F.when(i % 2 == 1, F.translate(p, SIGNS, _SAFE)).otherwise(p),
    )
    v = F.when((n_quotes > 0) & (n_quotes % 2 == 0), F.array_join(parts, "")).otherwise(v)
    v = F.regexp_replace(v, _cls(CIRCLED), _MARK)
    return F.regexp_replace(v, r"(?:(?<=^)|(?<=\s)|(?<=[、,;|]))[(（]?[0-9０-９]{1,2}[)）][\s　]*(?=\S)", _MARK)


def _skeleton(masked: Column, blank_splits: bool) -> Column:
    keep = SIGNS + _MARK + (" 　" if blank_splits else "")
    s = F.regexp_replace(masked, f"[^{_cls(keep)[1:-1]}]+", "w")
    s = F.regexp_replace(s, r"(?s)((?:[^w]{1,3})w)\1+", "$1")
    return F.regexp_replace(s, r"(?s)((?:[^w]{1,3})w)\1+", "$1")


def resolve_skeleton(skeleton: str, blank_splits: bool = False) -> str:
    """The splitting rule of one skeleton, as a pattern; empty if the field holds one value.

    Numbered fields split at their numbers. Otherwise every sign that the skeleton shows splits;
    signs that belong to names are not in a skeleton any more. Blanks split only in fields of codes.
    """
    if skeleton.count(_MARK) >= 2 or (skeleton.startswith(_MARK) and "w" in skeleton):
        extra = "".join(c for c in STRONG if c in skeleton)
        return _cls(_MARK + extra)
    signs = "".join(c for c in SIGNS if c in skeleton)
    if blank_splits and re.search(r"w[ 　]+w", skeleton):
        signs += " 　"
    return _cls(signs) if signs else ""


def rules_of(skeletons: DataFrame, blank_splits: bool) -> DataFrame:
    """(skeleton, rule) of the distinct skeletons."""
    ship_package(skeletons.sparkSession)

    @F.pandas_udf("string")
    def resolve(s: pd.Series) -> pd.Series:
        return s.map(lambda x: resolve_skeleton(x, blank_splits))

    return skeletons.select("_skeleton").distinct().select("_skeleton", resolve("_skeleton").alias("_rule"))


def split_values(df: DataFrame, column: str, names: list[str], blank_splits: bool = False) -> DataFrame:
    """df with the column `_values`: array of the field's values in order, empties left out.

    Null fields give null, fields of blanks only an empty array. Other columns stay as they are.
    """
    tmp = df.withColumn("_masked", _masked(F.col(f"`{column}`"), names)).withColumn("_taken", F.col(f"`{column}`").rlike(_PRIVATE))
    tmp = cut(tmp.withColumn("_skeleton", _skeleton(F.col("_masked"), blank_splits)))  # masked once, read for the rules and for the values
    plain = F.col("_skeleton").isin("w", "") | F.col("_skeleton").isNull()
    rules = cut(rules_of(tmp.where(~plain), blank_splits))
    if rules.count() <= _MAX_BROADCAST_RULES:
        rules = F.broadcast(rules)
    tmp = tmp.join(rules, "_skeleton", "left")
    rule = F.coalesce(F.when(F.col("_rule") == "", F.lit(None)).otherwise(F.col("_rule")), F.lit("\ue0fe"))
    blank = f"^[\\s\u00a0\u2000-\u200a\u202f\u3000]+|[\\s\u00a0\u2000-\u200a\u202f\u3000]+$"
    values = F.transform(F.split(F.col("_masked"), rule), lambda p: F.regexp_replace(F.translate(p, _SAFE, SIGNS), blank, ""))
    values = F.when(F.col("_taken"), F.transform(values, lambda p: F.translate(p, _ASIDE, _TAKEN))).otherwise(values)
    return tmp.withColumn("_values", F.filter(values, lambda p: p != "")).drop("_masked", "_taken", "_skeleton", "_rule")


def unpack(df: DataFrame, key: str, column: str, names: list[str], blank_splits: bool = False, least: int = 2) -> DataFrame:
    """(key, pos, val): a row per value of the fields that hold at least `least` values; pos counts from 1."""
    out = split_values(df.select(F.col(key).alias("_key"), F.col(column).alias("_field")), "_field", names, blank_splits)
    return (
        out.where(F.size("_values") >= least)
        .select(F.col("_key").alias(key), F.posexplode("_values").alias("_p", "val"))
        .select(key, (F.col("_p") + 1).cast("bigint").alias("pos"), "val")
    )
