"""Readings of kanji, learned from records of one place that write a name in kanji and by ear.

Two records with the same full address mostly name one facility; where one writes it in kanji and the other in kana
or Latin letters, the sound of the second is cut into as many pieces as the first has kanji, in every possible way, and
expectation maximisation over all such pairs finds which pieces each kanji stands for. The pairs are spread over the
tasks and only the readings themselves, at most a few for each kanji, come to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reconlake.llm.namekeys import AREA_READINGS, VARIANTS, flat, rough, sound
from reconlake.session import cut, joined

ROUNDS = 5
LONGEST = 4  # morae of one kanji
LENGTHS = (0.001, 0.25, 0.45, 0.2, 0.08)  # how likely a reading of so many morae is before anything is known
LEAST_SHARE, LEAST_COUNT = 0.05, 0.5  # of a kanji's uses, for a reading to be kept between rounds
SURE_SHARE, SURE_COUNT = 0.65, 1.8  # and to be taken over in the end
LONGEST_NAME = 24  # a longer name (in morae) is no stem and teaches nothing

_MORA = re.compile(r"n(?![aiueo])|[^aiueo]*[aiueo]")


def morae(s: str) -> list[str]:
    return _MORA.findall(s)


def core(stem: str, area: str) -> str:
    """The stem without its area word: kanji stay, everything else is in rough spelling."""
    t = stem.translate(VARIANTS).replace("さんの", "の")
    if area and t.endswith(area):
        return rough(t[: -len(area)])
    s = rough(t)
    if area:
        for x in (rough(AREA_READINGS.get(area, area)), sound(area)):
            if x and s.endswith(x) and len(s) > len(x):
                return s[: -len(x)]
    return s


def units(written: str) -> list[str]:
    """A core as kanji and, between them, morae that must be heard as they stand."""
    out: list[str] = []
    for part in re.findall(r"[一-鿿]|[^一-鿿]+", written):
        out += [part] if "一" <= part <= "鿿" else morae(flat(part))
    return out


def expected(written: str, heard: str, known: dict[str, dict[str, float]]) -> dict[tuple[str, str], float]:
    """How often each kanji is expected to stand for each piece, over all ways to cut the heard name."""
    u, m = units(written), morae(flat(heard))
    if not u or not m or len(m) > LONGEST_NAME or len(u) > LONGEST_NAME:
        return {}
    n, k = len(u), len(m)

    def weight(i: int, a: int, b: int) -> float:
        piece = "".join(m[a:b])
        if not "一" <= u[i] <= "鿿":
            return 1.0 if b == a + 1 and piece == u[i] else 0.0
        of = known.get(u[i])
        return LENGTHS[b - a] if of is None else of.get(piece, 0.0) + 1e-4 * LENGTHS[b - a]

    w = {(i, a, b): x for i in range(n) for a in range(k + 1) for b in range(a, min(k, a + LONGEST) + 1) if (x := weight(i, a, b))}
    left = [[0.0] * (k + 1) for _ in range(n + 1)]
    right = [[0.0] * (k + 1) for _ in range(n + 1)]
    left[0][0] = right[n][k] = 1.0
    for (i, a, b), x in w.items():  # in order of i
        left[i + 1][b] += left[i][a] * x
    for (i, a, b), x in reversed(w.items()):
        right[i][a] += x * right[i + 1][b]
    total = left[n][k]
    if total <= 0:
        return {}
    out: dict[tuple[str, str], float] = {}
    for (i, a, b), x in w.items():
        p = left[i][a] * x * right[i + 1][b] / total
        if p > 1e-4 and "一" <= u[i] <= "鿿":
            key = (u[i], "".join(m[a:b]))
            out[key] = out.get(key, 0.0) + p
    return out


def pairs_at_one_address(forms: DataFrame) -> DataFrame:
    """(written, heard): distinct cores of names at one full address, each in kanji with one of those without.

    forms has stem, area, city, quarter and nums. An address with many spellings pairs each with the same one, so no group
    is paired out.
    """
    @F.pandas_udf("string")
    def cores(stem: pd.Series, area: pd.Series) -> pd.Series:
        return pd.Series([core(s, a) for s, a in zip(stem, area, strict=True)], dtype=object)

    at = ["city", "quarter", "nums"]
    full = forms.where("city != '' and stem != ''").where(F.size(F.split("nums", "-")) == 3)
    c = cut(full.select(*at, cores("stem", "area").alias("core")).where("core != ''").distinct())
    kanji = F.col("core").rlike("[一-鿿]")
    heard = c.where(~kanji & F.col("core").rlike("^[a-z]+$")).groupBy(*at).agg(F.min_by("core", F.xxhash64("core")).alias("heard"))
    return joined(c.where(kanji), heard, at).select(F.col("core").alias("written"), "heard").distinct()


def learned(forms: DataFrame) -> dict[str, str]:
    """Kanji and their rough readings, where the records teach one clearly."""
    pairs = cut(pairs_at_one_address(forms))
    known: dict[str, dict[str, float]] = {}
    if pairs.isEmpty():
        return {}
    for last in range(ROUNDS):
        table = known

        def step(batches: Iterator[pd.DataFrame], table: dict = table) -> Iterator[pd.DataFrame]:
            total: dict[tuple[str, str], float] = {}
            for b in batches:
                for x, y in zip(b["written"], b["heard"], strict=True):
                    for key, p in expected(x, y, table).items():
                        total[key] = total.get(key, 0.0) + p
            yield pd.DataFrame([(k, r, n) for (k, r), n in total.items()], columns=["kanji", "reading", "n"])

        counted = pairs.mapInPandas(step, "kanji string, reading string, n double").repartition("kanji").groupBy("kanji", "reading").agg(F.sum("n").alias("n"))
        counted = counted.withColumn("uses", F.sum("n").over(Window.partitionBy("kanji")))
        share, count = (SURE_SHARE, SURE_COUNT) if last == ROUNDS - 1 else (LEAST_SHARE, LEAST_COUNT)
        kept = counted.where((F.col("n") >= share * F.col("uses")) & (F.col("n") >= count))
        rows = kept.select("kanji", "reading", (F.col("n") / F.col("uses")).alias("p")).collect()  # at most 1 / share a kanji
        known = {}
        for r in rows:
            known.setdefault(r.kanji, {})[r.reading] = r.p
    best = {k: max(sorted(of), key=of.get) for k, of in known.items()}
    return {k: r for k, r in best.items() if r}  # a kanji left out by slips teaches nothing


