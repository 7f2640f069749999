"""Quantities recorded in different units: every price in yen, tax included, for one treatment (problem 6).

Method: the history of a source (facility and plan, by time) is the sequence of the levels recorded in it, on a log
scale and for one treatment. An exact penalised changepoint search (dynamic programming with functional pruning)
segments each history; a segment whose level lies a known factor (thousands, ten thousands) off the level at which the
history's prices lie was recorded in another unit, and that change is reversed. Where a row's words name a unit, they
name the factor; where they are silent, the factor nearest to the gap is taken. Words also decide where a history
shows no shift (it is too short or all in one unit). Tax (a factor of 1.1) and the number of treatments lie well
inside the spread of the prices of one plan: no level can show them, so they come from the words alone.

A history is searched as a whole, wherever its rows lie: rows are first gathered to cells (history, day, quarter of a
decade of level, unit named) with their count, sum and sum of squares, and the search runs exactly on the sequence of
cells. A history has no more cells than its days times some sixty, however many rows one of them holds, and the rows
themselves are never brought to one task. The result does not depend on partitions.

Nulls: without amount and without a price in words a row has no price; without any statement on tax it
has none either. Rows without a source or a time belong to the history of the empty source, or the empty day.
Repeated rows are converted row by row. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from reconlake.functions.confusables import narrow
from reconlake.session import bounded, cut, ship_package

PENALTY = 2.0  # cost of one more segment, in squared log10 units
KNOWN_FACTORS = (3.0, 4.0)  # log10: thousands and ten thousands of yen
TOLERANCE = 0.75  # log10; mean of a segment against its history; the prices of one plan differ by less than 1.5
CELL = 0.25  # log10; width of the levels gathered in one cell
MAX_SHIFTS = 200_000  # cells of shifted segments up to which their (counted) table is broadcast; beyond, it is shuffled
#: what it costs to take a row that names no unit for one in that unit, in squared log10 units
RARE = {0.0: 0.0, 3.0: 0.25, 4.0: 0.45, -3.0: 0.5, -4.0: 0.6}

# --- fixed values: words that state tax, scale and number of treatments ---
TAX_IN = re.compile(r"税込|内税|税金込|incl(?:\.|uding)?\s*tax|tax\s*incl", re.I)
TAX_OUT = re.compile(r"税別|税抜|外税|別途消費税|消費税別|\+\s*税|excl(?:\.|uding)?\s*tax|tax\s*excl|plus\s*tax", re.I)
THOUSAND = re.compile(r"(?<![0-9.一二三四五六七八九十百万,])千円|K円|[×xX*]\s*1,?000\s*円|単位[:：]?\s*千|千円単位")
TEN_THOUSAND = re.compile(r"(?<![0-9.一二三四五六七八九十百千,])万(?:円)?|[×xX*]\s*10,?000\s*円|単位[:：]?\s*万")
NOTE = re.compile(r"\([^()]*(?:採血|場合|分\s*/\s*回|ml)[^()]*\)", re.I)
COURSE = re.compile(r"クール\s*\(?\s*([0-9]+|[一二三四五六七八九十百]+)\s*回")
TIMES = re.compile(r"(?<![0-9.,])([0-9]+|[一二三四五六七八九十百]+)\s*(?:回|セッション|sessions?|times|treatments?)", re.I)
LATER = re.compile(r"([0-9]+|[一二三四五六七八九十]+)\s*回目")
DIGIT = {c: i for i, c in enumerate("〇一二三四五六七八九")}
STEP = {"十": 10, "百": 100, "千": 1000}
_NUM = r"[0-9〇一二三四五六七八九十百千万億][0-9,.〇一二三四五六七八九十百千万億]*"
PRICE = re.compile(rf"(?:¥\s*({_NUM})|({_NUM})\s*円)")


def number(text: str) -> float | None:
    """Value of a number in digits, kanji or both ('4万8,000', '千九十六万二千', '7.4万'); None if it is none."""
    total = section = 0.0
    digits, plain, seen = "", None, False
    for ch in text.replace(",", ""):
        if ch.isdigit() or ch == ".":
            digits += ch
            seen = True
        elif ch in DIGIT:
            digits += str(DIGIT[ch])
            seen = True
        elif ch in STEP or ch in "万億":
            try:
                plain = float(digits) if digits else None
            except ValueError:
                return None
            digits = ""
            if ch in STEP:
                section += (1 if plain is None else plain) * STEP[ch]
            else:
                section += plain or 0
                if not section:
                    return None
                total += section * (1e4 if ch == "万" else 1e8)
                section = 0.0
            seen = True
        else:
            return None
    try:
        section += float(digits) if digits else 0
    except ValueError:
        return None
    return total + section if seen else None


def read_statement(tax: str | None, unit: str | None) -> tuple[int | None, float | None, int, float | None]:
    """What tax and unit state: (tax included 1, excluded 0, untold None; scale or None; treatments; price in words)."""
    t, u = narrow(tax or ""), narrow(unit or "").strip()
    told = None
    for text in (t, u):
        told = 1 if TAX_IN.search(text) else 0 if TAX_OUT.search(text) else None
        if told is not None:
            break
    core = NOTE.sub("", u)
    scale = 1e3 if THOUSAND.search(core) else 1e4 if TEN_THOUSAND.search(core) else None
    count = 1
    m = COURSE.search(core) or (None if LATER.search(core) else TIMES.search(core))
    if m:
        count = int(number(m[1]) or 1)
    price = None
    for m in PRICE.finditer(core):
        if core[: m.start()].rstrip()[-1:] in ("×", "x", "X", "*"):
            continue
        value = number(m[1] or m[2])
        if value and (m[1] or m[2]) not in ("千", "万"):
            price = value
            break
    if price is None and (m := re.fullmatch(rf"\s*({_NUM}[万千])\s*", core)) and m[1] not in ("千", "万"):
        price = number(m[1])
    return told, scale, max(count, 1), price


_STATED = StructType([StructField("told", IntegerType()), *[StructField(n, DoubleType()) for n in ("named", "treatments", "words")]])


@F.pandas_udf(_STATED)
def statements(tax: pd.Series, unit: pd.Series) -> pd.DataFrame:
    """read_statement of each row, once for each distinct pair of a batch; `named` is the log10 of the unit named."""
    seen: dict[tuple, tuple] = {}
    out = []
    for pair in zip(tax, unit, strict=True):
        got = seen.get(pair)
        if got is None:
            told, scale, count, words = read_statement(*(x if isinstance(x, str) else None for x in pair))
            got = seen[pair] = (told, None if scale is None else float(np.log10(scale)), float(count), words)
        out.append(got)
    told, named, treatments, words = zip(*out, strict=True) if out else ((), (), (), ())
    return pd.DataFrame({
        "told": pd.array(told, dtype="Int32"), "named": pd.array(named, dtype="Float64"),
        "treatments": pd.array(treatments, dtype="Float64"), "words": pd.array(words, dtype="Float64"),
    })


def segments(x: np.ndarray, penalty: float = PENALTY, n: np.ndarray | None = None, squares: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Exact optimal partitioning by squared error plus penalty a segment: [start, end) pairs.

    x are the means of cells of n values each (one each if not given), squares the sums of their squares. Functional
    pruning: the line of levels is kept in pieces, each with the start of the last segment that is best there; there
    are few pieces however long a segment is.
    """
    size = len(x)
    n = np.ones(size) if n is None else n
    squares = n * x * x if squares is None else squares
    zero = [0.0]
    s0, s1, s2 = (np.concatenate([zero, np.cumsum(v)]).tolist() for v in (n, n * x, squares))
    low, high = float(x.min()), float(x.max())
    best, last = [-penalty] + [0.0] * size, [0] * (size + 1)
    pieces = [(low, high, 0)]
    for t in range(1, size + 1):
        least, start, costs = np.inf, 0, []
        for lo, hi, k in pieces:
            m, b = s0[t] - s0[k], s1[t] - s1[k]
            mean = b / m
            floor = best[k] + penalty + (s2[t] - s2[k]) - b * mean
            at = min(max(mean, lo), hi)
            value = floor + m * (at - mean) ** 2
            costs.append((mean, floor, m))
            if value < least:
                least, start = value, k
        best[t], last[t] = least, start
        new = []
        for (lo, hi, k), (mean, floor, m) in zip(pieces, costs, strict=True):
            room = least + penalty - floor
            half = (room / m) ** 0.5 if room >= 0 else -1.0
            a, z = max(lo, mean - half), min(hi, mean + half)
            parts = [(lo, a, t), (a, z, k), (z, hi, t)] if half >= 0 and a <= z else [(lo, hi, t)]
            for u, v, j in parts:
                if v > u or lo == hi and j == k:
                    if new and new[-1][2] == j:
                        new[-1] = (new[-1][0], v, j)
                    else:
                        new.append((u, v, j))
        pieces = new
    out, t = [], size
    while t > 0:
        out.append((last[t], t))
        t = last[t]
    return out[::-1]


def price_level(x: np.ndarray, n: np.ndarray, named: np.ndarray, usual: float) -> float:
    """The level at which the prices of a history lie: the one from which its cells, each in its likeliest unit, are least away.

    named is the log10 of the unit a cell's rows name, NaN for none; the usual level of all data counts as one more row.
    """
    free = np.isnan(named)
    options = [np.where(free, x + f, np.nan) for f in RARE] + [np.where(free, np.nan, x + np.nan_to_num(named))]
    costs = [*RARE.values(), 0.0]
    true = np.stack(options)
    grid = np.append(np.unique(np.round(true[~np.isnan(true)] / CELL) * CELL), usual)
    extra = np.array(costs)[:, None]
    total = np.minimum((grid - usual) ** 2, 4.0)
    for lo in range(0, len(grid), step := max(1, 100_000 // true.size)):  # some levels at once, so that memory stays small
        each = np.minimum((true[None] - grid[lo : lo + step, None, None]) ** 2, 1.0) + extra
        total[lo : lo + step] += np.nanmin(each, axis=1) @ n
    a = grid[total.argmin()]
    which = np.nanargmin(np.minimum((true - a) ** 2, 1.0) + extra, axis=0)
    chosen = true[which, np.arange(len(x))]
    close = np.abs(chosen - a) <= 1.0
    return float((n * chosen)[close].sum() / n[close].sum()) if close.any() else float(a)


def unit_shifts(x: np.ndarray, n: np.ndarray, squares: np.ndarray, named: np.ndarray, usual: float) -> np.ndarray:
    """log10 factor that reverses the change of unit of each cell in a shifted segment, 0 for the others.

    The cells are those of one history in order of time; a named unit is the factor of its cell if its segment is shifted.
    """
    level = price_level(x, n, named, usual)
    shift = np.zeros(len(x))
    for a, b in segments(x, n=n, squares=squares):
        gap = level - (n[a:b] * x[a:b]).sum() / n[a:b].sum()
        if min(abs(abs(gap) - f) for f in KNOWN_FACTORS) > TOLERANCE:
            continue
        signs = [f for f in RARE if f * gap > 0]
        own = np.stack([(level - x[a:b] - f) ** 2 + RARE[f] for f in signs]).argmin(axis=0)
        shift[a:b] = np.where(np.isnan(named[a:b]), np.array(signs)[own], np.nan_to_num(named[a:b]))
    return shift


def _search(usual: float):
    """Shifts of the cells of whole histories; a partition is sorted by source, and the history open at the end of a batch waits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush(rows: pd.DataFrame) -> pd.DataFrame:
            key = rows["source"].to_numpy()
            n, sums, squares, named = (rows[c].to_numpy(dtype=float, na_value=np.nan) for c in ("n", "s1", "s2", "named"))
            shift = np.zeros(len(rows))
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                shift[a:b] = unit_shifts(sums[a:b] / n[a:b], n[a:b], squares[a:b], named[a:b], usual)
            out = rows[["source", "day", "cell", "unit"]].assign(shift=shift)
            return out[shift != 0]

        for rows in batches:
            if not len(rows):
                continue
            tail = rows["source"].iloc[-1]
            open_ = (rows["source"] == tail).to_numpy()
            if not open_.all():
                yield flush(pd.concat([*held, rows[~open_]], ignore_index=True))
                held = []
            elif held and held[-1]["source"].iloc[-1] != tail:
                yield flush(pd.concat(held, ignore_index=True))
                held = []
            held.append(rows[open_])
        if held:
            yield flush(pd.concat(held, ignore_index=True))

    return run


def in_yen(prices: DataFrame) -> DataFrame:
    """(row_id, amount, yen, factor, decided): yen is null where the price cannot be told.

    factor is the change of unit that was reversed; decided tells by what: 'segment' (words silent), 'segment and words',
    'words' (the history shows no shift), or null where nothing had to be reversed.
    """
    ship_package(prices.sparkSession)
    said = prices.select(
        "row_id", F.col("amount").cast("bigint").alias("amount"), statements("tax", "unit").alias("s"),
        F.concat_ws("\u001f", F.coalesce("facility_id", F.lit("")), F.coalesce("plan_id", F.lit(""))).alias("source"),
        F.coalesce(F.unix_date(F.to_date("checked_at")), F.lit(-(1 << 30))).alias("day"),
    )
    value = F.coalesce(F.col("amount").cast("double"), F.col("s.words"))
    named = F.when(F.col("amount").isNull(), F.lit(0.0)).otherwise(F.col("s.named"))
    rows = said.select("row_id", "amount", "source", "day", "s.told", "s.treatments", value.alias("value"), named.alias("named"))
    rows = rows.withColumn("level", F.when(F.col("value") > 0, F.log10(F.col("value") / F.col("treatments"))))
    rows = rows.withColumn("cell", F.floor(F.col("level") / CELL).cast("int")).withColumn("unit", F.coalesce(F.col("named").cast("int"), F.lit(-1)))
    key = ["source", "day", "cell", "unit"]
    cells = rows.where("level is not null").groupBy(*key).agg(
        F.first("named").alias("named"), F.count("*").cast("double").alias("n"), F.sum("level").alias("s1"), F.sum(F.col("level") ** 2).alias("s2")
    )
    cells = cut(cells)
    # the usual level: the median of a histogram with one bar for each quarter of a decade
    true = (F.col("cell") + 0.5) * CELL + F.coalesce("named", F.lit(0.0))
    bars = sorted((r.v, r.n) for r in cells.groupBy(true.alias("v")).agg(F.sum("n").alias("n")).collect())
    half, usual = sum(n for _, n in bars) / 2, 0.0
    for v, n in bars:
        half -= n
        if half <= 0:
            usual = v
            break
    # in a history whose levels, named or not, all lie within a known factor of each other and of the usual one, nothing can be shifted
    low, high = ((F.col("cell") + i) * CELL for i in (0, 1))
    wide = cells.groupBy("source").agg(
        (F.greatest(F.max(high), F.max(high + F.coalesce("named", F.lit(0.0))), F.lit(usual)) - F.least(F.min(low), F.lit(usual))).alias("w")
    ).where(F.col("w") >= min(KNOWN_FACTORS) - TOLERANCE).select("source")
    n = int(prices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    searched = cells.join(wide, "source", "left_semi").repartition(n, "source").sortWithinPartitions(*key)
    shifts = searched.mapInPandas(_search(usual), "source string, day int, cell int, unit int, shift double")
    marked = rows.join(bounded(cut(shifts), MAX_SHIFTS), key, "left")
    factor = F.coalesce("named", "shift", F.lit(0.0))
    total = F.round(F.col("value") * F.pow(F.lit(10.0), factor))
    count = F.col("treatments")
    # (total * 11) / (10 * count) where tax is left out; half a yen rounds up
    yen = F.when(F.col("told") == 1, F.floor((2 * total + count) / (2 * count))).when(F.col("told") == 0, F.floor((22 * total + 10 * count) / (20 * count)))
    words = F.col("amount").isNotNull() & F.col("named").isNotNull()
    decided = F.when(F.col("shift").isNotNull() & words, "segment and words").when(F.col("shift").isNotNull() & F.col("named").isNull(), "segment").when(words, "words")
    return marked.select(
        "row_id", "amount", F.when(F.col("level").isNotNull(), yen).cast("bigint").alias("yen"),
        F.pow(F.lit(10.0), factor).alias("factor"), decided.alias("decided"),
    )


def restated(prices: DataFrame) -> DataFrame:
    """(row_id, yen) of the rows whose price can be told and is not what amount holds."""
    return in_yen(prices).where(F.col("yen").isNotNull() & ~F.col("amount").eqNullSafe(F.col("yen"))).select("row_id", "yen")
