"""Best match of each text within a block: bounds of all pairs by one product of matrices, exact scores best first.

A block is cut into cells of at most CELL rows of either side; a cell is one group of a cogroup in Python. The characters two
texts have in common (counted with repeats) bound every score here from above. The product of two tables of counts gives
that number, or more, for all pairs of a cell; each left row then takes its pairs in the order of their bounds (of equal
ones the lower right id first) until no bound reaches its best score, so no pair that could win is left out.
"""

from __future__ import annotations

import difflib
from collections import Counter
from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconlake.session import joined

CELL = 16_384  # rows of either side in a cell
DIMS, SHARED = 256, 64  # columns of the counts; the rarer characters share the last ones, which can only raise a bound
PAIRS_AT_ONCE = 6_000_000  # bounds held at a time
PAIRS_A_TASK = 20_000_000
SLOTS = 10_000  # blocks up to which their (counted) sizes are broadcast; beyond, they are shuffled
KNOWN = 200_000  # similarities kept
FEW = 2_000  # pairs of other texts that are each searched on their own
FLOORS = (0.5, 0.25)  # names at least so alike are searched first where less alike ones count too; what they find leaves out most of the others


class Texts:
    """Texts as code points, one after the other."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.n = np.array([len(t) for t in texts], dtype=np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.n)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def columns(self, rows: np.ndarray) -> np.ndarray:
        """A column of code points for each row, filled up beyond the end of the shorter ones."""
        width = int(self.n[rows].max(initial=0))
        if not width:
            return np.zeros((0, len(rows)), np.uint32)
        return self.codes[np.minimum(self.at[rows] + np.arange(width)[:, None], len(self.codes) - 1)]


def counts(*sides: list[str]) -> list[np.ndarray]:
    """A table of counts for each list of texts; the product of two rows is at least the number of common characters."""
    tokens = [[[(ch, k) for ch, n in Counter(t).items() for k in range(n)] for t in side] for side in sides]
    ranked = Counter(x for side in tokens for t in side for x in t).most_common()
    own = DIMS - SHARED
    column = {x: i if i < own else own + i % SHARED for i, (x, _) in enumerate(ranked)}
    out = []
    for side in tokens:
        table = np.zeros((len(side), DIMS), np.float32)
        rows = np.repeat(np.arange(len(side)), [len(t) for t in side])
        np.add.at(table, (rows, np.array([column[x] for t in side for x in t], dtype=np.int64)), 1)
        out.append(table)
    return out


def aligned(a: Texts, b: Texts, i: np.ndarray, j: np.ndarray, kind: str) -> np.ndarray:
    """Of each pair (a[i], b[j]) the edit distance ("edit") or the length of the longest common subsequence ("common")."""
    out = np.zeros(len(i), np.int64)
    longest = np.maximum(a.n[i], b.n[j])
    order = np.argsort(longest, kind="stable")
    start = 0
    while start < len(order):
        width = int(longest[order[min(start + 32_768, len(order)) - 1]])
        rows = order[start : start + max(1, min(32_768, 2_000_000 // max(1, width)))]
        start += len(rows)
        x, y = a.columns(i[rows]), b.columns(j[rows])
        la, lb = a.n[i[rows]], b.n[j[rows]]
        steps = np.arange(len(y) + 1, dtype=np.int32)[:, None]
        row = np.repeat(steps, len(rows), 1) if kind == "edit" else np.zeros((len(y) + 1, len(rows)), np.int32)
        got = row[lb, np.arange(len(rows))].copy()
        for k in range(len(x)):
            same = y == x[k]
            new = np.empty_like(row)
            if kind == "edit":
                new[0] = k + 1
                np.minimum(row[1:] + 1, row[:-1] + ~same, out=new[1:])
                row = np.minimum.accumulate(new - steps) + steps
            else:
                new[0] = 0
                np.maximum(row[1:], row[:-1] + same, out=new[1:])
                row = np.maximum.accumulate(new)
            ends = np.flatnonzero(la == k + 1)
            got[ends] = row[lb[ends], ends]
        out[rows] = got
    return out


def rounded(x: np.ndarray, digits: int | None) -> np.ndarray:
    """As Spark rounds: halves of the decimal form go up."""
    if digits is None:
        return x
    y = x * 10.0**digits
    out = np.floor(y + 0.5) / 10.0**digits
    for k in np.flatnonzero(np.abs(y - np.floor(y) - 0.5) < 1e-6):
        out[k] = float(Decimal(repr(float(x[k]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    return out


def search(x: np.ndarray, y: np.ndarray, rows: np.ndarray, columns: np.ndarray, least_common: np.ndarray, best: np.ndarray, place: np.ndarray, bound: Callable, exact: Callable) -> None:
    """Sets best (score) and place (row of y) of the given rows of x to the best among the given rows of y, in order; of equal ones the first counts.

    Pairs with fewer common characters than a row's least_common are left out, and those that do not reach the row's `best`.
    bound(i, j, common) is never under the score of a pair; exact(i, j, best, place) gives the scores, or anything lower
    for a pair that cannot win against these.
    """
    if not len(rows) or not len(columns):
        return
    size, y = max(1, PAIRS_AT_ONCE // len(columns)), y[columns].T
    for start in range(0, len(rows), size):
        part = rows[start : start + size]
        common = x[part] @ y
        flat = np.flatnonzero(common >= (least_common[start : start + size, None] - 0.01).astype(np.float32))
        i, j = np.divmod(flat, len(columns))
        i, j = part[i], columns[j]
        up = bound(i, j, common.ravel()[flat].astype(np.float64))
        del common, flat
        turn, width = 0, 1
        while True:
            live = (up > best[i]) | ((up == best[i]) & (j < place[i]))
            i, j, up = i[live], j[live], up[live]
            if not len(i):
                break
            if turn == 4:
                order = np.lexsort((j, -up, i))
                i, j, up = i[order], j[order], up[order]
            new = np.concatenate([[True], i[1:] != i[:-1]])
            first, row = np.flatnonzero(new), np.cumsum(new) - 1
            if turn < 4:  # one pair a row
                hit = np.flatnonzero(up == np.maximum.reduceat(up, first)[row])
                hit = hit[np.concatenate([[True], i[hit][1:] != i[hit][:-1]])]
            else:
                hit = np.flatnonzero(np.arange(len(i)) - first[row] < width)
                width *= 2
            turn += 1
            score = exact(i[hit], j[hit], best, place)
            order = np.lexsort((j[hit], -score, i[hit]))
            a, b, s = i[hit][order], j[hit][order], score[order]
            top = np.concatenate([[True], a[1:] != a[:-1]])
            a, b, s = a[top], b[top], s[top]
            wins = (s > best[a]) | ((s == best[a]) & (b < place[a]))
            best[a[wins]], place[a[wins]] = s[wins], b[wins]
            rest = np.ones(len(i), bool)
            rest[hit] = False
            i, j, up = i[rest], j[rest], up[rest]


class Ratio:
    """Ratcliff-Obershelp similarity of pairs of two lists, each pair of texts once."""

    def __init__(self, a: list[str], b: list[str]) -> None:
        self.a, self.b, self.known = Texts(a), Texts(b), {}
        self.same_a, self.same_b = (pd.factorize(np.array(t, dtype=object))[0] for t in (a, b))
        self.matcher, self.second = difflib.SequenceMatcher(None), None

    def bound(self, i: np.ndarray, j: np.ndarray, common: np.ndarray) -> np.ndarray:
        n = self.a.n[i] + self.b.n[j]
        return 2.0 * np.minimum(common, np.minimum(self.a.n[i], self.b.n[j])) / n

    def closer(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """A closer bound: what matches is a common subsequence."""
        return 2.0 * aligned(self.a, self.b, i, j, "common") / (self.a.n[i] + self.b.n[j])

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i))
        for k in np.argsort(j, kind="stable"):
            key = (self.same_a[i[k]], self.same_b[j[k]])
            got = self.known.get(key)
            if got is None:
                x, y = self.a.texts[i[k]], self.b.texts[j[k]]
                if x == y:
                    got = 1.0
                else:
                    if self.second != y:
                        self.matcher.set_seq2(y)
                        self.second = y
                    self.matcher.set_seq1(x)
                    got = self.matcher.ratio()
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[key] = got
            out[k] = got
        return out


def best_texts(left: list[str], right: list[str], least: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(scores, places): search() of all pairs by edit distance ("edit", rounded to four digits) or Ratcliff-Obershelp ("ratio"); no text is empty. The place is len(right) where none reaches `least`."""
    ratio = Ratio(left, right)
    a, b = ratio.a, ratio.b
    x, y = counts(left, right)
    best, place = least.copy(), np.full(len(left), len(right))
    every = np.arange(len(left)), np.arange(len(right))
    if kind == "edit":
        def bound(i: np.ndarray, j: np.ndarray, common: np.ndarray) -> np.ndarray:
            n = np.maximum(a.n[i], b.n[j])
            return rounded(1 - (n - np.minimum(common, np.minimum(a.n[i], b.n[j]))) / n, 4)

        def exact(i: np.ndarray, j: np.ndarray, best: np.ndarray, place: np.ndarray) -> np.ndarray:
            return rounded(1 - aligned(a, b, i, j, "edit") / np.maximum(a.n[i], b.n[j]), 4)

        search(x, y, *every, (least - 1e-4) * a.n, best, place, bound, exact)
        return best, place

    def judged(i: np.ndarray, j: np.ndarray, best: np.ndarray, place: np.ndarray) -> np.ndarray:
        up = ratio.closer(i, j)
        can = (up > best[i]) | ((up == best[i]) & (j < place[i]))
        out = np.full(len(i), -1.0)
        out[can] = ratio.of(i[can], j[can])
        return out

    search(x, y, *every, least * a.n / (2 - least), best, place, ratio.bound, judged)
    return best, place


def best_by_two(names: list[str], whats: list[str], names2: list[str], whats2: list[str], least: float, least_name: float, ids: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """(scores, places) of search() by the score of linkage.best_by_two_names, and the similarities of names and of other texts of the rows with a match.

    With the ids of both sides, rows of an equal id do not meet.
    """
    by_name, by_what = Ratio(names, names2), Ratio(whats, whats2)
    a, b = by_name.a, by_name.b
    x, y = counts(names, names2)
    few = (by_what.same_a.max() + 1) * (by_what.same_b.max() + 1) <= FEW
    if few:  # all similarities of the other texts at once
        _, first_a = np.unique(by_what.same_a, return_index=True)
        _, first_b = np.unique(by_what.same_b, return_index=True)
        p, q = (z.ravel() for z in np.meshgrid(first_a, first_b, indexing="ij"))
        table = by_what.of(p, q).reshape(len(first_a), len(first_b))
    else:
        xw, yw = counts(whats, whats2)
    first = {w: k for k, w in enumerate(dict.fromkeys([*whats, *whats2]))}
    code, code2 = (np.array([first[w] for w in t]) for t in (whats, whats2))

    def total(n: np.ndarray, w: np.ndarray, equal: np.ndarray, inside: np.ndarray, same: np.ndarray) -> np.ndarray:
        bonus = np.where(equal, 0.12, np.where(inside, 0.05, 0.0)) + np.where(same, 0.10, 0.0)
        return np.where(n >= least_name, rounded(np.minimum(1.0, 0.44 * n + 0.56 * w + bonus), 6), -1.0)

    def what(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return table[by_what.same_a[i], by_what.same_b[j]] if few else by_what.of(i, j)

    def bound(i: np.ndarray, j: np.ndarray, common: np.ndarray) -> np.ndarray:
        if not len(i):
            return common
        if few:
            w = what(i, j)
        else:
            n, m = by_what.a.n[i], by_what.b.n[j]
            both = (xw[i[0] : i[-1] + 1] @ yw.T)[i - i[0], j]  # rows are in order
            w = np.where(n + m == 0, 1.0, 2.0 * np.minimum(both, np.minimum(n, m)) / np.maximum(n + m, 1))
        shorter = np.minimum(a.n[i], b.n[j])
        up = total(by_name.bound(i, j, common), w, (common >= a.n[i]) & (a.n[i] == b.n[j]), common >= shorter, code[i] == code2[j])
        if ids is not None:
            up[ids[0][i] == ids[1][j]] = -1.0
        return up

    def inside(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.array([a.texts[k] in b.texts[m] or b.texts[m] in a.texts[k] for k, m in zip(i, j, strict=True)], dtype=bool)

    def exact(i: np.ndarray, j: np.ndarray, best: np.ndarray, place: np.ndarray) -> np.ndarray:
        equal, within, same = by_name_equal(i, j), inside(i, j), code[i] == code2[j]
        w = what(i, j)
        up = total(by_name.closer(i, j), w, equal, within, same)
        can = np.flatnonzero((up > best[i]) | ((up == best[i]) & (j < place[i])))
        out = np.full(len(i), -1.0)
        out[can] = total(by_name.of(i[can], j[can]), w[can], equal[can], within[can], same[can])
        return out

    known = {n: k for k, n in enumerate(dict.fromkeys([*names, *names2]))}
    own, own2 = (np.array([known[n] for n in t]) for t in (names, names2))
    by_name_equal = lambda i, j: own[i] == own2[j]
    score, at = np.full(len(names), least), np.full(len(names), len(names2))

    def within(rows: np.ndarray, columns: np.ndarray, most: float) -> None:
        """Search where names that are not equal can add at most `most` to 0.44 of their similarity."""
        above = np.inf
        for floor in (*[f for f in FLOORS if f > least_name], least_name):
            need = (score[rows] - 1e-6 - most) / 0.44
            can = (need <= 1 + 0.07 / 0.44) & (need < above)  # equal names add 0.07 more
            rows, need = rows[can], np.clip(need[can], floor, 1.0)
            search(x, y, rows, columns, need * a.n[rows] / (2 - need), score, at, bound, exact)
            above = floor

    if few:  # the most similar texts first, so that their scores leave out the others
        for p in range(len(table)):
            rows = np.flatnonzero(by_what.same_a == p)
            for q in np.argsort(-table[p], kind="stable"):
                equal = code[first_a[p]] == code2[first_b[q]]
                within(rows, np.flatnonzero(by_what.same_b == q), 0.56 * table[p, q] + 0.10 * equal + 0.05)
    else:
        within(np.arange(len(names)), np.arange(len(names2)), 0.56 + 0.10 + 0.05)
    rows = np.flatnonzero(at < len(names2))
    return score, at, by_name.of(rows, at[rows]), what(rows, at[rows])


def in_cells(left: DataFrame, right: DataFrame, slot: str, each: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """each(left rows, right rows) of every cell; all pairs of rows with an equal slot come together in one cell."""
    sizes = joined(left.groupBy(slot).agg(F.count("*").alias("_nl")), right.groupBy(slot).agg(F.count("*").alias("_nr")), slot)
    cells = lambda n: F.ceil(F.col(n) / CELL).cast("int")
    work = sizes.agg(F.sum(F.col("_nl").cast("double") * F.col("_nr")), F.sum(cells("_nl").cast("bigint") * cells("_nr")), F.count("*")).first()
    tasks = int(max(1, min(work[1] or 1, (work[0] or 0) // PAIRS_A_TASK + 1, 2000)))
    sizes = sizes.select(slot, cells("_nl").alias("_cl"), cells("_nr").alias("_cr"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda df, n: F.pmod(F.xxhash64(*df.columns), F.col(n)).cast("int")
    sized = lambda df: df.join(F.broadcast(sizes), slot) if work[2] <= SLOTS else joined(df, sizes, slot)
    l = sized(left).withColumn("_i", own(left, "_cl")).withColumn("_j", upto("_cr")).drop("_cl", "_cr")
    r = sized(right).withColumn("_j", own(right, "_cr")).withColumn("_i", upto("_cl")).drop("_cl", "_cr")
    key = [slot, "_i", "_j"]
    return l.repartition(tasks, *key).groupBy(*key).cogroup(r.repartition(tasks, *key).groupBy(*key)).applyInPandas(each, schema)
