"""Evaluation texts leaking into training text (problem 7).

Method: rare n-gram seeds of the test items are looked up in every document; documents and items that share
enough seeds are joined; a Smith-Waterman alignment, weighted by how particular each place of the item is,
scores how much of the item the document repeats in order. Wording that many items share weighs little.

A document may repeat an item in several far parts: every stretch with seeds is aligned, and the passages that follow
each other both in the document and in the item are chained and their scores added.

The items are a stated query set against all documents, taken in blocks of at most ITEM_BLOCK items or about BLOCK_CHARS
characters, so what is sent to the tasks and held by the driver is bounded; how rare a gram is counts over all items,
in a distributed count, and the result is the same for every size of block. Whole texts are searched. Every document
and item that share enough seeds are aligned, however many documents hold the same seeds; equal passages of an item
are aligned once for each batch of documents.

Items of equal normal text are one item with several ids. Near copies of one item have few rare grams: their seeds are
extended by the next rarest until the rest of the item weighs less than LEAK_SHARE - SEED_SHARE, so that every unedited
leak keeps enough seeds.

Null or empty texts and items match nothing; repeated documents each get their rows; empty tables give none.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reconlake.session import cut, ship_package

ITEM_BLOCK = 4000
BLOCK_CHARS = 2_000_000
WIDE_SCRIPT = 6  # seed length in characters for text in kana and kanji
NARROW_SCRIPT = 11  # and for text in Latin letters
SHARED_BY = 4  # a gram that at most this many different items contain is a seed; a commoner one only where its item needs it
PLACE = {6: 3, 11: 5}  # by seed length: length of the n-gram that tells how particular a place is
SEED_SHARE = 0.12  # share of an item's weight that its seeds in a document must cover to be aligned
LEAK_SHARE = 0.38  # aligned share of an item's weight from which it counts as leaked
PART = 0.08  # least aligned share of a passage that is chained to others
MAX_PAIRS = 20_000  # pairs of documents and items that wait for their alignment in one task
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22

_JUNK = regex.compile(r"[^\p{L}\p{N}]+")


def plain(text: str | None) -> str:
    """Letters and digits only, in one width and case."""
    if not text:
        return ""
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return _JUNK.sub("", text).lower()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)


def grams(c: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n-gram of a code sequence."""
    if len(c) < n:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(len(c) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h *= _MIX
            h += c[k : len(c) - n + 1 + k]
        h ^= h >> np.uint64(29)
        h *= _MIX
    return h


def seed_length(text: str) -> int:
    wide = sum(ord(ch) > 0x2E80 for ch in text)
    return WIDE_SCRIPT if wide * 2 > len(text) else NARROW_SCRIPT


class Counts:
    """In how many texts each gram stands, by gram length."""

    def __init__(self, of: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        self.of = of

    @staticmethod
    def grams_of(text: str) -> Iterator[tuple[int, np.ndarray]]:
        """(length, distinct grams) of one text: its seeds and what tells how particular its places are."""
        n = seed_length(text)
        for size in {n, PLACE[n]}:
            yield size, np.unique(grams(codes(text), size))

    @classmethod
    def read(cls, rows: Iterable[tuple[int, int, int]]) -> Counts:
        """From (length, gram as signed number, count)."""
        n, g, c = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) if rows else (np.empty(0, dtype=np.int64),) * 3
        of = {}
        for size in sorted({*PLACE, *PLACE.values()}):
            keys = g[n == size].view(np.uint64)
            order = np.argsort(keys)
            of[size] = (keys[order], c[n == size][order])
        return cls(of)

    def get(self, n: int, g: np.ndarray) -> np.ndarray:
        keys, count = self.of[n]
        return count[np.searchsorted(keys, g)] if len(g) else np.empty(0, dtype=np.int64)


class Items:
    """Test items of one block, (normal text, key): place weights and seeds."""

    def __init__(self, rows: list[tuple[str, int]], counts: Counts) -> None:
        self.ids, self.text, self.weight = [], [], []
        seeds: dict[int, dict[int, list[tuple[int, int]]]] = {WIDE_SCRIPT: {}, NARROW_SCRIPT: {}}
        for k, (t, key) in enumerate(rows):
            n = seed_length(t)
            local = counts.get(PLACE[n], grams(codes(t), PLACE[n])).astype(float)
            local = local if len(local) else np.ones(1)
            pad = (PLACE[n] - 1) // 2
            centred = np.concatenate([np.full(pad, local[0]), local, np.full(max(0, len(t) - pad - len(local)), local[-1])])[: len(t)]
            self.ids.append(key)
            self.text.append(t)
            self.weight.append(centred**-1.0)
            own = grams(codes(t), n)
            for p in self._seed_places(self.weight[-1], counts.get(n, own), n):
                seeds[n].setdefault(int(own[p]), []).append((k, p))
        self.total = np.array([w.sum() for w in self.weight])
        self.lookup = {}
        self.gram_of = []
        for n, table in seeds.items():
            keep = sorted(table)
            keys = np.array(keep, dtype=np.uint64)
            bits = np.zeros(1 << _TABLE_BITS, dtype=bool)
            bits[keys >> np.uint64(64 - _TABLE_BITS)] = True
            base = len(self.gram_of)
            self.gram_of += [(n, table[g]) for g in keep]
            self.lookup[n] = (keys, bits, base)

    @staticmethod
    def _seed_places(weight: np.ndarray, count: np.ndarray, n: int) -> list[int]:
        """Places of the grams that at most SHARED_BY texts have, and of the next rarest until the rest weighs too little to be a leak alone."""
        out, bare = [], np.ones(len(weight), dtype=bool)
        spare = (LEAK_SHARE - SEED_SHARE) * weight.sum()
        order = np.argsort(count, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(count[order])) + 1) if len(order) else []:
            if count[at[0]] > SHARED_BY and weight[bare].sum() <= spare:
                break
            for p in at.tolist():
                out.append(p)
                bare[p : p + n] = False
        return out

    def hits(self, text: str) -> dict[int, list[tuple[int, int, int]]]:
        """By item: (seed, place in item, place in text) of the seeds found in a normal text."""
        c = codes(text)
        out: dict[int, list[tuple[int, int, int]]] = {}
        for n, (keys, bits, base) in self.lookup.items():
            if not len(keys):
                continue
            h = grams(c, n)
            maybe = np.flatnonzero(bits[h >> np.uint64(64 - _TABLE_BITS)])
            if not len(maybe):
                continue
            at = np.searchsorted(keys, h[maybe])
            at[at == len(keys)] = 0
            for j, s in zip(maybe[keys[at] == h[maybe]].tolist(), at[keys[at] == h[maybe]].tolist(), strict=True):
                for k, p in self.gram_of[base + s][1]:
                    out.setdefault(k, []).append((base + s, p, j))
        return out

    def seed_share(self, k: int, places: set[int], n: int) -> float:
        """Share of item k's weight under the seeds at these places."""
        covered = np.zeros(len(self.text[k]), dtype=bool)
        for p in places:
            covered[p : p + n] = True
        return float(self.weight[k][covered].sum() / self.total[k])


_COMPILED: dict[str, Items] = {}


def _items(digest: str, rows: tuple[tuple[str, int], ...], counts: Counts) -> Items:
    """The items of a block, compiled once in each worker."""
    if digest not in _COMPILED:
        if len(_COMPILED) >= 2:
            _COMPILED.clear()
        _COMPILED[digest] = Items(list(rows), counts)
    return _COMPILED[digest]


def align(item: str, weight: np.ndarray, windows: list[str]) -> np.ndarray:
    """Weighted Smith-Waterman score of one item against many windows at once, as a share of the item's weight.

    A match earns the weight of its place; a wrong character costs the mean weight, a left-out or an inserted
    one seven tenths of it, so that edits and insertions are bridged inside a passage but not across other text.
    """
    return _ends(item, weight, windows)[0]


def _ends(item: str, weight: np.ndarray, windows: list[str], mean: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best scores and the place in the item just behind each best alignment."""
    width = max(map(len, windows))
    text = np.zeros((len(windows), width), dtype=np.uint32)
    for r, w in enumerate(windows):
        text[r, : len(w)] = np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32)
    mean = float(weight.mean()) if mean is None else mean
    ramp = (0.7 * mean * np.arange(width, dtype=np.float32))[None, :]
    before = np.zeros((len(windows), width), dtype=np.float32)
    best, end = np.zeros(len(windows), dtype=np.float32), np.zeros(len(windows), dtype=np.int64)
    for i, (ch, w) in enumerate(zip(np.frombuffer(item.encode("utf-32-le"), dtype=np.uint32), weight.astype(np.float32), strict=True), 1):
        step = np.where(text == ch, w, np.float32(-mean))
        step[:, 1:] += before[:, :-1]
        np.maximum(step, before - np.float32(0.7 * mean), out=step)
        np.maximum(step, 0, out=step)
        step = np.maximum.accumulate(step + ramp, axis=1) - ramp
        top = step.max(axis=1)
        end[top > best] = i
        np.maximum(best, top, out=best)
        before = step
    return best / float(weight.sum()), end


def chained(passages: list[tuple[float, int, int]]) -> float:
    """Greatest sum of scores of passages, given in the document's order as (score, start, end in the item), that follow
    each other in the item as well."""
    best: list[float] = []
    for j, (score, start, _) in enumerate(passages):
        best.append(score + max([best[i] for i in range(j) if passages[i][2] <= start], default=0.0))
    return max(best, default=0.0)


def window(text: str, places: list[int], reach: int) -> str:
    """The stretch of three item lengths that holds the most seed places."""
    places = sorted(places)
    best, a = (0, places[0]), 0
    for b, p in enumerate(places):
        while p - places[a] > reach:
            a += 1
        best = max(best, (b - a + 1, -places[a]))
    start = abs(best[1])
    return text[max(0, start - reach) : start + 2 * reach]


def windows(items: Items, k: int, text: str, hits: list[tuple[int, int, int]]) -> list[str]:
    """The stretches of three lengths of item k around its seeds, in order, if all seeds found reach SEED_SHARE.

    Stretches start at a seed place and do not overlap, but each has room of one length around it; the densest one is
    among them.
    """
    n, reach = seed_length(items.text[k]), len(items.text[k]) + 40
    if items.seed_share(k, {p for _, p, _ in hits}, n) < SEED_SHARE:
        return []
    at = sorted({j for _, _, j in hits})
    out, start = [], None
    for j in at:
        if start is None or j - start > reach:
            start = j
            out.append(text[max(0, start - reach) : start + 2 * reach])
    dense = window(text, [j for _, _, j in hits], reach)
    return out if dense in out else [*out, dense]


def _align_pairs(items: Items, found: list[tuple[int, int, list[str]]]) -> pd.DataFrame:
    """Scores of (doc_id, place of the item in the block, passages); equal passages of an item are aligned once."""
    by_item: dict[int, set[str]] = {}
    for _, k, passages in found:
        by_item.setdefault(k, set()).update(passages)
    score: dict[tuple[int, str], tuple[float, int]] = {}
    for k, texts in by_item.items():
        every = sorted(texts)
        for a in range(0, len(every), 128):
            part = every[a : a + 128]
            got, ends = _ends(items.text[k], items.weight[k], part)
            score.update(((k, p), (g, e)) for p, g, e in zip(part, got.tolist(), ends.tolist(), strict=True))
    starts: dict[tuple[int, str], int] = {}

    def start(k: int, p: str) -> int:
        """Where in the item the best alignment begins: the same alignment from its end, read backwards."""
        if (k, p) not in starts:
            e, w = score[k, p][1], items.weight[k]
            back = _ends(items.text[k][:e][::-1], w[:e][::-1], [p[::-1]], float(w.mean()))[1]
            starts[k, p] = e - int(back[0])
        return starts[k, p]

    out = []
    for doc, k, passages in found:
        best = max(score[k, p][0] for p in passages)
        parts = [p for p in passages if score[k, p][0] >= PART] if len(passages) > 1 else []
        if len(parts) > 1:
            best = max(best, chained([(score[k, p][0], start(k, p), score[k, p][1]) for p in parts]))
        out.append((doc, items.ids[k], float(best)))
    return pd.DataFrame(out, columns=["doc_id", "key", "score"])


def _search(digest: str, block: tuple[tuple[str, int], ...], counts: Counts):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = _items(digest, block, counts)
        for b in batches:
            found = []
            for doc, raw in zip(b["doc_id"], b["text"], strict=True):
                text = plain(raw)
                if not text:
                    continue
                for k, hits in items.hits(text).items():
                    if passages := windows(items, k, text, hits):
                        found.append((doc, k, passages))
                if len(found) >= MAX_PAIRS:
                    yield _align_pairs(items, found)
                    found = []
            yield _align_pairs(items, found)

    return run


@F.pandas_udf(StringType())
def plain_udf(s: pd.Series) -> pd.Series:
    return s.map(plain, na_action="ignore")


def _gram_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = [pd.DataFrame({"key": key, "n": n, "gram": g.view(np.int64)}) for key, t in zip(b["key"], b["plain"], strict=True) for n, g in Counts.grams_of(t)]
        yield pd.concat(out, ignore_index=True) if out else pd.DataFrame({"key": [], "n": [], "gram": []}).astype("int64")


def scores(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score): aligned share of the item for every document and item that share enough seeds."""
    spark = documents.sparkSession
    ship_package(spark)
    known = items.where("text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), plain_udf("text").alias("plain")).where("plain != ''").distinct()
    folded = cut(known.groupBy("plain").agg(F.min("item_id").alias("key")))  # items of one normal text are searched once
    n, chars = folded.agg(F.count("*"), F.coalesce(F.sum(F.length("plain")), F.lit(0))).first()
    blocks = max(1, -(-n // ITEM_BLOCK), -(-chars // BLOCK_CHARS))
    folded = folded.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    rows = cut(folded.select("key", "plain").mapInPandas(_gram_rows, "key bigint, n bigint, gram bigint"))
    df = cut(rows.groupBy("n", "gram").agg(F.count("*").alias("c")))
    docs = documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.col("text") != ""))
    total = None
    for a in range(blocks):
        block = tuple(sorted((r.plain, r.key) for r in folded.where(F.col("block") == a).select("plain", "key").collect()))
        if not block and total is not None:
            continue
        own = df
        if blocks > 1:
            mine = rows.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == a).select("n", "gram").distinct()
            own = df.join(mine, ["n", "gram"])
        counts = Counts.read([tuple(r) for r in own.select("n", "gram", "c").collect()])
        digest = hashlib.sha1(repr((block, blocks)).encode()).hexdigest()
        part = docs.mapInPandas(_search(digest, block, counts), "doc_id bigint, key bigint, score double")
        total = part if total is None else total.unionByName(part)
    ids = known.join(folded.select("plain", "key"), "plain").select("key", "item_id")
    return total.join(ids, "key").select("doc_id", "item_id", "score")


def leaked(documents: DataFrame, items: DataFrame, share: float = LEAK_SHARE) -> DataFrame:
    """(doc_id, item_id, score) of the documents that repeat at least `share` of an item's weight."""
    return scores(documents, items).where(F.col("score") >= share)
