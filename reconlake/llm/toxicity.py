"""Abusive, hateful or sexual content: a score per document and the rate per source (problem 9).

Method: a chain of linear models over hashed character n-grams of passages (sentences). The models predict the
categories one after the other; each later model is given the probabilities of the earlier ones, and is trained
on out-of-fold values of them, so that it does not lean on predictions it could only see in training.
Ratings exist per document only; which passages of a flagged document carry the flag is found by rounds of
multiple-instance training. A document's score in a category is that of its worst passage.

Training takes at most MAX_FLAGGED flagged and MAX_PLAIN other rated documents (chosen by hash of doc_id), then again
with at most MAX_HARD further plain ones that the first chain, run over all rated documents, scores nearest to a flag;
all together at most MAX_CHARS characters. It runs on the driver over that bounded sample; scoring runs over every
document and its whole text.

Null or empty texts score 0. Ratings of documents that do not exist, and null ratings, are ignored. Several ratings
of one document: the most severe counts (flagged before none, then category order). Without flagged ratings all score 0.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from reconlake.functions.confusables import KANA
from reconlake.session import bounded, cut, ship_package

CATEGORIES = ("abuse", "hate", "sexual")  # order of the chain
MAX_FLAGGED = 1200
MAX_PLAIN = 1200
MAX_HARD = 600  # plain documents added because the first chain scores them in the range HARD
HARD = (0.1, 0.9)
MAX_CHARS = 20_000_000  # of all texts trained on
MAX_IDS = 1_000_000  # rated documents up to which their (counted) ids are broadcast; beyond, the join is shuffled
BITS = 18
SIZES = (2, 3, 4)  # n-gram lengths
FOLDS = 2
ROUNDS = 2
STEPS = 30
THRESHOLD = 0.5

_BOUNDARY, _DROP = 0, 1
_END = "。．！？!?\n\r.!?｡"
_MASK = "○〇●◯*＊×"
_MULT = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """By code point: the folded character, or boundary, or drop."""
    t = np.full(0x110000, _DROP, dtype=np.uint32)
    for o in range(1, 0x10000):
        if 0xD800 <= o < 0xE000:
            continue
        ch = chr(o)
        if ch in _END:
            t[o] = _BOUNDARY
        elif ch in _MASK:
            t[o] = ord("*")
        else:
            s = unicodedata.normalize("NFKC", ch).lower()
            s = s if len(s) == 1 else unicodedata.normalize("NFKC", ch)[:1].lower()
            s = KANA.get(s, s)
            if s.isdigit():
                t[o] = ord("0")
            elif s.isalnum() or s == "ー":
                t[o] = ord(s)
    return t


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts in one row, the passage of each, and the text of each passage."""
    raw = [np.frombuffer(x.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for x in texts]
    size = np.array([len(r) + 1 for r in raw])
    joined = np.concatenate([np.concatenate([r, [10]]) for r in raw]).astype(np.uint32) if raw else np.empty(0, np.uint32)
    owner = np.repeat(np.arange(len(raw)), size)
    c = _table()[joined]
    keep = c != _DROP
    c, owner = c[keep], owner[keep]
    passage = np.cumsum(c == _BOUNDARY) - (c == _BOUNDARY)
    n = int(passage[-1]) + 1 if len(passage) else 0
    of = np.zeros(n, dtype=np.int64)
    of[passage] = owner
    return c, passage, of


def features(c: np.ndarray, passage: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, passage) of the n-grams inside passages, for one length after the other."""
    full = c != _BOUNDARY
    wide = c.astype(np.uint64)
    h = wide.copy()
    with np.errstate(over="ignore"):
        for n in range(2, max(SIZES) + 1):
            if len(c) < n:
                return
            h = h[:-1] * _MULT + wide[n - 1 :]
            ok = full[: len(h)] & full[n - 1 :] & (passage[: len(h)] == passage[n - 1 :])
            if n in SIZES:
                x = (h[ok] ^ np.uint64(n)) * _MULT
                yield (x >> np.uint64(64 - BITS)).astype(np.int64), passage[: len(h)][ok]


class Chain:
    """Weights of the chain: per category a bucket table, an intercept and weights of the earlier probabilities."""

    def __init__(self, tables: np.ndarray, intercepts: np.ndarray, links: np.ndarray) -> None:
        self.tables, self.intercepts, self.links = tables, intercepts, links

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Per text and category the probability of the worst passage."""
        out = np.zeros((len(texts), len(CATEGORIES)))
        if not texts or not self.tables.any():
            return out
        c, passage, of = passages(texts)
        z = np.zeros((len(CATEGORIES), len(of)))
        for bucket, p in features(c, passage):
            for k in range(len(CATEGORIES)):
                z[k] += np.bincount(p, weights=self.tables[k][bucket], minlength=len(of))
        length = np.bincount(passage[c != _BOUNDARY], minlength=len(of))
        z /= np.sqrt(np.maximum(length, 10))
        prob = np.zeros_like(z)
        for k in range(len(CATEGORIES)):
            logit = z[k] + self.intercepts[k] + self.links[k, :k] @ prob[:k]
            prob[k] = np.where(length > 1, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), 0)
            np.maximum.at(out[:, k], of, prob[k])
        return out


class _Rows:
    """Distinct passages of the training sample as sparse rows."""

    def __init__(self, texts: list[str]) -> None:
        c, passage, of = passages(texts)
        parts = [(b.astype(np.int32), p.astype(np.int32)) for b, p in features(c, passage)]  # half the memory while sorting
        bucket = np.concatenate([b for b, _ in parts]) if parts else np.empty(0, np.int32)
        row = np.concatenate([p for _, p in parts]) if parts else np.empty(0, np.int32)
        del parts
        length = np.bincount(passage[c != _BOUNDARY], minlength=len(of))
        # equal passages are one row: identified by the sum of their hashed n-grams
        draw = np.random.default_rng(7).random(1 << BITS)
        sign = np.bincount(row, weights=draw[bucket], minlength=len(of))
        keep = length > 1
        _, first, inverse = np.unique(sign[keep], return_index=True, return_inverse=True)
        ids = np.flatnonzero(keep)
        self.doc = of[ids]
        self.row = inverse
        chosen = ids[first]
        renumber = np.full(len(of), -1, dtype=np.int32)
        renumber[chosen] = np.arange(len(chosen))
        r = renumber[row]
        del row, sign, c, passage
        bucket, r = bucket[r >= 0], r[r >= 0]
        often = np.bincount(bucket, minlength=1 << BITS) > 1  # a bucket of one place teaches nothing
        bucket, r = bucket[often[bucket]], r[often[bucket]]
        order = np.argsort(r, kind="stable")
        self.used, self.col = np.unique(bucket[order], return_inverse=True)
        self.at = r[order].astype(np.int64)
        self.n = len(chosen)
        self.scale = 1 / np.sqrt(np.maximum(length[chosen], 10))
        self.width = np.bincount(self.at, minlength=self.n)
        self.start = np.concatenate([[0], np.cumsum(self.width)])

    def columns_of(self, rows: np.ndarray) -> np.ndarray:
        """Columns of these rows, one after the other."""
        width = self.width[rows]
        offset = np.repeat(self.start[rows] - np.concatenate([[0], np.cumsum(width)[:-1]]), width)
        return self.col[offset + np.arange(width.sum())]

    def fit(self, y: np.ndarray, weight: np.ndarray, extra: np.ndarray, l2: float = 2e-4) -> tuple[np.ndarray, float, np.ndarray]:
        """Logistic regression by adaptive gradient steps; extra are dense columns."""
        sel = weight > 0
        on = sel[self.at]
        col, at = self.col[on], self.at[on]
        w, b, v = np.zeros(len(self.used)), 0.0, np.zeros(extra.shape[1])
        gw, gb, gv = np.full(len(w), 1e-8), 1e-8, np.full(len(v), 1e-8)
        weight = weight / weight.sum()
        for _ in range(STEPS):
            z = np.bincount(at, weights=w[col], minlength=self.n) * self.scale + b + extra @ v
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
            g = np.bincount(col, weights=(err * self.scale)[at], minlength=len(w)) + l2 * w / len(w) ** 0.5
            gw += g * g
            w -= 0.35 * g / np.sqrt(gw)
            gb += err.sum() ** 2
            b -= 0.35 * err.sum() / np.sqrt(gb)
            if len(v):
                e = extra.T @ err
                gv += e * e
                v -= 0.35 * e / np.sqrt(gv)
        return w, b, v

    def score(self, w: np.ndarray, b: float, v: np.ndarray, extra: np.ndarray) -> np.ndarray:
        z = np.bincount(self.at, weights=w[self.col], minlength=self.n) * self.scale + b + extra @ v
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(texts: list[str], labels: list[str], sources: list[str] | None = None) -> Chain:
    """The chain from rated documents.

    What speaks for a flag is judged against the share of flagged documents in each document's source, so that the
    wording common in a source with many flags tells nothing.
    """
    k_all = len(CATEGORIES)
    empty = Chain(np.zeros((k_all, 1 << BITS), dtype=np.float32), np.full(k_all, -30.0), np.zeros((k_all, k_all)))
    label = np.array([CATEGORIES.index(x) + 1 if x in CATEGORIES else 0 for x in labels])
    if not (label > 0).any() or not (label == 0).any():
        return empty
    rows = _Rows(texts)
    source = np.unique(["" if x is None else x for x in sources] if sources else [""] * len(label), return_inverse=True)[1]
    usual = ((np.bincount(source, weights=label > 0) + 0.5) / (np.bincount(source) + 1))[source]  # by document: flagged share of its source
    flagged = label[rows.doc] > 0
    n_plain = np.bincount(rows.row, weights=~flagged, minlength=rows.n)
    n_flag = np.bincount(rows.row, weights=flagged, minlength=rows.n)
    none = np.zeros((rows.n, 0))

    def weights(y: np.ndarray) -> np.ndarray:
        """Both classes weigh the same in total, less the more rows the positive class lacks."""
        seen = np.sqrt(n_plain + n_flag)
        w = np.where(y > 0, seen, np.minimum(seen, 3))
        pos, neg = w[y > 0].sum(), w[y == 0].sum()
        w[y > 0] *= np.clip(neg / max(pos, 1e-9) * 0.25, 1, 5)
        return w

    # multiple-instance rounds: which passages of flagged documents carry the flag. They start from passages
    # made of n-grams that several flagged documents share and other documents hardly have.
    pair = np.unique(np.repeat(rows.doc, rows.width[rows.row]) * len(rows.used) + rows.columns_of(rows.row))
    own, column = label[pair // len(rows.used)] > 0, pair % len(rows.used)
    f = np.bincount(column, weights=own, minlength=len(rows.used))
    p = np.bincount(column, weights=~own, minlength=len(rows.used))
    chance = np.bincount(column, weights=usual[pair // len(rows.used)], minlength=len(rows.used))
    odds = chance / np.maximum(f + p - chance, 1e-9)
    telling = (f >= max(2.0, 0.004 * (label > 0).sum())) & (f >= 4 * (p + 0.25) * np.maximum(1.0, odds))
    part = np.bincount(rows.at, weights=telling[rows.col], minlength=rows.n) / np.maximum(rows.width, 1)
    of_flag = n_flag > np.bincount(rows.row, weights=usual[rows.doc], minlength=rows.n)
    y = ((part >= 0.35) & of_flag).astype(float)
    if not y.any():
        y = ((part >= part[of_flag].max(initial=0)) & of_flag).astype(float)
    w, b, v = rows.fit(y, weights(y), none)
    for _ in range(ROUNDS):
        s = rows.score(w, b, v, none)
        best = np.zeros(len(label))
        np.maximum.at(best, rows.doc, s[rows.row])
        y = ((s >= 0.5) & of_flag).astype(float)
        # a flagged document without such a passage gives the one with the most telling n-grams, if it has some
        most = np.zeros(len(label))
        np.maximum.at(most, rows.doc, part[rows.row] * of_flag[rows.row])
        near = flagged & (best[rows.doc] < 0.5) & (part[rows.row] >= most[rows.doc]) & (most[rows.doc] >= 0.12)
        y[rows.row[near]] = 1
        y[~of_flag] = 0
        if not y.any():
            break
        w, b, v = rows.fit(y, weights(y), none)
    toxic = rows.score(w, b, v, none) >= 0.5
    toxic &= of_flag
    if not toxic.any():
        return empty
    # category of a toxic passage: the one of the documents it stands in, by prior-corrected vote
    votes = np.stack([np.bincount(rows.row, weights=label[rows.doc] == k + 1, minlength=rows.n) for k in range(k_all)])
    home = np.zeros(rows.n, dtype=np.int64)
    home[rows.row[::-1]] = rows.doc[::-1]  # folds hold whole documents; a passage of several goes with the first
    fold = (home * 2654435761 >> 7) % FOLDS
    tables, inter, links = np.zeros((k_all, 1 << BITS), dtype=np.float32), np.zeros(k_all), np.zeros((k_all, k_all))
    oof = np.zeros((rows.n, 0))
    for k in range(k_all):
        yk = (toxic & (votes[k] > 0) & (votes[k] >= votes.max(axis=0))).astype(float)
        if not yk.any():
            inter[k] = -30.0
            oof = np.column_stack([oof, np.zeros(rows.n)])
            continue
        wt = weights(yk)
        # a toxic passage of another category is neither an example nor a counter-example
        wt = np.where(toxic & (yk == 0), 0, wt)
        w, b, v = rows.fit(yk, wt, oof)
        tables[k][rows.used] = w
        inter[k] = b
        links[k, : len(v)] = v
        if k + 1 < k_all:
            held = np.zeros(rows.n)
            for f in range(FOLDS):
                part = rows.fit(yk, np.where(fold == f, 0, wt), oof)
                held[fold == f] = rows.score(*part, oof)[fold == f]
            oof = np.column_stack([oof, held])
    return Chain(tables, inter, links)


def _severity() -> Column:
    """9 for none, else the place of the category in the chain."""
    order = F.when(F.col("label") == "none", 9)
    for i, c in enumerate(CATEGORIES):
        order = order.when(F.col("label") == c, i)
    return order


def _ratings(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, _o, _s, _n): the most severe rating of each rated document, its source and length."""
    rated = labels.where(F.col("label").isin("none", *CATEGORIES)).groupBy("doc_id").agg(F.min(_severity()).alias("_o"))
    own = documents.where("text is not null").select("doc_id", F.coalesce("source", F.lit("")).alias("_s"), F.length("text").alias("_n"))
    return rated.join(own, "doc_id")


def _texts(documents: DataFrame, chosen: list[Row]) -> tuple[list[str], list[str], list[str]]:
    """(texts, labels, sources) of the chosen documents, in their order, as long as they fit MAX_CHARS; longer ones are passed over whole."""
    room, kept = MAX_CHARS, {}
    for r in chosen:
        if r._n <= room and r.doc_id not in kept:
            room -= r._n
            kept[r.doc_id] = r
    if not kept:
        return [], [], []
    ids = documents.sparkSession.createDataFrame([(k,) for k in kept], f"doc_id {dict(documents.dtypes)['doc_id']}")  # at most the bounds of the sample
    text = {r.doc_id: r.text for r in documents.join(F.broadcast(ids), "doc_id").where("text is not null").select("doc_id", "text").toLocalIterator()}
    rows = sorted((r for r in kept.values() if r.doc_id in text), key=lambda r: r.doc_id)
    return [text[r.doc_id] for r in rows], ["none" if r._o == 9 else CATEGORIES[r._o] for r in rows], [r._s for r in rows]


def rated_sample(ratings: DataFrame) -> list[Row]:
    """At most MAX_FLAGGED flagged and MAX_PLAIN other rated documents; which of more is decided by hash of doc_id."""
    flag = ratings.where("_o < 9").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_FLAGGED)
    # other documents are drawn from the sources as flagged ones are, so that a source's own wording tells nothing
    per = ratings.where("_o < 9").groupBy("_s").agg(F.count("*").alias("_f"))
    place = F.row_number().over(Window.partitionBy("_s").orderBy(F.xxhash64("doc_id"), "doc_id"))
    few = ratings.where("_o = 9").withColumn("_p", place).where(F.col("_p") <= MAX_PLAIN)  # no source can give more
    plain = few.join(per, "_s", "left").orderBy(F.col("_p") / F.coalesce("_f", F.lit(0.25)), "doc_id").limit(MAX_PLAIN)
    got = plain.select("doc_id", "_o", "_s", "_n").unionByName(flag.select("doc_id", "_o", "_s", "_n")).collect()  # four small values a row
    plain_rows, flag_rows = ([r for r in got if (r._o == 9) == is_plain] for is_plain in (True, False))
    mixed = []
    for i in range(max(len(plain_rows), len(flag_rows))):  # so that a bound on characters keeps both kinds
        mixed += flag_rows[i : i + 1] + plain_rows[i : i + 1]
    return mixed


def _scorer(sent: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for b in batches:
            out = np.zeros((len(b), len(CATEGORIES)))
            texts = [x or "" for x in b["text"]]
            a = 0
            while a < len(texts):  # groups of bounded total length
                e, chars = a, 0
                while e < len(texts) and (e == a or chars + len(texts[e]) < 400_000):
                    chars += len(texts[e])
                    e += 1
                out[a:e] = model.probabilities(texts[a:e])
                a = e
            res = pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"]})
            for k, c in enumerate(CATEGORIES):
                res[c] = out[:, k]
            res["score"] = out.max(axis=1) if len(b) else np.empty(0)
            yield res

    return run


_SCORES = "doc_id bigint, source string, abuse double, hate double, sexual double, score double"


def fitted(documents: DataFrame, labels: DataFrame) -> Chain:
    """The chain trained on the sample, then again with the plain documents outside it that came nearest to a flag.

    Those that the first chain is sure of are left out: their ratings are more likely wrong than hard.
    """
    spark = documents.sparkSession
    ratings = cut(_ratings(documents, labels))
    sample = rated_sample(ratings)
    chain = train(*_texts(documents, sample))
    if not chain.tables.any():
        return chain
    seen = spark.createDataFrame([(r.doc_id,) for r in sample], f"doc_id {dict(documents.dtypes)['doc_id']}")
    rest = ratings.where("_o = 9").join(F.broadcast(seen), "doc_id", "left_anti")
    sent = spark.sparkContext.broadcast(chain)
    texts = documents.select("doc_id", "source", "text").join(bounded(rest.select("doc_id"), MAX_IDS), "doc_id", "left_semi")
    near = texts.mapInPandas(_scorer(sent), _SCORES).where((F.col("score") >= HARD[0]) & (F.col("score") < HARD[1]))
    near = near.orderBy(F.desc("score"), "doc_id").limit(MAX_HARD).select("doc_id")
    hard = rest.join(F.broadcast(near), "doc_id", "left_semi").select("doc_id", "_o", "_s", "_n").collect()
    return train(*_texts(documents, sample + hard)) if hard else chain


def scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, abuse, hate, sexual, score) of every document."""
    spark = documents.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(fitted(documents, labels))  # 3 tables of 2**BITS floats: 3 MB at any input size
    return documents.select("doc_id", "source", "text").mapInPandas(_scorer(sent), _SCORES)


def flagged(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents with at least one passage at or above the threshold in some category."""
    return scores(documents, labels).where(F.col("score") >= threshold)


def rates(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(source, n_docs, n_flagged, rate) by source; documents without a source form their own row."""
    s = scores(documents, labels)
    hit = F.count_if(F.col("score") >= threshold)
    return s.groupBy("source").agg(F.count("*").alias("n_docs"), hit.alias("n_flagged"), (hit / F.count("*")).alias("rate"))
