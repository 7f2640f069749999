"""Mixing sources to target weights (problem 8).

Method: weighted fair queueing. The documents of a source are shuffled by a seeded hash and queued; each use of a
document gets a virtual finish time, the source's tokens up to and including it divided by the source's weight.
The queue of all sources is range-sorted by finish time and cut at the total budget. Further rounds over a source
repeat its documents, at most max_repeat times.

The running token sums inside a source are taken without gathering a source in one task: documents are spread over
buckets of the shuffle order, as many as keep a bucket small, buckets are summed (one row per source and bucket), and
each bucket is summed within. The budget is cut the same way, by bins of finish time, the last of which is divided again
until it is small. A document of any length is one unit; the last document that reaches into the
budget is left out, so that the total never exceeds it.

The default budget is the largest total at which every source with a positive weight can keep its target: the least,
over those sources, of its tokens times max_repeat divided by its weight. With a larger given budget, sources that run
out contribute all they have and the shares that result are reported with a note.

Documents with null text or of no token, of no source or of a source without a target are not used and are counted in
the report. Targets with null or non-positive weight or max_repeat contribute nothing. A null source never matches.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reconlake.session import bounded, cut, ship_package

TOKENIZER_DIR = os.environ.get("RECONLAKE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SEED = 20
MAX_SOURCES = 10_000  # up to so many targets are broadcast, more are joined by shuffle
BUCKET_ROWS = 1 << 17  # documents of a source summed in one bucket of the shuffle order, on average
EDGE_BINS, EDGE_ROWS = 4096, 1 << 20  # finish times are binned until the bin in which the budget ends has no more rows


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    # the usual pre-tokenisation pattern of byte-level vocabularies
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, tokenizer_dir: str = TOKENIZER_DIR, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens) of the whole texts; 0 for null or empty texts."""
    ship_package(documents.sparkSession)
    path = os.path.join(tokenizer_dir, vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(path)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": n})

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id bigint, source string, n_tokens bigint")


def _targets(target: DataFrame) -> DataFrame:
    ok = target.where((F.col("weight") > 0) & (F.col("max_repeat") > 0) & F.col("source").isNotNull())
    t = ok.groupBy("source").agg(F.max("weight").alias("weight"), F.max("max_repeat").cast("bigint").alias("max_repeat"))
    return t


def _supply(counts: DataFrame, target: DataFrame) -> DataFrame:
    """(source, weight, max_repeat, n_docs, tokens): one row per source with a target."""
    have = counts.where("n_tokens > 0").groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    t = _targets(target).join(have, "source", "left").na.fill(0, ["n_docs", "tokens"])
    return t


def reachable_budget(supply: DataFrame) -> int:
    """Largest total at which each source with tokens can keep its share."""
    r = supply.where("tokens > 0").agg(F.min(F.col("tokens") * F.col("max_repeat") / F.col("weight"))).first()[0]
    return int(r or 0)


def _full_time(supply: DataFrame, budget: int) -> float | None:
    """The virtual time at which the queue of all sources reaches the budget; None if it never does or sources are too many to list."""
    rows = supply.where("tokens > 0").select("weight", "tokens", "max_repeat").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        return None
    done, left = 0.0, float(sum(r.weight for r in rows))
    at = 0.0
    for until, weight in sorted((r.tokens * r.max_repeat / r.weight, r.weight) for r in rows):
        if done + left * (until - at) >= budget:
            return at + (budget - done) / left
        done, at, left = done + left * (until - at), until, left - weight
    return None


def _queue(counts: DataFrame, supply: DataFrame, seed: int, budget: int) -> DataFrame:
    """One row per use of a document with its virtual finish time; rounds that begin after the budget is full are not made."""
    full = _full_time(supply, budget)
    rounds = F.col("max_repeat") if full is None else F.least("max_repeat", F.ceil(F.col("weight") * full / F.col("tokens")) + 1)
    most = supply.agg(F.max("n_docs")).first()[0] or 1
    bits = max(10, (most // BUCKET_ROWS).bit_length())
    whole = supply.where("tokens > 0").withColumn("_rounds", rounds)
    rows = counts.where("n_tokens > 0").join(bounded(whole.select("source", "weight", "tokens", "_rounds"), MAX_SOURCES), "source")
    rows = rows.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rounds").cast("bigint"))))
    h = F.xxhash64(F.lit(seed), "copy_no", "doc_id")
    rows = rows.withColumn("_h", h).withColumn("_b", F.shiftrightunsigned("_h", 64 - bits).cast("int"))
    sums = rows.groupBy("source", "copy_no", "_b").agg(F.sum("n_tokens").alias("_t"))
    # one row per bucket; a window over the buckets of one round of one source
    start = F.sum("_t").over(Window.partitionBy("source", "copy_no").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("_start", F.coalesce(start, F.lit(0))).drop("_t")
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "copy_no", "_b").orderBy("_h", "doc_id"))
    rows = rows.join(sums, ["source", "copy_no", "_b"]).withColumn("_in", inside)
    done = (F.col("copy_no") - 1) * F.col("tokens") + F.col("_start") + F.col("_in")
    return rows.withColumn("finish", done / F.col("weight")).select("doc_id", "copy_no", "source", "n_tokens", "weight", "finish")


def _cut_at(queue: DataFrame, budget: int) -> DataFrame:
    """The first uses by finish time whose tokens fit the budget.

    Sums of bins of finish time locate the bin in which the budget ends; that bin is binned again until it has at most
    EDGE_ROWS rows (or one finish time only) and is then summed row by row.
    """
    lo, hi = 0.0, queue.agg(F.max("finish")).first()[0]
    if not hi:
        return queue
    hi = float(np.nextafter(hi, np.inf))
    kept = 0
    while True:
        width = (hi - lo) / EDGE_BINS
        inside = queue.where((F.col("finish") >= lo) & (F.col("finish") < hi)).withColumn("_b", F.floor((F.col("finish") - lo) / width))
        edge = None
        bins = inside.groupBy("_b").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.min("finish").alias("a"), F.max("finish").alias("z")).orderBy("_b").collect()
        for r in bins:  # at most EDGE_BINS rows and one for rounding
            if kept + r.t > budget:
                edge = r
                break
            kept += r.t
        if edge is None:
            return queue.where(F.col("finish") < hi)
        narrower = edge.z < hi and (edge.a > lo or edge.z < np.nextafter(hi, -np.inf))
        lo, hi = edge.a, float(np.nextafter(edge.z, np.inf))
        if edge.n <= EDGE_ROWS or edge.a == edge.z or not narrower:
            break
    last = queue.where((F.col("finish") >= lo) & (F.col("finish") < hi))
    running = F.sum("n_tokens").over(Window.partitionBy(F.lit(0)).orderBy("finish", "source", "doc_id", "copy_no"))  # the rows of the last bin
    last = last.withColumn("_r", running).where(F.col("_r") <= budget - kept).drop("_r")
    return queue.where(F.col("finish") < lo).unionByName(last)


def _prepare(documents: DataFrame, target: DataFrame, budget: int | None, **tokenizer) -> tuple[DataFrame, DataFrame, int]:
    counts = cut(token_counts(documents, **tokenizer))  # three numbers a document, read several times
    supply = _supply(counts, target)
    return counts, supply, reachable_budget(supply) if budget is None else budget


def mixture(documents: DataFrame, target: DataFrame, budget: int | None = None, seed: int = SEED, **tokenizer) -> DataFrame:
    """(doc_id, copy_no, source, n_tokens): every use of a document in the mixture."""
    counts, supply, total = _prepare(documents, target, budget, **tokenizer)
    picked = _cut_at(cut(_queue(counts, supply, seed, total)), total)
    return picked.select("doc_id", "copy_no", "source", "n_tokens")


def _report(counts: DataFrame, supply: DataFrame, total: int, seed: int) -> DataFrame:
    picked = _cut_at(cut(_queue(counts, supply, seed, total)), total)
    got = picked.groupBy("source").agg(F.count("*").alias("mix_docs"), F.sum("n_tokens").alias("mix_tokens"))
    out = supply.join(got, "source", "left").na.fill(0, ["mix_docs", "mix_tokens"])
    every = F.sum("mix_tokens").over(Window.partitionBy(F.lit(1)))  # one row per source
    share = F.when(every > 0, F.col("mix_tokens") / every).otherwise(F.lit(0.0))
    need = F.col("weight") * F.lit(total)
    note = (
        F.when(F.col("tokens") == 0, F.lit("no documents"))
        .when(F.col("tokens") * F.col("max_repeat") < need * 0.999, F.lit("too small for its target at this budget"))
        .when((F.col("tokens") * F.col("max_repeat")) <= need * 1.001, F.lit("used up; bounds the mixture"))
        .otherwise(F.lit(""))
    )
    return out.select(
        "source", "weight", "max_repeat", "n_docs", "tokens", "mix_docs", "mix_tokens", share.alias("share"), note.alias("note"),
        F.lit(total).cast("bigint").alias("budget"),
    )


def shares(documents: DataFrame, target: DataFrame, budget: int | None = None, seed: int = SEED, **tokenizer) -> DataFrame:
    """(source, weight, max_repeat, n_docs, tokens, mix_docs, mix_tokens, share, note, budget) by source, in the mixture."""
    counts, supply, total = _prepare(documents, target, budget, **tokenizer)
    return _report(counts, supply, total, seed)


def shares_at_each_budget(documents: DataFrame, target: DataFrame, seed: int = SEED, **tokenizer) -> DataFrame:
    """shares() twice: of the largest mixture in which every source keeps its target, and of one as large as all documents
    of the sources together, in which sources too small for their target are noted."""
    counts, supply, total = _prepare(documents, target, None, **tokenizer)
    supply = cut(supply)
    wanted = supply.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    return _report(counts, supply, total, seed).unionByName(_report(counts, supply, wanted, seed))


