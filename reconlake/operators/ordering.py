"""Ordinals, shards, chunks and samples of whole tables without a single-task sort.

Rows are range-partitioned by the order columns, counted by partition (one row a partition) and numbered with the
counts before them; ties are ordered by all given columns, which should be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reconlake.session import cut


def numbered(df: DataFrame, order: list[str], name: str = "rn") -> DataFrame:
    """df with row numbers 1..n in the given order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).cast("int")
    counts = parts.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))  # one row a partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_p", before.alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    out = parts.withColumn("_p", part).join(F.broadcast(offsets), "_p")
    return out.withColumn(name, (F.col("_before") + inside + 1).cast("bigint")).drop("_p", "_at", "_before")


def modulo_shard(df: DataFrame, order: list[str], shards: int) -> DataFrame:
    """df with shard = (row number - 1) mod shards."""
    return numbered(df, order).withColumn("shard", F.pmod(F.col("rn") - 1, F.lit(shards)).cast("bigint"))


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df with batch_no from 0, size rows each."""
    return numbered(df, order).withColumn("batch_no", F.floor((F.col("rn") - 1) / size).cast("bigint"))


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int = 1, name: str = "place") -> DataFrame:
    """The first k rows of each group; Spark keeps only k rows a group and task before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= k)


def round_robin(df: DataFrame, stratum: str, order: list[str], limit: int) -> DataFrame:
    """The first `limit` rows when strata take turns in their order."""
    rn = F.row_number().over(Window.partitionBy(stratum).orderBy(*order))
    few = df.withColumn("turn", rn).where(F.col("turn") <= limit)  # no stratum can give more
    return few.orderBy("turn", stratum).limit(limit)


def in_order_of(df: DataFrame, queue: DataFrame, key: str, ordinal: str) -> DataFrame:
    """df with the place of its key in the queue, sorted by it; keys the queue lacks come last, by key."""
    places = queue.groupBy(key).agg(F.min(ordinal).alias(ordinal))
    return df.join(places, key, "left").orderBy(F.col(ordinal).asc_nulls_last(), key)


def until_misses(df: DataFrame, key: str, order: str, miss: Column, streak: int = 2, after: int = 2) -> DataFrame:
    """The rows of each key up to the one with which `streak` misses in a row are complete, at the earliest at the row of place `after` (from 0).

    Nulls of `miss` are hits. Rows of equal order are one place apart in any order; they should be distinct.
    """
    w = Window.partitionBy(key).orderBy(order)
    d = df.withColumn("_m", F.coalesce(miss, F.lit(False)).cast("int")).withColumn("_i", F.row_number().over(w) - 1)
    d = d.withColumn("_run", F.sum("_m").over(w.rowsBetween(-(streak - 1), 0)))
    stop = (F.col("_run") == streak) & (F.col("_i") >= after)
    before = F.coalesce(F.max(stop.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return d.withColumn("_s", before).where("_s = 0").drop("_m", "_i", "_run", "_s")
