"""Set and multiset reconciliation, integrity checks, staging with placeholders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    """An integrity check failed."""


def missing_and_extra(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side): keys that only the expected (missing) or only the actual table (extra) has. Null keys compare equal."""
    e, a = expected.select(*keys).distinct(), actual.select(*keys).distinct()
    return e.subtract(a).withColumn("side", F.lit("missing")).unionByName(a.subtract(e).withColumn("side", F.lit("extra")))


def mismatches(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, left_value, right_value) where common keys differ in a field, nulls included."""
    x = a.select(key, F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias("_x"))
    y = b.select(key, F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias("_y"))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_x.{f}").alias("left_value"), F.col(f"_y.{f}").alias("right_value")) for f in fields])
    out = x.join(y, key).select(key, F.explode(pairs).alias("p")).select(key, "p.*")
    return out.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows by which two tables differ as multisets, with surplus (positive: more in a). One aggregation, no double set difference."""
    cols = a.columns
    both = a.withColumn("_s", F.lit(1)).unionByName(b.select(*cols).withColumn("_s", F.lit(-1)))
    return both.groupBy(*cols).agg(F.sum("_s").alias("surplus")).where("surplus != 0")


def multiset_equal(a: DataFrame, b: DataFrame) -> bool:
    return multiset_difference(a, b).isEmpty()


def overlaps(tagged: DataFrame, key: str, tag: str) -> DataFrame:
    """(tag_a, tag_b, n): keys that stand under two tags; no row if the tags are disjoint."""
    t = tagged.select(key, tag).distinct()
    g = t.groupBy(key).agg(F.array_sort(F.collect_set(tag)).alias("_t")).where(F.size("_t") > 1)
    n = F.size("_t")
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(F.sequence(i + 1, n - 1), lambda j: F.struct(F.get("_t", i).alias("tag_a"), F.get("_t", j).alias("tag_b")))))
    return g.select(F.explode(pairs).alias("p")).groupBy("p.tag_a", "p.tag_b").agg(F.count("*").alias("n"))


def duplicates(df: DataFrame, key: str, survivor: str) -> DataFrame:
    """(key, n, survivor): keys that occur more than once and the least value of the survivor column."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(survivor).alias("survivor")).where("n > 1")


def with_placeholders(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """One row a child, and one row with empty child columns for each parent that has none."""
    return parents.join(children, key, "left")


def require_unique(df: DataFrame, key: str, expected: int | None = None) -> DataFrame:
    """df, or an error if the key repeats or the number of rows is not the expected one."""
    r = df.agg(F.count("*").alias("n"), F.countDistinct(key).alias("d")).first()
    if r.n != r.d or expected is not None and r.n != expected:
        raise IntegrityError(f"{r.n} rows, {r.d} distinct {key}, expected {expected}")
    return df


def require_present(expected: DataFrame, actual: DataFrame, key: str) -> None:
    """Error if a key of expected is not in actual."""
    lost = expected.join(actual, key, "left_anti").limit(5).collect()
    if lost:
        raise IntegrityError(f"missing {key}: {[r[key] for r in lost]}")


def partition_proof(tagged: DataFrame, key: str, tag: str, whole: DataFrame) -> DataFrame:
    """One row: number of parts, keys that stand in more than one, keys of all parts together, keys of the whole, and whether the
    parts are a partition of it (no overlap, no key missing, none beyond)."""
    per = tagged.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(tag).alias("_t"))
    all_ = whole.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_w", F.lit(True))
    both = per.join(all_, key, "full")
    sums = both.agg(
        F.count_if(F.col("_t") > 1).alias("overlapping"), F.count("_t").alias("covered"), F.count("_w").alias("total"),
        F.count_if(F.col("_w").isNull()).alias("beyond"), F.count_if(F.col("_t").isNull()).alias("missing"),
    )
    parts = F.lit(tagged.agg(F.countDistinct(tag)).first()[0]).cast("bigint").alias("parts")  # one number
    proof = (F.col("overlapping") == 0) & (F.col("beyond") == 0) & (F.col("missing") == 0)
    return sums.select(parts, "overlapping", "covered", "total", "missing", "beyond", proof.alias("is_partition"))


def reduced_count(df: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys, those of them that are excluded, and what remains of a fixed denominator."""
    d = df.where(F.col(key).isNotNull()).select(key).distinct()
    x = d.join(excluded.select(key).distinct().withColumn("_x", F.lit(1)), key, "left")
    return x.agg(F.count("*").alias("total"), F.count("_x").alias("excluded"), (F.count("*") - F.count("_x")).alias("remaining"))
