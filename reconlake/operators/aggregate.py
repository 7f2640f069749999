"""Evidence unions, shares, counters, profiles and group representatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reconlake.operators.ordering import numbered


def evidence_union(df: DataFrame, keys: list[str], sets: dict[str, str], latest: dict[str, str], order: str) -> DataFrame:
    """One row a key: sorted distinct values of each column in sets, joined by |, and the last non-null of each in latest."""
    aggs = [F.array_join(F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c)))), "|").alias(a) for a, c in sets.items()]
    aggs += [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(order))).alias(a) for a, c in latest.items()]
    return df.groupBy(*keys).agg(*aggs)


def first_nonempty(df: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """One row a key: of each column the first value that is neither null nor empty."""
    return df.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c) != "", F.struct(order))).alias(c) for c in columns])


def share(df: DataFrame, unit: str, of: str, places: int = 4) -> DataFrame:
    """(of, n, share): distinct pairs counted by `of`, as a share of all pairs. The total is one number, taken from the counts."""
    n = df.select(unit, of).where(F.col(of).isNotNull()).distinct().groupBy(of).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n")).first()[0] or 1  # one number
    return n.select(of, "n", F.round(F.col("n") / F.lit(total), places).alias("share"))


def merged_evidence(explicit: Column, inferred: Column, replace: bool = True) -> Column:
    """Explicit evidence in place of inferred where there is any, or both together; nulls count as none."""
    e, i = (F.coalesce(c, F.array().cast("array<string>")) for c in (explicit, inferred))
    return F.when(F.size(e) > 0, e).otherwise(i) if replace else F.array_union(e, i)


def counter(df: DataFrame, values: str, name: str = "value") -> DataFrame:
    """(value, n) of an array column's entries."""
    return df.select(F.explode(values).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def ratio(a, b, places: int = 4):
    """a / b rounded, 0 where b is 0."""
    return F.when(b > 0, F.round(a / b, places)).otherwise(F.lit(0.0))


def collapse(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row a key: the shortest (then first) spelling, the number of further rows, and all spellings sorted."""
    return df.groupBy(*keys).agg(
        F.min_by(name, F.struct(F.length(name), F.col(name))).alias("representative"),
        (F.count("*") - 1).alias("further"),
        F.array_join(F.array_sort(F.collect_set(name)), "|").alias("spellings"),
    )


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value."""
    g = df.where(F.col(value).isNotNull()).groupBy(key).agg(F.collect_set(value).alias("_v"))
    return g.where(F.size("_v") > 1).select(key, F.size("_v").cast("bigint").alias("n_values"), F.array_join(F.array_sort("_v"), "|").alias("values"))


def best_group(df: DataFrame, key: str, group: str, score: str) -> DataFrame:
    """All rows of each key's best group, by highest score, then number of rows, then name of the group."""
    g = df.groupBy(key, group).agg(F.max(score).alias("_m"), F.count("*").alias("_n"))
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_m"), F.desc("_n"), group))
    best = g.withColumn("_r", first).where("_r = 1").select(key, group)
    return df.join(best, [key, group])


def most_common(df: DataFrame, values: str, order: str, name: str = "value") -> DataFrame:
    """(value, n, place) of an array column's entries, most frequent first; of equally frequent ones the first seen by `order`, then by place in the array, comes first."""
    at = df.select(F.col(order).alias("_o"), F.posexplode(values).alias("_i", name))
    g = at.groupBy(name).agg(F.count("*").alias("n"), F.min(F.struct("_o", "_i")).alias("_f"))
    ranked = numbered(g.select((-F.col("n")).alias("_n"), F.col("_f._o").alias("_o"), F.col("_f._i").alias("_i"), name, "n"), ["_n", "_o", "_i", name], "place")
    return ranked.select(name, "n", "place")


def tagged_union(tables: dict[str, DataFrame], keys: list[str], value: str) -> DataFrame:
    """(keys, value, tags): what each value of a key is known from, tags sorted and joined by |; null and empty values are no evidence."""
    rows = None
    for tag, df in tables.items():
        part = df.where(F.col(value) != "").select(*keys, value).distinct().withColumn("_t", F.lit(tag))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(*keys, value).agg(F.array_join(F.array_sort(F.collect_set("_t")), "|").alias("tags"))


def placement_summary(df: DataFrame, unit: str, of: str, denominator: int | None = None) -> DataFrame:
    """One row: units known, their share of a fixed number of units in percent, distinct pairs, units with more than one `of`.

    Without a denominator all units of the table count, those without a value included.
    """
    per = df.groupBy(unit).agg(F.countDistinct(of).alias("_n"))
    known = F.count_if(F.col("_n") > 0)
    base = F.lit(denominator) if denominator is not None else F.count("*")
    return per.agg(
        known.alias("known"), F.when(base > 0, F.round(100.0 * known / base, 2)).otherwise(0.0).alias("known_pct"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("placements"), F.count_if(F.col("_n") > 1).alias("multiple"),
    )


def array_tests(values: Column, test) -> Column:
    """Whether all, any and none of an array's entries pass; an empty or null array passes all and none. A test that gives null fails."""
    ok = lambda x: F.coalesce(test(x), F.lit(False))
    any_ = F.coalesce(F.exists(values, ok), F.lit(False))
    return F.struct(F.coalesce(F.forall(values, ok), F.lit(True)).alias("all"), any_.alias("any"), (~any_).alias("none"))
