"""Upserts, override precedence, insert-if-absent, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconlake.operators.ordering import top_per_group


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the last by order: rows delivered again replace those before."""
    return top_per_group(df, keys, order, 1, "_p").drop("_p")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the rows of new in place of those of the same key, and new keys added."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def insert_if_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old and those rows of new whose key old lacks."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"), allowMissingColumns=True)


def precedence(base: DataFrame, key: str, column: str, layers: list[tuple[str, DataFrame]]) -> DataFrame:
    """base with `column` taken from the last layer that has the key, and its name in `<column>_source`."""
    out = base.withColumn(f"{column}_source", F.lit("base"))
    for name, layer in layers:
        side = layer.select(F.col(key), F.col(column).alias("_new"), F.lit(True).alias("_hit"))
        out = out.join(side, key, "left")
        out = out.withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column)))
        out = out.withColumn(f"{column}_source", F.when(F.col("_hit"), F.lit(name)).otherwise(F.col(f"{column}_source"))).drop("_new", "_hit")
    return out


def route(df: DataFrame, rules: list[tuple[str, Column]], default: str) -> DataFrame:
    """df with `route`, the first rule that holds."""
    out = F.lit(default)
    for name, cond in reversed(rules):
        out = F.when(cond, F.lit(name)).otherwise(out)
    return df.withColumn("route", out)


def upsert_in_order(old: DataFrame, new: DataFrame, key: str, ordinal: str) -> DataFrame:
    """upsert() that keeps each old key's ordinal; new keys have a null one and follow, by key, when sorted with nulls last."""
    places = old.select(key, ordinal)
    rest = [c for c in old.columns if c != ordinal]
    return upsert(old.select(*rest), new.select(*rest), key).join(places, key, "left")


def settled(base: DataFrame, decisions: DataFrame, key: str, column: str, accepted: str, value: Column, otherwise: Column) -> DataFrame:
    """base with `column` set to value where the key's decision is accepted, to otherwise where it is not; keys without a decision stay.

    decisions has one row a key with the boolean `accepted`; null is not accepted.
    """
    d = decisions.select(F.col(key), F.coalesce(accepted, F.lit(False)).alias("_ok"))
    out = base.join(d, key, "left")
    return out.withColumn(column, F.when(F.col("_ok"), value).when(~F.col("_ok"), otherwise).otherwise(F.col(column))).drop("_ok")


def insert_lists_if_absent(old: DataFrame, new: DataFrame, key: str, items: str, usable, most: int = 12) -> DataFrame:
    """old and those rows of new whose key old lacks and whose list is usable: not empty, all entries pass, at most `most`; entries once each."""
    ok = (F.size(items) > 0) & (F.size(items) <= most) & F.forall(items, lambda x: F.coalesce(usable(x), F.lit(False)))
    return insert_if_absent(old, new.where(ok).withColumn(items, F.array_distinct(items)), key)


def reclassified(df: DataFrame, column: str, now: Column) -> DataFrame:
    """df with `column` computed anew and `changed` where the stored value was another; nulls compare equal."""
    return df.withColumn("_now", now).withColumn("changed", ~F.col(column).eqNullSafe(F.col("_now"))).withColumn(column, F.col("_now")).drop("_now")


def both_sides(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """(key, left_values, right_values, status): what each source says of a key, sorted; neither overwrites the other.

    status is same, conflict, left only or right only; null values say nothing.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(column).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(column)).alias(name))

    both = side(left, "left_values").join(side(right, "right_values"), key, "full")
    status = (
        F.when(F.col("right_values").isNull(), "left only").when(F.col("left_values").isNull(), "right only")
        .when(F.col("left_values") == F.col("right_values"), "same").otherwise("conflict")
    )
    return both.select(key, "left_values", "right_values", status.alias("status"))
