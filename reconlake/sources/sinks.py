"""Writers: envelopes, delimited files with placeholder rows, compressed snapshots, routed writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_envelope(items: DataFrame, summary: DataFrame, path: str) -> None:
    """Items and a one-row summary below one folder, as JSON lines."""
    items.write.mode("overwrite").json(f"{path}/items")
    summary.write.mode("overwrite").json(f"{path}/summary")


def exploded(df: DataFrame, array: str, keep: list[str], placeholder: bool = True) -> DataFrame:
    """One row an entry of the array of structs; with placeholder, a row of empty fields where there is none."""
    explode = F.explode_outer if placeholder else F.explode
    return df.select(*keep, explode(array).alias("_e")).select(*keep, "_e.*")


def write_delimited(df: DataFrame, path: str, columns: list[str], sep: str = "\t") -> None:
    """The given columns with a header; further columns are left out, arrays joined by |."""
    kinds = dict(df.dtypes)
    cols = [F.array_join(c, "|").alias(c) if kinds[c] == "array<string>" else F.col(c) for c in columns]
    df.select(*cols).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def write_routes(df: DataFrame, path: str, column: str = "route") -> None:
    """One folder a route, in one pass over df."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)
