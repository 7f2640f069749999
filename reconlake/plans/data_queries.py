"""Queries of the general data problems (4 and 6) over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.operators import units, unpack
from reconlake.session import load

#: field, table, row key, blanks separate values, columns of product_registry that name its values
PACKED = (
    ("makers", "price_stage", "row_id", False, ("manufacturer_share_group", "legal_manufacturer", "japan_mah_or_supplier")),
    ("products", "price_stage", "row_id", False, ("product", "canonical_product")),
    ("mhlw_plan_codes", "locator_match", "match_id", True, ()),
)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_table, src_field, row_id, pos, val): the values of every field that holds two or more."""
    registry = load(spark, sf_dir, "product_registry")
    out = None
    for field, table, key, blanks, columns in PACKED:
        names = unpack.known_names(registry, columns) if columns else []
        rows = unpack.unpack(load(spark, sf_dir, table), key, field, names, blanks).select(
            F.lit(table).alias("src_table"), F.lit(field).alias("src_field"), F.col(key).alias("row_id"), "pos", "val"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, yen): prices that can be told and are not what amount holds."""
    return units.restated(load(spark, sf_dir, "price_stage"))


QUERIES = {"p4_found": p4_found, "p6_found": p6_found}
ORACLES: dict[str, str] = {}
