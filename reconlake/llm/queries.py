"""Queries of the llm subpackage over their whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.llm import canon, labelmodel, leaks, mapping, mixture, names, toxicity
from reconlake.operators import unpack
from reconlake.session import load, ship_package


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_table, src_field, row_id, clean): every field value that is not in the consistent form."""
    ship_package(spark)
    prices, matches = load(spark, sf_dir, "price_stage"), load(spark, sf_dir, "locator_match")
    names = unpack.known_names(load(spark, sf_dir, "product_registry"), ("product", "canonical_product"))
    odd = prices.select("row_id", "products").where(canon.suspicious(F.col("products")))
    single = unpack.split_values(odd, "products", names).where(F.size("_values") < 2)

    def tagged(rows: DataFrame, table: str, field: str, key: str) -> DataFrame:
        return canon.deviations(rows, key, field).select(
            F.lit(table).alias("src_table"), F.lit(field).alias("src_field"), F.col(key).alias("row_id"), "clean"
        )

    return (
        tagged(prices, "price_stage", "facility", "row_id")
        .unionByName(tagged(single, "price_stage", "products", "row_id"))
        .unionByName(tagged(matches, "locator_match", "source_facility_name", "match_id"))
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    facilities = names.records(load(spark, sf_dir, "nonqueue_facility"), "facility_id", "facility", "address", "prefecture")
    return facilities.unionByName(names.records(load(spark, sf_dir, "locator"), "locator_id", "name", "address"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_a, rec_b): pairs of records that mean the same facility at the same place."""
    return names.same_facility(_records(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(facility_id, match_id): rows of locator_match and the facility records they describe."""
    return p3_confidence(spark, sf_dir).select("facility_id", "match_id")


def p3_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(match_id, facility_id, confidence)."""
    return labelmodel.described(load(spark, sf_dir, "locator_match"), load(spark, sf_dir, "nonqueue_facility"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_table, row_id, pos, canonical_product): single values not written as in the list, mapped to it or UNMATCHED."""
    registry = load(spark, sf_dir, "product_registry")
    names = unpack.known_names(registry, ("product", "canonical_product"))
    values = None
    for table, key, field in (("price_stage", "row_id", "products"), ("locator_match", "match_id", "source_products")):
        rows = unpack.unpack(load(spark, sf_dir, table), key, field, names, least=1)
        rows = rows.select(F.lit(table).alias("src_table"), F.col(key).alias("row_id"), "pos", "val")
        values = rows if values is None else values.unionByName(rows)
    return mapping.map_values(values, "val", registry).select("src_table", "row_id", "pos", "canonical_product")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id): documents that repeat a test item fully or partly."""
    return leaks.leaked(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_item")).select("doc_id", "item_id")


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, copy_no, source, n_tokens): the mixture, one row per document and use."""
    return mixture.mixture(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_target"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted and reached share of each source at the largest budget that keeps all targets and at that of all documents,
    with a note where the target cannot be reached."""
    return mixture.shares_at_each_budget(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_target"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id): documents with at least one abusive, hateful or sexual passage."""
    return toxicity.flagged(load(spark, sf_dir, "documents"), load(spark, sf_dir, "doc_label")).select("doc_id")


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, abuse, hate, sexual, score) of every document."""
    return toxicity.scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "doc_label"))


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, n_docs, n_flagged, rate)."""
    return toxicity.rates(load(spark, sf_dir, "documents"), load(spark, sf_dir, "doc_label"))


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p3_confidence": p3_confidence,
    "p5_found": p5_found,
    "p7_found": p7_found,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_scores": p9_scores,
    "p9_rates": p9_rates,
}
ORACLES: dict[str, str] = {}
