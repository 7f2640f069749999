"""Every query of the subpackage over the whole smallest tables: columns, keys, and agreement with plain facts of the tables."""

import pytest
from pyspark.sql import functions as F

from reconlake.llm import queries

COLUMNS = {
    "p1_found": ["src_table", "src_field", "row_id", "clean"], "p2_found": ["rec_a", "rec_b"], "p3_found": ["facility_id", "match_id"],
    "p5_found": ["src_table", "row_id", "pos", "canonical_product"], "p7_found": ["doc_id", "item_id"], "p9_found": ["doc_id"],
}


@pytest.fixture(scope="module")
def found(spark):
    cache = {}

    def get(name):
        if name not in cache:
            df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
            cache[name] = (df.columns, df.collect())
        return cache[name]

    return get


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs_and_gives_distinct_rows(found, name):
    columns, rows = found(name)
    assert columns == COLUMNS.get(name, columns) and rows
    assert len({tuple(r) for r in rows}) == len(rows)


def test_forms_are_consistent(found, spark):
    from reconlake.llm.canon import canonical

    _, rows = found("p1_found")
    assert all(canonical(r.clean) == r.clean for r in rows)
    prices = {r.row_id: r for r in spark.read.parquet("/root/testdata/sf0.001/price_stage.parquet").select("row_id", "facility", "products").collect()}
    own = [r for r in rows if r.src_table == "price_stage"]
    assert own and all(prices[r.row_id][r.src_field] != r.clean for r in own)


def test_pairs_are_closed_and_ordered(found):
    _, rows = found("p2_found")
    pairs = {(r.rec_a, r.rec_b) for r in rows}
    assert all(a < b for a, b in pairs)
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    assert all((min(x, y), max(x, y)) in pairs for a in near for x in near[a] for y in near[a] if x != y)


def test_confidences_of_a_row_do_not_exceed_one(found):
    _, rows = found("p3_confidence")
    assert all(0.5 < r.confidence <= 1 for r in rows)
    assert {(r.facility_id, r.match_id) for r in rows} == {(r.facility_id, r.match_id) for r in found("p3_found")[1]}


def test_mapped_products_are_of_the_list(found, spark):
    _, rows = found("p5_found")
    names = {r[0] for r in spark.read.parquet("/root/testdata/sf0.001/product_registry.parquet").select("canonical_product").collect()}
    assert {r.canonical_product for r in rows} <= names | {"UNMATCHED"} and any(r.canonical_product == "UNMATCHED" for r in rows)


def test_mixture_keeps_its_bounds(found, spark):
    target = {r.source: r for r in spark.read.parquet("/root/testdata/sf0.001/mix_target.parquet").collect()}
    _, rows = found("p8_mixture")
    assert all(r.copy_no <= target[r.source].max_repeat for r in rows)
    _, shares = found("p8_shares")
    budgets = sorted({r.budget for r in shares})
    assert len(budgets) == 2 and sum(r.n_tokens for r in rows) == sum(r.mix_tokens for r in shares if r.budget == budgets[0]) <= budgets[0]
    assert any("too small" in r.note for r in shares if r.budget == budgets[1])


def test_rates_follow_the_scores(found, spark):
    _, scores = found("p9_scores")
    assert len(scores) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    flagged = {r.doc_id for r in scores if r.score >= 0.5}
    assert flagged == {r.doc_id for r in found("p9_found")[1]}
    rates = {r.source: r for r in found("p9_rates")[1]}
    assert sum(r.n_flagged for r in rates.values()) == len(flagged) and sum(r.n_docs for r in rates.values()) == len(scores)
    assert all(r.score == max(r.abuse, r.hate, r.sexual) for r in scores)


def test_leaks_name_known_documents_and_items(found, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id").where(F.col("doc_id").isin([r.doc_id for r in found("p7_found")[1]])).count()
    assert docs == len({r.doc_id for r in found("p7_found")[1]})
