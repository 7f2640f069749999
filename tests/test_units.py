"""Prices in words, scales, tax, numbers of treatments, changepoints."""

import numpy as np
import pytest

from reconlake.operators import units as U


@pytest.mark.parametrize("text,value", [
    ("4万8,000", 48000), ("千九十六万二千", 10962000), ("7.4万", 74000), ("百四十一万", 1410000), ("1,320,000", 1320000), ("46万3千", 463000), ("x", None), ("", None),
])
def test_number(text, value):
    assert U.number(text) == value


@pytest.mark.parametrize("amount,tax,unit,yen", [
    (225000, "不明", "税込表示 全3回", 75000), (51, "税別", "3 回分 万円", 187000), (None, "税込", "１回につき¥34,000", 34000), (140, "税込", "4回コース(30分/回)(×10,000円)", 350000),
    (100, None, None, None), (100, "不明", "1回", None), (30000, "税込", "2回目以降", 30000), (90000, "税込", "1クール(3回)", 30000), (None, "税別", "十一万円", 121000),
    (26, "内税", "千円", 26000), (80000, "incl. tax", "2回(採血が20ml の場合)", 40000), (None, "税込", "8千円", 8000), (None, None, None, None), (10, "+税", "K円", 11000),
])
def test_statements(spark, amount, tax, unit, yen):
    import datetime

    df = spark.createDataFrame([(1, amount, tax, unit, "f", "p", datetime.datetime(2025, 1, 1))], "row_id long, amount long, tax string, unit string, facility_id string, plan_id string, checked_at timestamp")
    assert U.in_yen(df).first().yen == yen


def test_segments_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(30):
        x = np.concatenate([rng.normal(m, 0.2, rng.integers(1, 6)) for m in rng.choice([0.0, 3.0, 5.0], 3)])
        n, best = len(x), np.inf
        for mask in range(1 << (n - 1)):  # brute force over all segmentations
            cuts = [0, *[i + 1 for i in range(n - 1) if mask >> i & 1], n]
            cost = sum(((x[a:b] - x[a:b].mean()) ** 2).sum() for a, b in zip(cuts, cuts[1:])) + U.PENALTY * (len(cuts) - 2)
            best = min(best, cost)
            if n > 13:
                break
        if n <= 13:
            got = U.segments(x)
            cost = sum(((x[a:b] - x[a:b].mean()) ** 2).sum() for a, b in got) + U.PENALTY * (len(got) - 1)
            assert cost == pytest.approx(best)


def test_unstated_segment_of_another_scale_is_reversed():
    x = np.log10(np.array([100000.0, 110000, 90000, 105, 98, 102, 100000]))
    one, silent = np.ones(7), np.full(7, np.nan)
    assert U.unit_shifts(x, one, x * x, silent, 5.0).tolist() == [0, 0, 0, 3, 3, 3, 0]
    named = np.array([np.nan] * 3 + [4.0] + [np.nan] * 3)  # words name the factor, the segment says that there is one
    assert U.unit_shifts(x, one, x * x, named, 5.0).tolist() == [0, 0, 0, 4, 3, 3, 0]


def test_cells_are_segmented_as_their_values():
    rng = np.random.default_rng(5)
    values = [rng.normal(m, 0.1, k) for m, k in ((5.0, 7), (2.0, 4), (5.1, 9))]
    x = np.array([v.mean() for v in values])
    n, squares = np.array([float(len(v)) for v in values]), np.array([(v * v).sum() for v in values])
    assert U.segments(x, n=n, squares=squares) == [(0, 1), (1, 2), (2, 3)]
    assert U.segments(np.concatenate(values)) == [(0, 7), (7, 11), (11, 20)]


_SCHEMA = "row_id long, amount long, tax string, unit string, facility_id string, plan_id string, checked_at timestamp"


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_result_does_not_depend_on_partitions(spark, partitions):
    import datetime

    t = datetime.datetime(2025, 1, 1)
    rows = [(i, 100 if i >= 9000 else 100000, "税込", None, "f", "p", t + datetime.timedelta(hours=i)) for i in range(12000)]
    df = spark.createDataFrame(rows, _SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        out = U.in_yen(df).where("factor <> 1").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.row_id for r in out} == set(range(9000, 12000)) and {(r.factor, r.decided) for r in out} == {(1000.0, "segment")}


def test_hidden_units_are_found_from_the_histories(spark, data):
    """The words that name a unit hidden in a tenth of the rows that have them: the segments still find the change."""
    import re

    prices = spark.read.parquet(data.replace("0.001", "0.01") + "/price_stage.parquet")
    rows = prices.select("row_id", "amount", "tax", "unit", "facility_id", "plan_id", "checked_at").collect()
    words = re.compile(r"千円単位|単位[:：]?千円?|千円|K円|単位[:：]?万円?|[×xX*]\s*10?,?000\s*円|万円|万")
    said = [r for r in rows if r.amount is not None and r.unit and U.read_statement(r.tax, r.unit)[1] and U.read_statement(r.tax, r.unit)[0] is not None]
    hidden = {r.row_id: words.sub("", r.unit) for r in said[::10]}
    hidden = {k: u for k, u in hidden.items() if U.read_statement(None, u)[1] is None}
    bare = spark.createDataFrame([(*r[:3], hidden.get(r.row_id, r.unit), *r[4:]) for r in rows], _SCHEMA)
    want = {r.row_id: r for r in U.in_yen(prices).collect()}
    got = [r for r in U.in_yen(bare).collect() if r.row_id in hidden]
    assert len(got) >= 50 and sum(r.factor > 1 for r in got) >= 0.9 * len(got)
    assert sum(r.yen == want[r.row_id].yen for r in got) >= 0.75 * len(got)
    # the segments show most of the changes that words name, and no row in yen is taken for another unit
    decided = [r.decided for r in want.values()]
    assert decided.count("segment and words") >= 0.9 * decided.count("words") and decided.count("segment") <= 0.001 * len(rows)
    print(len(got), sum(r.factor > 1 for r in got), sum(r.yen == want[r.row_id].yen for r in got), {d: decided.count(d) for d in set(decided)})


def test_history_crosses_batches(spark):
    import datetime

    t = datetime.datetime(2025, 1, 1)
    rows = [(i, 100000 if i % 50 else 100, "税込", "1回 税込" if i % 50 else None, "f", "p", t + datetime.timedelta(minutes=i)) for i in range(9000)]
    df = spark.createDataFrame(rows, "row_id long, amount long, tax string, unit string, facility_id string, plan_id string, checked_at timestamp")
    out = U.in_yen(df).collect()
    assert len(out) == 9000 and len({r.row_id for r in out}) == 9000


def test_a_long_history_has_one_anchor(spark):
    import datetime

    t = datetime.datetime(2025, 1, 1)
    rows = [(i, 100 if 3000 <= i < 9000 else 100000, "税込", None, "f", "p", t + datetime.timedelta(minutes=i)) for i in range(12000)]
    rows = [(i, 100, x, "千円", *r) if i % 2 and not 3000 <= i < 9000 else (i, a, x, u, *r) for i, a, x, u, *r in rows]
    df = spark.createDataFrame(rows, "row_id long, amount long, tax string, unit string, facility_id string, plan_id string, checked_at timestamp")
    assert {r.yen for r in U.in_yen(df).collect()} == {100000}


def test_long_segments_are_searched_in_time():
    x = np.concatenate([np.full(30000, 5.0), np.full(30000, 2.0)]) + np.random.default_rng(1).normal(0, 0.1, 60000)
    assert U.segments(x) == [(0, 30000), (30000, 60000)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "row_id long, amount long, tax string, unit string, facility_id string, plan_id string, checked_at timestamp")
    assert U.restated(df).count() == 0
