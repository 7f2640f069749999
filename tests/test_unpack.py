"""Packed fields: rules by skeleton, names with signs, quotes, empties, nulls."""

import pytest

from reconlake.operators import unpack as U

NAMES = ["Corvanex A/B", "オルト・ラボラ", "Hokurei Bio, Inc."]


def values(spark, rows, blank=False, least=1):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "k long, f string")
    out = {}
    for r in U.unpack(df, "k", "f", NAMES, blank, least).orderBy("k", "pos").collect():
        out.setdefault(r.k, []).append((r.pos, r.val))
    return [[v for _, v in out.get(i, [])] for i in range(len(rows))], out


def test_delimiters_names_and_quotes(spark):
    rows = [
        "a|b", "a ; b", "a、b／c", "a\nb\tc", "①a ②b", "1) a 2) b", '["a", "b, c"]', '"a","b;c"', "x + y", "a| |b|",
        "Corvanex A/B|N/A", "corvanex a/b/Kinedra", "オルト・ラボラ・Orthenna", "Hokurei Bio, Inc., Seiwanel", "Corvanex",
        "コルバネクスA/B キット", "Velmatrix (PRP)", "a / b, c | d", "CorvanexA/B|x",
    ]
    got, _ = values(spark, rows)
    assert got == [
        ["a", "b"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c"], ["a", "b"], ["a", "b"], ["a", "b, c"], ["a", "b;c"], ["x", "y"], ["a", "b"],
        ["Corvanex A/B", "N/A"], ["corvanex a/b", "Kinedra"], ["オルト・ラボラ", "Orthenna"], ["Hokurei Bio, Inc.", "Seiwanel"], ["Corvanex"],
        ["コルバネクスA/B キット"], ["Velmatrix (PRP)"], ["a", "b", "c", "d"], ["CorvanexA/B", "x"],
    ]


def test_positions_count_from_one_without_empties(spark):
    _, out = values(spark, ["|a||b|"])
    assert out[0] == [(1, "a"), (2, "b")]


def test_blanks_split_codes_only(spark):
    assert values(spark, ["01B1 02C2"], blank=True)[0] == [["01B1", "02C2"]]
    assert values(spark, ["Zelvane Medical"])[0] == [["Zelvane Medical"]]


def test_nulls_empties_repeats_and_long_fields(spark):
    long = "|".join(["v"] * 5000)
    got, _ = values(spark, [None, "", "  ", "a|a", long])
    assert got[:4] == [[], [], [], ["a", "a"]] and len(got[4]) == 5000


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a|b", "x")], "k long, f string, val string")
    assert [r.val for r in U.unpack(df, "k", "f", []).collect()] == ["a", "b"]
    assert U.unpack(df.limit(0), "k", "f", []).count() == 0


@pytest.mark.parametrize("skeleton,rule", [("w|w", "[\\|]"), ("w", ""), ("w、w;w", "[;、]")])
def test_rule_of_skeleton(skeleton, rule):
    assert U.resolve_skeleton(skeleton) == rule
