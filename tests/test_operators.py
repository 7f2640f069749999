"""Core operators on small cases."""

import pytest
from pyspark.sql import functions as F

from reconlake.functions import text as T
from reconlake.operators import aggregate as A
from reconlake.operators import extract as X
from reconlake.operators import linkage as L
from reconlake.operators import ordering as O
from reconlake.operators import overrides as U
from reconlake.operators import reconcile as R


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(col(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("f,value,want", [
    (T.collapse_space, " a　 b\n\nc ", "a b c"), (T.compact, "A-B（C）・D 　e", "abcde"), (lambda c: T.strip_legal(c), "社会医療法人社団X", "X"),
    (T.repair_digits, "12 345 ,6", "12345,6"), (T.code_of_url, "https://h.example/x/download/AB12/5/0", "AB12"), (T.host_of_url, "https://h.example:80/x", "h.example"),
    (T.unwrap_redirect, "https://s.example/l/?uddg=https%3A%2F%2Fa.example%2Fb", "https://a.example/b"), (T.unwrap_redirect, "https://b.example/ck?u=a1aHR0cHM6Ly9hLmV4YW1wbGUv", "https://a.example/"),
    (T.prefecture_of, "〒1 福岡県x", "福岡県"), (T.region_of, "福岡県", "九州"), (T.region_of, "x", ""), (T.nfkc, "ＡＢｶﾞ", "ABガ"), (T.compact, None, None), (T.address_key, "〒123-4567 緑市1丁目2番3号", "緑市123"),
])
def test_text(spark, f, value, want):
    assert one(spark, f, value) == want


def test_sequence_ratio_is_directed(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(T.seq_ratio("a", "b")).collect()] == [0.25, 0.5, None]


def test_regex_spans(spark):
    df = spark.createDataFrame([("a1b22", ), (None,)], "t string")
    got = [r[0] for r in df.select(T.regex_spans("[0-9]+")("t")).collect()]
    assert [(s.start, s.end, s.hit) for s in got[0]] == [(1, 2, "1"), (3, 5, "22")] and got[1] is None


def test_aliases_longest_first(spark):
    assert one(spark, T.aliases, "医療法人緑会 青空第一クリニック") == ["医療法人緑会青空第一クリニック", "緑会青空第一クリニック", "青空第一クリニック"]


def test_lines_skip_blanks_before_numbering(spark):
    df = spark.createDataFrame([(1, "a\n\n b \nc\nd\ne"), (2, None), (3, "")], "k long, t string")
    rows = X.lines(df, "k", "t").orderBy("k", "line_no").collect()
    assert [(r.line_no, r.line) for r in rows if r.k == 1] == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    assert rows[0].near == "a b c" and rows[2].near == "a b c d e" and rows[0].before == "" and rows[-1].after == "" and rows[1].after == "c"
    assert {r.k for r in rows} == {1}


def test_ranges_suppress_their_ends(spark):
    df = spark.createDataFrame([(1, "50,000〜30,000円 初診 3,000円")], "k long, t string")
    assert sorted((r.kind, r.low, r.high) for r in X.amounts_and_ranges(df, "k", "t").collect()) == [("point", 3000, 3000), ("range", 30000, 50000)]


def test_dictionary_prefers_longer_names(spark):
    df = spark.createDataFrame([(1, "GPS III and ACP"), (2, "none")], "k long, t string")
    assert [(r.k, r.hits) for r in X.dictionary_hits(df, "k", "t", ["GPS", "GPS III", "ACP"]).collect()] == [(1, ["ACP", "GPS III"])]


def test_chunks_and_snippet(spark):
    assert one(spark, lambda c: X.chunks(c, "20[0-9]{2}/"), "x2024/01 a 2025/02 b") == ["x", "2024/01 a ", "2025/02 b"]
    assert one(spark, lambda c: X.snippet(c, "fee", 2, 3), "the fee is") == "e fee is"


def test_numbering_is_global_and_ordered(spark):
    df = spark.createDataFrame([(i * 7 % 101, str(i)) for i in range(101)], "a long, b string")
    rows = O.numbered(df, ["a"]).orderBy("rn").collect()
    assert [r.rn for r in rows] == list(range(1, 102)) and [r.a for r in rows] == sorted(r.a for r in rows)
    assert O.numbered(df.limit(0), ["a"]).count() == 0


def test_shards_batches_round_robin(spark):
    df = spark.createDataFrame([(f"k{i:02d}",) for i in range(10)], "k string")
    assert sorted(r.k for r in O.modulo_shard(df, ["k"], 4).where("shard = 1").collect()) == ["k01", "k05", "k09"]
    assert sorted((r.batch_no, r["count"]) for r in O.batches(df, ["k"], 4).groupBy("batch_no").count().collect()) == [(0, 4), (1, 4), (2, 2)]
    s = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "p string, n long")
    assert [(r.p, r.n) for r in O.round_robin(s, "p", ["n"], 3).orderBy("turn", "p").collect()] == [("a", 1), ("b", 1), ("a", 2)]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k long, v string")
    assert not R.multiset_equal(a, b) and R.multiset_equal(a, a)
    assert sorted((r.k, r.surplus) for r in R.multiset_difference(a, b).collect()) == [(1, 1), (3, -1)]
    assert [(r.k, r.side) for r in R.missing_and_extra(a, b, ["k"]).collect()] == [(3, "extra")]
    c = spark.createDataFrame([(1, "y"), (2, None)], "k long, v string")
    assert {(r.k, r.left_value, r.right_value) for r in R.mismatches(a, c, "k", ["v"]).collect()} == {(1, "x", "y")}
    assert [tuple(r) for r in R.overlaps(spark.createDataFrame([(1, "A"), (1, "B"), (2, "A")], "k long, t string"), "k", "t").collect()] == [("A", "B", 1)]
    with pytest.raises(R.IntegrityError):
        R.require_unique(a, "k")
    with pytest.raises(R.IntegrityError):
        R.require_present(b, a, "k")


def test_overrides(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(tuple(r) for r in U.upsert(old, new, "k").collect()) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(tuple(r) for r in U.insert_if_absent(old, new, "k").collect()) == [(1, "a"), (2, "b"), (3, "C")]
    p = U.precedence(old, "k", "v", [("first", new), ("second", spark.createDataFrame([(2, None)], "k long, v string"))])
    assert sorted((r.k, r.v, r.v_source) for r in p.collect()) == [(1, "a", "base"), (2, None, "second")]
    r = U.route(old, [("one", F.col("k") == 1)], "rest")
    assert sorted((x.k, x.route) for x in r.collect()) == [(1, "one"), (2, "rest")]


def test_cascade_levels(spark):
    left = spark.createDataFrame([(1, "abc", "bc", "P"), (2, "q", "bc", "P"), (3, "zz", "z", None), (4, "n", "n", "P")], "l long, s string, o string, p string")
    right = spark.createDataFrame([(10, "abc", "bc", "P"), (11, "zz", "z", "Q"), (12, "n", "n", "Q"), (13, "n", "n", "R")], "r long, s string, o string, p string")
    got = sorted((x.l, x.r, x.level) for x in L.cascade(left, right, "l", "r", "s", "o", "p").collect())
    assert got == [(1, 10, 1), (2, 10, 2), (3, 11, 3)]


def test_containment_against_brute_force(spark):
    import itertools
    import random

    rnd = random.Random(5)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(3, 9))) for _ in range(60)]
    left = spark.createDataFrame([(i, w, "P") for i, w in enumerate(words[:30])], "l long, k string, b string")
    right = spark.createDataFrame([(i, w, "P") for i, w in enumerate(words[30:])], "r long, k string, b string")
    got = {(x.l, x.r) for x in L.containment(left, right, "l", "r", "k", "b").collect()}
    want = {(i, j) for (i, a), (j, b) in itertools.product(enumerate(words[:30]), enumerate(words[30:])) if min(len(a), len(b)) >= 5 and (a in b or b in a)}
    assert got == want


def test_best_in_block_against_brute_force(spark):
    left = spark.createDataFrame([(1, "B", "abcd"), (2, "B", "xxxx"), (3, "C", "abcd")], "l long, b string, lk string")
    right = spark.createDataFrame([(5, "B", "abcx"), (4, "B", "abcx"), (6, "B", "zzzz")], "r long, b string, rk string")
    score = F.round(1 - F.levenshtein("lk", "rk") / F.greatest(F.length("lk"), F.length("rk")), 4)
    assert [tuple(x) for x in L.best_in_block(left, right, "l", "r", ["b"], score, 0.62).collect()] == [(1, 4, 0.75)]


@pytest.mark.parametrize("name", ["fuzzy_blocked_best_match", "sequence_ratio_best_match"])
def test_best_match_queries_against_brute_force(spark, name):
    import difflib

    from reconlake.plans import engine_queries as E

    data = "/root/testdata/sf0.01"
    left, right = (x.collect() for x in E._named_places(spark, data))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    def score(a, b):
        if name.startswith("sequence"):
            return difflib.SequenceMatcher(None, a, b).ratio()
        return round(1 - distance(a, b) / max(len(a), len(b)), 4)

    want = {}
    for a in left:
        near = [b for b in right if a.place is None or b.place is None or a.place == b.place]
        best = max(((score(a.lk, b.rk), -b.match_id) for b in near if a.lk and b.rk), default=(0, 0))
        if best[0] >= 0.62:
            want[a.facility_id] = (-best[1], round(best[0], 6))
    got = {r.facility_id: (r.match_id, round(r.score, 6)) for r in E.QUERIES[name](spark, data).collect()}
    assert got == want and len(want) > 100


def test_aggregates(spark):
    df = spark.createDataFrame([("f", "b", 1, "x"), ("f", "a", 2, None), ("f", "a", 3, ""), ("g", None, 4, "y")], "k string, m string, o long, s string")
    rows = {r.k: r for r in A.evidence_union(df, ["k"], {"ms": "m"}, {"last": "s"}, "o").collect()}
    assert rows["f"].ms == "a|b" and rows["f"]["last"] == "" and rows["g"].ms == ""
    assert {r.k: r.s for r in A.first_nonempty(df, ["k"], ["s"], "o").collect()} == {"f": "x", "g": "y"}
    assert {r.m: (r.n, r.share) for r in A.share(df, "k", "m").collect()} == {"a": (1, 0.5), "b": (1, 0.5)}
    assert [tuple(r) for r in A.conflicts(df, "k", "m").collect()] == [("f", 2, "a|b")]
    best = A.best_group(spark.createDataFrame([("p", "A", 12), ("p", "A", 1), ("p", "B", 12), ("p", "B", 2), ("p", "B", 3)], "k string, u string, s long"), "k", "u", "s")
    assert {r.u for r in best.collect()} == {"B"} and best.count() == 3


def test_nearest_before(spark):
    df = spark.createDataFrame([(1, "GPS 100円 and " + "x" * 120 + " 200円 ACP 300円"), (2, None)], "k long, t string")
    got = [(r.mark, r.token) for r in X.nearest_before(df, "k", "t", "[0-9]+円", "GPS|ACP", 100).orderBy("place").collect()]
    assert got == [("100円", "GPS"), ("200円", None), ("300円", "ACP")]


def test_name_mentions(spark, monkeypatch):
    monkeypatch.setattr(X, "NAME_BLOCK", 2)  # several blocks give the same rows
    df = spark.createDataFrame([(1, "abcd efgh"), (2, None), (3, "xefghx abcdabcd")], "k long, t string")
    names = spark.createDataFrame([("abcd",), ("efgh",), ("zzzz",), ("ab",), (None,)], "n string")
    assert sorted(tuple(r) for r in X.name_mentions(df, "k", "t", names, "n").collect()) == [(1, "abcd"), (1, "efgh"), (3, "abcd"), (3, "efgh")]
    assert X.name_mentions(df, "k", "t", names.limit(0), "n").count() == 0


def test_preceding_within_reach(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(["a", None, None, None, None, "b"])], "k long, i long, v string")
    got = [r.p for r in L.preceding(df, "k", ["i"], F.col("v"), "p", 3, own=True).orderBy("i").collect()]
    assert got == ["a", "a", "a", "a", None, "b"]


def test_best_occurrence_and_evidence(spark):
    df = spark.createDataFrame([("5円 " + "x" * 60 + " 費用 7円",), ("none",)], "t string").withColumn("s", T.regex_spans("[0-9]円")("t"))
    got = [r.b for r in df.select(X.best_occurrence(F.col("t"), F.col("s"), "費用", 10).alias("b")).collect()]
    assert got[0].hit == "7円" and got[1] is None
    e = spark.createDataFrame([(["x"], ["y"]), (None, ["y"])], "e array<string>, i array<string>")
    assert [r[0] for r in e.select(A.merged_evidence(F.col("e"), F.col("i"))).collect()] == [["x"], ["y"]]
    assert [r[0] for r in e.select(A.merged_evidence(F.col("e"), F.col("i"), False)).collect()] == [["x", "y"], ["y"]]
