"""Operators without SQL against brute force, and their edge cases."""

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from reconlake.functions import text as T
from reconlake.operators import aggregate as A
from reconlake.operators import extract as X
from reconlake.operators import linkage as L
from reconlake.operators import ordering as O
from reconlake.operators import overrides as U
from reconlake.operators import reconcile as R
from reconlake.sources import markup, pdf, readers

TEXT = "ACP 1回 30,000円(税込)、GPS IIIは 12.5万円\n初診料5,500円 100円 999,999,999円 治療費 30,000円 キャンセル料は3,000円です"


def brute_prices(text, before, after, rules, tokens):
    """Amounts with their surroundings, one after the other."""
    found = []
    for p, times in ((X.YEN_AMOUNT, 1), (X.TEN_THOUSAND_AMOUNT, 10_000)):
        for m in re.finditer(p, text):
            amount = int(float(m[1].replace(",", "")) * times)
            if X.LOWEST <= amount <= X.HIGHEST:
                c = re.sub(r"\s+", " ", text[max(0, m.start() - before) : m.end() + after]).strip()
                tax = "税込" if re.search(X.TAX_IN, c) else "税別" if re.search(X.TAX_OUT, c) else "不明"
                unit = (re.search(X.UNIT, c) or [None, ""])[1]
                toks = tuple([t for t in tokens if t.lower() in c.lower()][:4])
                found.append((sum(n for p_, n in rules if re.search(p_, c)), amount, tax, unit, toks, c))
    once = list({(x[1], x[5]): x for x in reversed(found)}.values())[::-1]
    once.sort(key=lambda x: (-x[0], x[1]))
    out = list({x[1:5]: x for x in reversed(once)}.values())[::-1]
    return [(x[1], x[2], x[3], x[4], x[0]) for x in out][:20]


def test_amounts_in_context_against_brute_force(spark):
    rules = [("治療費|料金", 5), ("ACP|GPS", 2), ("キャンセル", -8)]
    df = spark.createDataFrame([(1, TEXT), (2, None), (3, ""), (4, "円" * 50_000 + TEXT)], "k long, t string")
    got = X.amounts_in_context(df, "k", "t", rules, ["GPS III", "ACP", "GPS"], 12, 9).orderBy("k", "place").collect()
    for k, text in ((1, TEXT), (4, "円" * 50_000 + TEXT)):
        assert [(r.amount, r.tax, r.unit, tuple(r.tokens), r.score) for r in got if r.k == k] == brute_prices(text, 12, 9, rules, ["GPS III", "ACP", "GPS"])
    assert {r.k for r in got} == {1, 4}


def test_line_prices(spark):
    df = spark.createDataFrame([(1, TEXT), (2, None), (3, "")], "k long, t string")
    got = X.line_prices(df, "k", "t", [("治療費", 7, 3)], ["ACP"]).orderBy("place").collect()
    assert [(r.amount, r.line_no, r.score) for r in got] == [(3000, 2, 7), (5500, 2, 7), (30000, 2, 7), (30000, 1, 3), (125000, 1, 3)]
    assert X.line_prices(df.limit(0), "k", "t", [], ["ACP"]).count() == 0


def test_labels_and_places_of_amounts(spark):
    text = "初診料と治療費 3,000円、PRP 20,000円。再診料" + "あ" * 141 + "4,000円"
    df = spark.createDataFrame([(1, text), (2, None)], "k long, t string")
    got = X.labelled_before(df, "k", "t", X.YEN_AMOUNT, {"ancillary": "初診料|再診料", "treatment": "治療費|PRP"}, 140).collect()
    assert [(r.kind, r.label) for r in got] == [("treatment", "治療費"), ("treatment", "PRP"), (None, None)]
    tie = X.labelled_before(df.select("k", F.lit("初診料 1,000円").alias("t")), "k", "t", X.YEN_AMOUNT, {"a": "初診料", "b": "診料"}).first()
    assert tie.kind == "a"
    text = "1,000円 ACP 1,000円 " + "あ" * 80 + "治療費 1,000円"
    df = spark.createDataFrame([(text,)], "t string").select("t", X.amount_spans()("t").alias("a"), T.regex_spans("ACP")("t").alias("p"))
    best = df.select(X.best_amount_place(F.col("t"), F.col("a"), F.lit(1000), F.col("p"), "治療費").alias("b"), X.best_amount_place(F.col("t"), F.col("a"), F.lit(7), F.col("p"), "x").alias("none")).first()
    assert text[best.b.start : best.b.end] == "1,000円" and best.b.start > 80 and best.none is None


def test_amounts_are_added_from_excerpts(spark):
    rows = spark.createDataFrame([("p", 3000, "初診 3,000円 治療 50,000円と50,000円"), ("q", None, None), ("r", 1000, "1,000円")], "k string, amount long, excerpt string")
    got = sorted((r.k, r.amount or 0, r.synthetic) for r in X.augmented(rows, ["k"], "amount", "excerpt").collect())
    assert got == [("p", 3000, False), ("p", 50000, True), ("q", 0, False), ("r", 1000, False)]


def test_hits_in_context(spark):
    df = spark.createDataFrame([(1, "Angel" + "x" * 300 + "PRP Velm"), (2, "Angel PRP"), (3, "PEAK Velm"), (4, None)], "k long, t string")
    got = sorted((r.k, r.word) for r in X.hits_in_context(df, "k", "t", {"Angel": "Angel", "Velm": "Velm", "PEAK": "PEAK"}, "PRP", ["Angel"], ["PEAK"]).collect())
    assert got == [(1, "Velm"), (2, "Angel"), (3, "PEAK")]


def test_tokens_units_and_tax(spark):
    df = spark.createDataFrame([("acp max 両膝 2 部位 1回 税別",), (None,), ("",)], "t string")
    t = F.col("t")
    got = df.select(X.tokens_in(t, ["ACP MAX", "ACP", "APS"]).alias("k"), X.units_of(t).alias("u"), X.tax_of(t).alias("x"), X.unit_of(t).alias("n")).collect()
    assert (got[0].k, got[0].u, got[0].x, got[0].n) == (["ACP MAX", "ACP"], "両膝・2部位・1回", "税別", "1回") and [r.k for r in got[1:]] == [[], []] and got[1].x == "不明"


def names(rng, n):
    return ["".join(rng.choice("あいうえおかき") for _ in range(rng.randint(3, 9))) for _ in range(n)]


def ratio(a, b):
    return 1.0 if a == b else difflib.SequenceMatcher(None, a, b).ratio()


def test_pairs_in_place_against_all_pairs(spark):
    rng = random.Random(4)
    left = [(x, rng.choice(["p", "q", None])) for x in names(rng, 60)] + [("", "p"), (None, "p")]
    right = [(x, rng.choice(["p", "q", None])) for x in names(rng, 60)] + [("", "p"), (None, None)]
    got = {(r.lk, r.rk) for r in L.pairs_in_place(spark.createDataFrame(left, "lk string, place string"), spark.createDataFrame(right, "rk string, place string"), 0.6).collect()}
    assert got == {(a, b) for a, p in left for b, q in right if a and b and (p is None or q is None or p == q) and ratio(a, b) >= 0.6}


def test_best_by_two_names_against_all_pairs(spark):
    rng = random.Random(5)
    rows = lambda n, base: [(base + i, rng.choice("23"), rng.choice(["p", "q", None]), x, rng.choice(["治療甲乙", "治療甲丙", "注射"])) for i, x in enumerate(names(rng, n))]
    left, right = rows(50, 0), rows(50, 100)
    schema = "{} long, kind string, place string, name string, what string"
    got = {r.a: (r.b, round(r.score, 6)) for r in L.best_by_two_names(spark.createDataFrame(left, schema.format("a")), spark.createDataFrame(right, schema.format("b")), "a", "b").collect()}
    want = {}
    for a, k, p, n, w in left:
        for b, k2, p2, n2, w2 in right:
            if k == k2 and (p is None or p2 is None or p == p2) and ratio(n, n2) >= 0.5:
                s = min(1.0, 0.44 * ratio(n, n2) + 0.56 * ratio(w, w2) + (0.12 if n == n2 else 0.05 if n in n2 or n2 in n else 0) + (0.1 if w == w2 else 0))
                if s >= 0.62 and (a not in want or round(s, 6) > want[a][1]):
                    want[a] = (b, round(s, 6))
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}


def test_best_by_two_names_among_all_others(spark, monkeypatch):
    """One list against itself: never its own id, equal rows meet each other, unlike names count by the other text alone."""
    rng = random.Random(7)
    rows = [(i, rng.choice("23"), rng.choice(["p", "q", None]), x, rng.choice(["治療甲乙", "治療甲丙", "注射"])) for i, x in enumerate(names(rng, 70))]
    rows += [(100 + i, *r[1:]) for i, r in enumerate(rows[:12])] + rows[20:24] + [(200, *rows[0][1:]), (201, "4", "p", "かき", "注射"), (202, "2", "p", "xyz", "注射")]
    df = spark.createDataFrame(rows, "a long, kind string, place string, name string, what string")
    got = {r.a: (r.b, round(r.score, 6)) for r in L.best_by_two_names(df, df.withColumnRenamed("a", "b"), "a", "b", least_name=0.0, others=True).collect()}
    want = {}
    for a, k, p, n, w in rows:
        for b, k2, p2, n2, w2 in sorted(rows):
            if a != b and k == k2 and (p is None or p2 is None or p == p2):
                s = round(min(1.0, 0.44 * ratio(n, n2) + 0.56 * ratio(w, w2) + (0.12 if n == n2 else 0.05 if n in n2 or n2 in n else 0) + (0.1 if w == w2 else 0)), 6)
                if s >= 0.62 and (a not in want or s > want[a][1]):
                    want[a] = (b, s)
    assert got == want and 202 in got and 201 not in got


def test_every_plan_is_matched_with_all_others(spark, tmp_path):
    from reconlake.plans import record_queries

    def rows(*plans):
        schema = "plan_id string, facility_id string, category string, prefecture string, facility string, treatment string"
        spark.createDataFrame([(p, "F", c, "岩手県", f, t) for p, c, f, t in plans], schema).write.mode("overwrite").parquet(f"{tmp_path}/treatment_plan.parquet")
        return {r.plan_id: r.other_id for r in record_queries.best_by_facility_and_treatment(spark, str(tmp_path)).collect()}

    assert rows(("P1", "第三種", "青山医院", "注射"), ("P3", "第三種", "青山医院", "注射"), ("P2", "第二種", "青山医院", "注射")) == {"P1": "P3", "P3": "P1"}  # both odd
    assert rows(("P1", "第三種", "青山医院", "膝の注射"), ("P2", "第三種", "緑川整形", "膝の注射")) == {"P1": "P2", "P2": "P1"}  # names unlike
    assert rows(("P1", None, "青山医院", "注射"), ("P2", "第三種", "青山医院", "注射"), ("P", "第三種", None, "注射")) == {"P1": "P2", "P2": "P1"}  # no class, no number, no name


def test_best_at_address(spark):
    l = spark.createDataFrame([(1, "x", "あおい"), (2, "", "あおい"), (3, "y", "か"), (4, None, None)], "a long, address string, name string")
    r = spark.createDataFrame([(10, "x", "あおき"), (11, "x", "あおい医院"), (12, "x", "あおき"), (13, "z", "か")], "b long, address string, name string")
    assert [(r.a, r.b) for r in L.best_at_address(l, r, "a", "b", "address", "name").collect()] == [(1, 11)]


def test_unique_level_needs_length(spark):
    row = lambda i, k: (i, k, k, None)
    l = spark.createDataFrame([row(1, "abcd"), row(2, "abcde"), row(3, "")], "l long, strict string, loose string, place string")
    r = spark.createDataFrame([(9, "x1", "abcd", None), (8, "x2", "abcde", None), (7, "", "", None)], "r long, strict string, loose string, place string")
    assert [(x.l, x.r, x.level) for x in L.cascade(l, r, "l", "r", "strict", "loose", "place").collect()] == [(2, 8, 4)]


def test_alias_by_spaced_then_compact_form(spark):
    known = spark.createDataFrame([("Ostra Technologies", "E"), ("ミドル・アライアンス", "R"), (None, "N")], "alias string, canonical string")
    df = spark.createDataFrame([("ostra  technologies",), ("ミドルアライアンス",), ("Ｏｓｔｒａ　Technologies",), ("other",), (None,)], "m string")
    got = {r.m: r.canonical for r in T.by_alias(df, "m", known, "alias", "canonical").collect()}
    assert got == {"ostra  technologies": "E", "ミドルアライアンス": "R", "Ｏｓｔｒａ　Technologies": "E", "other": "other", None: None}


def test_address_keys_of_different_writing(spark):
    df = spark.createDataFrame([("〒100-0001 東京都千代田区６丁目３４番８号",), ("千代田区6-34-8",), (None,)], "a string")
    got = [tuple(r) for r in df.select(T.address_key(F.col("a"), F.lit("東京都")), T.address_digits_key(F.regexp_replace("a", "〒[0-9-]+ 東京都", ""))).collect()]
    assert got[0] == got[1] == ("千代田区6348", "千代田区6348") and got[2] == (None, None)


def test_counts_and_proofs_of_empty_tables(spark):
    e = spark.createDataFrame([], "k long, t string, v array<string>")
    assert A.placement_summary(e, "k", "t").first().asDict() == {"known": 0, "known_pct": 0.0, "placements": 0, "multiple": 0}
    assert A.most_common(e.select("k", "v"), "v", "k").count() == 0
    p = R.partition_proof(e, "k", "t", e).first()
    assert p.is_partition and p.total == 0
    assert R.reduced_count(e, e, "k").first().remaining == 0
    assert U.both_sides(e, e, "k", "t").count() == 0
    assert O.until_misses(e, "k", "t", F.lit(True)).count() == 0


def test_array_tests_of_empty_and_null(spark):
    df = spark.createDataFrame([(["a", None],), ([],), (None,), (["a"],)], "v array<string>")
    got = [tuple(r.t) for r in df.select(A.array_tests(F.col("v"), lambda x: x == "a").alias("t")).collect()]
    assert got == [(False, True, False), (True, False, True), (True, False, True), (True, True, False)]


def test_ties_of_most_common_go_to_the_first_seen(spark):
    df = spark.createDataFrame([(2, ["b", "a"]), (1, ["c", "b"]), (3, ["c", "a"]), (4, None)], "o long, v array<string>")
    assert [(r.value, r.n) for r in A.most_common(df, "v", "o").orderBy("place").collect()] == [("c", 2), ("b", 2), ("a", 2)]


def test_retry_policy():
    assert [readers.pause_before(a, 503) for a in range(5)] == [5, 10, 20, 40, None] and readers.pause_before(0, 404) is None
    assert [readers.pause_before(a, None) for a in range(4)] == [4, 8, 16, 32] and readers.pause_before(8, 403, 20) == 45


def test_fetch_keeps_errors_and_renews_contexts(spark):
    def make():
        used = []

        def get(u):
            used.append(u)
            if u == "bad":
                raise ValueError("broken")
            return (403, b"") if len(used) > 1 and u == "shy" else (200, f"{u}{len(used)}".encode())

        return get

    df = spark.createDataFrame([("a",), ("shy",), ("bad",), (None,)], "u string").coalesce(1)
    got = {r.u: r for r in readers.fetched(df, "u", make, retries=3, sleep=lambda s: None).collect()}
    assert set(got) == {"a", "shy", "bad"} and got["shy"].status == 200 and got["bad"].status is None and "ValueError: broken" in got["bad"].error


def test_pdf_errors_are_values(spark):
    df = spark.createDataFrame([(bytearray(b"no file"),), (None,), (bytearray(b"%PDF-1.4 broken"),)], "c binary").select(pdf.pdf_pages("c").alias("p"))
    got = [r.p for r in df.collect()]
    assert "ValueError" in got[0].error and got[1].pages is None and got[2].pages == []


def test_look_ahead_of_records_is_bounded(spark):
    rows = [("d", i, t) for i, t in enumerate(["名称", "甲", "住所", "乙", "名称", "丙"] + ["-"] * 12 + ["住所", "丁"])]
    df = spark.createDataFrame(rows, "k string, i long, line string")
    got = {r.name: r.address for r in markup.labelled_records(df, "k", "i", "line", "名称", {"name": "名称", "address": "住所"}).collect()}
    assert got == {"甲": "乙", "丙": None}


def test_office_text_decodes_entities(spark):
    import io
    import zipfile

    f = io.BytesIO()
    with zipfile.ZipFile(f, "w") as z:
        z.writestr("word/document.xml", "<w:p><w:t>A &amp; B &lt;1&gt;</w:t></w:p>")
    assert spark.createDataFrame([(bytearray(f.getvalue()),)], "c binary").select(markup.office_text("c")).first()[0] == "A & B <1>"


def test_checkpoints_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from reconlake import session

    class Ctx:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class S:
                    @staticmethod
                    def getCheckpointDir():
                        class E:
                            @staticmethod
                            def isEmpty():
                                return True
                        return E
                return S

    class Session:
        sparkContext = Ctx
        conf = type("C", (), {"get": staticmethod(lambda k, d: None)})

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session)
