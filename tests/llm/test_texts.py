"""Leaks, mixture and content scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reconlake.llm import leaks, mixture, toxicity

KINDS = [
    "室温は{}度から{}度に上がった。", "倍率{}と倍率{}の製剤を遠心筒で比べた。", "{}番の施設で搬送の遅れが{}日続いた。", "{}歳の大工は満足度が{}にとどまった。", "毎分{}00回転、{}分で上層は橙色になった。",
    "男性{}人のうち{}人に夜間痛があった。", "左膝の骨棘は{}週で{}ミリ縮んだ。", "合同部会は署名の欠落を{}件数え{}日後に調べた。",
]


def item(k):
    """Four sentences of eight kinds with numbers of their own, and the common closing phrase."""
    rng = np.random.default_rng(k)
    return "".join(KINDS[i].format(*rng.integers(2, 399, 2)) for i in rng.permutation(8)[:4]) + "次に取るべき手順はどれか。"


ITEMS = [(k, item(k)) for k in range(1, 61)] + [(90, "左膝の骨棘は19週で2.2ミリ縮んだ。51歳の大工は満足度が80にとどまった。4.5mLを18週あけて右肩に入れた。次に取るべき手順はどれか。")]


def naive_align(item, weight, text):
    """Smith-Waterman cell by cell."""
    m = weight.mean()
    h = np.zeros((len(item) + 1, len(text) + 1))
    for i, ch in enumerate(item, 1):
        for j, x in enumerate(text, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (weight[i - 1] if ch == x else -m), h[i - 1, j] - 0.7 * m, h[i, j - 1] - 0.7 * m)
    return h.max() / weight.sum()


def test_alignment_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        item = "".join(rng.choice(list("abcd"), 12))
        texts = ["".join(rng.choice(list("abcd"), rng.integers(5, 25))) for _ in range(4)]
        w = rng.random(12) + 0.1
        assert leaks.align(item, w, texts) == pytest.approx([naive_align(item, w, t) for t in texts], abs=1e-5)


def test_leaks(spark):
    one = ITEMS[0][1]
    docs = [
        (1, "前置き。" + one + "後書き。"), (2, "まえ。" + one.replace("7", "７").replace("。", "。\n") + "あと"), (3, "".join(one.split("。")[1:4])[:30] + "(中略)" + "".join(one.split("。")[1:4])[30:]),
        (4, "室温は3度から4度に上がった。次に取るべき手順はどれか。"), (5, None), (6, ""), (7, "あ" * 200_000 + one), (8, ITEMS[-1][1][:12]),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(ITEMS + [(99, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaked(d, i).collect()}
    assert got >= {(1, 1), (2, 1), (3, 1), (7, 1)} and not {x for x in got if x[0] in (4, 5, 6, 8) or x[1] != 1}
    assert leaks.leaked(d.limit(0), i).count() == 0 and leaks.leaked(d, i.limit(0)).count() == 0


def test_item_in_most_documents_keeps_its_seeds(spark):
    d = spark.createDataFrame([(k, ITEMS[0][1] + str(k)) for k in range(300)] + [(1000, ITEMS[-1][1])], "doc_id long, text string")
    i = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert leaks.leaked(d, i).where("item_id = 1").count() == 300


def test_partial_leaks_beside_a_whole_copy(spark):
    one = ITEMS[0][1]
    part = one[: int(len(one) * 0.45)]
    d = spark.createDataFrame([(0, one)] + [(k, f"別の報告{k}。{part}") for k in range(1, 31)], "doc_id long, text string")
    i = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert leaks.scores(d, i).where("item_id = 1").count() == 31
    assert leaks.leaked(d, i, 0.3).where("item_id = 1").count() == 31


@pytest.mark.parametrize("block", [4000, 5])
def test_repeated_and_nearly_equal_items(spark, monkeypatch, block):
    monkeypatch.setattr(leaks, "ITEM_BLOCK", block)
    one = ITEMS[0][1]
    equal = [(200 + k, one) for k in range(7)]
    near = [(300 + k, f"{one[:20]}{k}{k}{one[20:]}") for k in range(7)]
    d = spark.createDataFrame([(1, "前置き。" + one + "後書き。")], "doc_id long, text string")
    i = spark.createDataFrame(ITEMS[1:] + equal + near, "item_id long, text string")
    got = {r.item_id for r in leaks.leaked(d, i).collect()}
    assert got == {k for k, _ in equal + near}


def test_second_passage_is_scored(spark):
    one = ITEMS[0][1]
    d = spark.createDataFrame([(1, one[:16] * 12 + "あ" * 1000 + one[:30] + "略" + one[30:])], "doc_id long, text string")
    i = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert leaks.scores(d, i).where("item_id = 1").first().score > 0.9


@pytest.mark.parametrize("parts", [2, 4, 8])
def test_far_parts_are_chained(spark, parts):
    """An item repeated completely in far parts leaks; the same parts out of order do not."""
    one = ITEMS[0][1]
    size = -(-len(one) // parts)
    pieces = [one[a : a + size] for a in range(0, len(one), size)]
    gap = "あ" * 1500
    d = spark.createDataFrame([(1, gap + gap.join(pieces) + gap), (2, gap.join(reversed(pieces)))], "doc_id long, text string")
    i = spark.createDataFrame(ITEMS, "item_id long, text string")
    score = {r.doc_id: r.score for r in leaks.scores(d, i).where("item_id = 1").collect()}
    assert score[1] >= 0.8 and score.get(2, 0.0) < 0.65


def documents(spark):
    text = {"a": "one two three four", "b": "five six seven", "c": "eight"}
    rows = [(n * 10 + j, text[s], s) for n, s in enumerate("abc") for j in range({"a": 9, "b": 9, "c": 3}[s])] + [(90, None, "a"), (91, "", "a"), (92, "x", None), (93, "x", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def targets(spark, rows=(("a", 0.5, 1), ("b", 0.4, 2), ("c", 0.1, 3), ("gone", 0.0, 1))):
    return spark.createDataFrame(list(rows), "source string, weight double, max_repeat int")


def test_mixture_against_a_direct_queue(spark):
    d, t = documents(spark), targets(spark)
    counts = {r.doc_id: r for r in mixture.token_counts(d).collect()}
    h = {(r.doc_id, r.c): r.h & (1 << 64) - 1 for c in (1, 2, 3) for r in d.select("doc_id", F.lit(c).cast("bigint").alias("c"), F.xxhash64(F.lit(mixture.SEED), F.lit(c).cast("bigint"), "doc_id").alias("h")).collect()}
    queue = []
    budget = mixture.reachable_budget(mixture._supply(d.sparkSession.createDataFrame([tuple(r) for r in counts.values()], "doc_id long, source string, n_tokens long"), t))
    for s, w, most in (("a", 0.5, 1), ("b", 0.4, 2), ("c", 0.1, 3)):
        own, done = [r for r in counts.values() if r.source == s and r.n_tokens], 0
        for c in range(1, most + 1):
            for r in sorted(own, key=lambda r: (h[r.doc_id, c] >> 54, h[r.doc_id, c] if h[r.doc_id, c] < 1 << 63 else h[r.doc_id, c] - (1 << 64), r.doc_id)):
                done += r.n_tokens
                queue.append((done / w, s, r.doc_id, c, r.n_tokens))
    want, used = set(), 0
    for _, s, i, c, n in sorted(queue):
        if used + n > budget:
            break
        used += n
        want.add((i, c))
    got = {(r.doc_id, r.copy_no) for r in mixture.mixture(d, t).collect()}
    assert got == want


def test_shares_and_notes(spark):
    d = documents(spark)
    r = {x.source: x for x in mixture.shares(d, targets(spark)).collect()}
    assert set(r) == {"a", "b", "c"} and abs(sum(x.share for x in r.values()) - 1) < 1e-9
    over = {x.source: x.note for x in mixture.shares(d, targets(spark), budget=10_000).collect()}
    assert "too small" in over["c"]
    assert mixture.mixture(d.limit(0), targets(spark)).count() == 0
    most = mixture.mixture(d, targets(spark), budget=10_000).groupBy("source").agg(F.max("copy_no").alias("m")).collect()
    assert {x.source: x.m for x in most} == {"a": 1, "b": 2, "c": 3}


@pytest.mark.parametrize("budget", [1, 57, 300, 900, 10_000])
def test_bins_are_cut_as_rows(spark, monkeypatch, budget):
    """Few and small bins give the mixture that one bin gives; sources that run out leave the rest to the others."""
    d, t = documents(spark), targets(spark)
    pick = lambda: {(r.doc_id, r.copy_no, r.n_tokens) for r in mixture.mixture(d, t, budget=budget).collect()}
    want = pick()
    monkeypatch.setattr(mixture, "EDGE_BINS", 3)
    monkeypatch.setattr(mixture, "EDGE_ROWS", 1)
    assert pick() == want
    assert sum(n for *_, n in want) <= budget


def test_a_budget_is_filled_when_small_sources_run_out(spark):
    d = spark.createDataFrame([(k, "one two three", "a") for k in range(5)] + [(100 + k, "one two three", "b") for k in range(50)], "doc_id long, text string, source string")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 4)], "source string, weight double, max_repeat int")
    used = mixture.mixture(d, t, budget=500).agg(F.sum("n_tokens")).first()[0]
    assert 490 < used <= 500
    notes = {(x.source, x.budget): x.note for x in mixture.shares_at_each_budget(d, t).collect()}
    assert len(notes) == 4 and any("too small" in n for n in notes.values())


BENIGN = ["The fee is JPY {n} for one session.", "A nurse explains the {n} forms.", "The wait was {n} minutes and the clinic is clean.", "Please cancel by {n} o'clock."]
BAD = {"abuse": "You are a pathetic idiot, drop dead.", "hate": "Those people are vermin and must be wiped out.", "sexual": "Hot naked girls waiting for you tonight."}


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        lines = [BENIGN[i].format(n=rng.integers(1, 60)) for i in rng.integers(0, 4, 5)]
        label = "none"
        if rng.random() < 0.25:
            label = ["abuse", "hate", "sexual"][rng.integers(0, 3)]
            lines.insert(int(rng.integers(0, 5)), BAD[label])
        out.append((k, "\n".join(lines), label))
    return out


def test_chain_on_held_out_texts():
    data = corpus(300, 1)
    chain = toxicity.train([t for _, t, _ in data], [x for _, _, x in data])
    test = corpus(300, 2)
    p = chain.probabilities([t for _, t, _ in test])
    truth = np.array([x != "none" for _, _, x in test])
    assert ((p.max(1) >= 0.5) == truth).mean() > 0.97
    for k, c in enumerate(toxicity.CATEGORIES):
        own = np.array([x == c for _, _, x in test])
        assert p[own, k].mean() > 0.6


def test_scores_of_odd_texts(spark):
    data = corpus(120, 3)
    docs = spark.createDataFrame([(k, t, "s", 1) for k, t, _ in data] + [(900, None, None, 1), (901, "", "t", 1), (902, "ok " * 100_000 + BAD["abuse"], "t", 1)], "doc_id long, text string, source string, score int")
    labels = spark.createDataFrame([(k, x) for k, _, x in data] + [(5555, "abuse"), (1, None)], "doc_id long, label string")
    s = {r.doc_id: r.score for r in toxicity.scores(docs, labels).collect()}
    assert s[900] == 0 and s[901] == 0 and len(s) == 123
    rates = {r.source: r for r in toxicity.rates(docs, labels).collect()}
    assert rates["t"].n_docs == 2 and None in rates
    none = spark.createDataFrame([(0, "none")], "doc_id long, label string")
    assert toxicity.flagged(docs, none).count() == 0 and toxicity.scores(docs.limit(0), labels).count() == 0
