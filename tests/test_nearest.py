"""Search of the best match in a block: against brute force, and how little of the block is compared."""

import difflib
import random

import numpy as np
import pytest

from reconlake.operators import nearest as N


def texts(rng, n):
    return ["".join(rng.choice("青山緑川東西本町医院クリニ𠮷") for _ in range(rng.randint(1, 12))) for _ in range(n)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def ratio(a, b):
    return 1.0 if a == b else difflib.SequenceMatcher(None, a, b).ratio()


@pytest.mark.parametrize("kind", ["edit", "ratio"])
def test_best_texts_against_all_pairs(kind, monkeypatch):
    monkeypatch.setattr(N, "PAIRS_AT_ONCE", 700)
    rng = random.Random(3)
    left, right = [*texts(rng, 150), "川" * 80, "本"], [*texts(rng, 200), "川" * 79 + "町"]
    score, at = N.best_texts(left, right, np.full(len(left), 0.55), kind)
    of = ratio if kind == "ratio" else lambda a, b: round(1 - distance(a, b) / max(len(a), len(b)), 4)
    for k, a in enumerate(left):
        s, j = max((of(a, b), -j) for j, b in enumerate(right))
        assert (at[k], round(score[k], 6)) == (-j, round(s, 6)) if s >= 0.55 else at[k] == len(right)


@pytest.mark.parametrize("few", [2000, 0])
def test_best_by_two_against_all_pairs(few, monkeypatch):
    monkeypatch.setattr(N, "FEW", few)
    rng = random.Random(6)
    rows = lambda n: [(x, rng.choice(["治療甲乙", "治療甲丙", "注射", ""])) for x in texts(rng, n)]
    left, right = rows(120), rows(150)
    score, at, by_name, by_what = N.best_by_two(*zip(*left, strict=True), *zip(*right, strict=True), 0.62, 0.5)
    want = {}
    for k, (n, w) in enumerate(left):
        for j, (n2, w2) in enumerate(right):
            s = min(1.0, 0.44 * ratio(n, n2) + 0.56 * ratio(w, w2) + ((0.12 if n == n2 else 0.05 if n in n2 or n2 in n else 0) + (0.1 if w == w2 else 0)))
            if ratio(n, n2) >= 0.5 and round(s, 6) >= 0.62 and (k not in want or round(s, 6) > want[k][0]):
                want[k] = (round(s, 6), j, ratio(n, n2), ratio(w, w2))
    found = np.flatnonzero(at < len(right))
    assert {int(k): (round(float(score[k]), 6), int(at[k]), x, y) for k, x, y in zip(found, by_name, by_what, strict=True)} == want and len(want) > 60


@pytest.mark.parametrize("kind", ["edit", "ratio"])
def test_few_pairs_of_a_block_are_compared(kind, monkeypatch):
    seen = []
    aligned = N.aligned
    monkeypatch.setattr(N, "aligned", lambda a, b, i, j, how: seen.append(len(i)) or aligned(a, b, i, j, how))
    rng = random.Random(8)
    names = ["".join(rng.choice("青山緑川東西本町桜鈴池石光杏島岬") for _ in range(6)) + "整形外科クリニック" for _ in range(1600)]
    left, right = names[:800], [n[:2] + n[3:] for n in names[:400]] + names[800:]
    N.best_texts(left, right, np.full(800, 0.62), kind)
    assert sum(seen) < 0.05 * 800 * 1200


def test_few_pairs_are_matched_by_difflib(monkeypatch):
    seen = []
    of = N.Ratio.of
    monkeypatch.setattr(N.Ratio, "of", lambda self, i, j: seen.append(len(i)) or of(self, i, j))
    rng = random.Random(9)
    left, right = ([*("".join(rng.choice("青山緑川東西本町桜鈴池石光杏島岬") for _ in range(6)) + "整形外科クリニック" for _ in range(500))] for _ in range(2))
    score, _ = N.best_texts(left, right, np.full(500, 0.62), "ratio")
    assert sum(seen) < 0.03 * 500 * 500 and [round(max(ratio(a, b) for b in right), 6) for a in left[:40]] == [round(x, 6) for x in score[:40]]


def test_halves_round_as_in_spark():
    x = np.array([1 - 1 / 32, 1 - 1 / 160, 0.12345, 2 / 3])
    assert N.rounded(x, 4).tolist() == [0.9688, 0.9938, 0.1235, 0.6667]


def test_every_cell_of_a_block(spark, monkeypatch):
    """A block of several cells gives each pair to one of them."""
    import pandas as pd

    monkeypatch.setattr(N, "CELL", 7)
    l, r = (spark.createDataFrame([("p", f"{c}{k}") for k in range(40)] + [("q" + c, "x")], f"slot string, {c} string") for c in "lr")
    pairs = lambda a, b: a[["l"]].merge(b[["r"]], "cross") if len(a) and len(b) else pd.DataFrame({"l": [], "r": []})
    got = [tuple(x) for x in N.in_cells(l, r, "slot", pairs, "l string, r string").collect()]
    assert sorted(got) == sorted((f"l{a}", f"r{b}") for a in range(40) for b in range(40))


def test_only_the_sizes_of_places_are_broadcast(spark, monkeypatch):
    """The planner would broadcast keys and matches here; at size the driver could not hold them."""
    import re

    from reconlake import session
    from reconlake.operators import linkage

    seen = []
    monkeypatch.setattr(linkage, "cut", lambda df: (seen.append(df), session.cut(df))[1])
    left = spark.createDataFrame([(1, "青山整形外科", "p"), (2, "西川医院", "p"), (3, "東町整形外科", None)], "l long, lk string, place string")
    right = spark.createDataFrame([(1, "青山整形外科", "p"), (2, "西川医員", "p"), (3, "東町整型外科", "q"), (4, "西川医院院", None)], "r long, rk string, place string")
    seen.append(linkage.best_in_place(left, right, "l", "r", "ratio", 0.62))
    assert sorted((x.l, x.r) for x in seen[-1].collect()) == [(1, 1), (2, 4), (3, 3)]
    plans = [df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0] for df in seen]
    assert sum(p.count("SortMergeJoin") for p in plans) >= 4
    assert all(re.fullmatch(r"\[slot#\d+\], \[slot#\d+\], Inner, BuildRight.*", k) for p in plans for k in re.findall(r"BroadcastHashJoin (.*)", p))
