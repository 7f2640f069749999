"""Keys of names and addresses, linking, label model."""

import numpy as np
import pytest

from reconlake.llm import labelmodel, names
from reconlake.llm.namekeys import address_parts, name_parts, sound


@pytest.mark.parametrize("a,b", [
    ("上神楽渕クリニック", "Kamikagurabuchi Clinic"), ("小光枝中央病院", "Kohikarieda Chuo Hospital"), ("小鈴谷南整形外科", "こすずたにみなみ整形外科"), ("小丹波根場さんの通り整外", "小丹波根場通り整形外科"),
    ("新亀園広場 記念病院", "Shinkamezono Hiroba Kinen Hospital"), ("小泉窪公圓総合病院", "こいずみくぼこうえん総合病院"),
])
def test_spellings_sound_alike(a, b):
    assert name_parts(a)[2] == name_parts(b)[2]


@pytest.mark.parametrize("text,want", [
    ("〒301-7740 熊本県滝門市 八雲６－３４－８", ("熊本県", "滝門市", "八雲", "6-34-8")), ("宮城県八雲坂市葵が丘七丁目二番地二十七", ("宮城県", "八雲坂市", "葵が丘", "7-2-27")),
    ("一色窪市 泉本町5丁目22番", ("", "一色窪市", "泉本町", "5-22")), ("佐賀県", ("佐賀県", "", "", "")), (None, ("", "", "", "")), ("汐見市港本町2丁目14番6号 ことりビル3F", ("", "汐見市", "港本町", "2-14-6")),
])
def test_addresses(text, want):
    assert address_parts(text) == want


def test_sound_of_nothing():
    assert sound("") == "" and name_parts(None)[2] == ""


def rows(spark, data):
    df = spark.createDataFrame(data, "id string, n string, a string, p string")
    return names.records(df, "id", "n", "a", "p")


DATA = [
    ("A", "医療法人緑会 上神楽渕クリニック", "熊本県滝門市八雲6丁目34番8号", "熊本県"), ("B", "Kamikagurabuchi Clinic", "滝門市八雲6-34-8 ことりビル", None), ("C", "上神楽渕CL", "熊本県", None),
    ("D", "上神楽渕クリニック", "佐賀県鳩山市桃1-2-3", "佐賀県"), ("E", "小鈴谷南整形外科", "滝門市八雲1-1-1", None), ("F", "上神楽渕クリニック", "滝門市八雲六丁目三十四番地八", None), ("G", None, None, None), ("H", "", "", ""),
    ("I", "上神楽渕クリニック", "滝門市八雲六丁目三十四番地八", None),
]


def test_pairs_of_one_facility(spark):
    got = {(r.rec_a, r.rec_b) for r in names.same_facility(rows(spark, DATA)).collect()}
    group = "ABCFI"
    assert got == {(x, y) for x in group for y in group if x < y}


INVENTED = {"鴉": "からす", "鵺": "ぬえ", "楡": "にれ", "樫": "かし", "鯨": "くじら", "蔦": "つた", "蕗": "ふき", "葛": "くず", "槙": "まき", "雉": "きじ", "轍": "わだち", "礎": "いしずえ"}


def spelled(stem, how):
    romaji = {"か": "ka", "ら": "ra", "す": "su", "ぬ": "nu", "え": "e", "に": "ni", "れ": "re", "し": "shi", "く": "ku", "じ": "ji", "つ": "tsu", "た": "ta", "ふ": "fu", "き": "ki", "ず": "zu", "ま": "ma", "わ": "wa", "だ": "da", "ち": "chi", "い": "i"}
    kana = "".join(INVENTED[c] for c in stem)
    return stem if how == 0 else kana if how == 1 else "".join(romaji[c] for c in kana).capitalize()


def test_names_of_unknown_kanji_are_linked(spark):
    """Stems of kanji without a common reading: their sound is learned from full addresses and links the records without one."""
    from reconlake.llm import namekeys, readings

    assert not set(INVENTED) & set(namekeys.READINGS)
    rng = np.random.default_rng(9)
    stems = sorted({a + b for a in INVENTED for b in INVENTED if a != b})
    data, want = [], set()
    for k, stem in enumerate(stems):
        city = f"第{k}市" if k % 2 else f"緑{k}市"
        data += [(f"A{k:03}", f"{stem}クリニック", f"熊本県{city}八雲6丁目34番8号"), (f"B{k:03}", f"{spelled(stem, 1 + k % 2)} Clinic", f"熊本県{city}八雲6-34-8")]
        data.append((f"C{k:03}", f"{spelled(stem, 1 + int(rng.integers(0, 2)))} クリニック", f"熊本県{city}"))
        want |= {(f"A{k:03}", f"B{k:03}"), (f"A{k:03}", f"C{k:03}"), (f"B{k:03}", f"C{k:03}")}
    recs = names.records(spark.createDataFrame(data, "id string, n string, a string"), "id", "n", "a")
    got = {(r.rec_a, r.rec_b) for r in names.same_facility(recs).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.95 * len(got)
    # most of it is learned, and a name learned is the name heard
    forms = spark.createDataFrame([(s, "", f"市{k}", "八雲", "6-34-8") for k, stem in enumerate(stems) for s in (stem, spelled(stem, 1))], "stem string, area string, city string, quarter string, nums string")
    known = readings.learned(forms)
    assert all(namekeys.flat(known[c]) == namekeys.flat(namekeys.rough(INVENTED[c])) for c in INVENTED)


def test_brands_are_foreign_words_of_several_municipalities(spark):
    data = [(f"R{k}", f"Xylq {'鴉鵺楡樫'[k]}クリニック" if k < 3 else "Zorv 樫クリニック", f"熊本県緑{k}市桃1-2-3", None) for k in range(4)]
    got = {r.rec: r.brand for r in names.keyed(rows(spark, data)).collect()}
    assert got == {"R0": "xylq", "R1": "xylq", "R2": "xylq", "R3": ""}


def test_no_link_of_a_municipality_is_lost(spark, data):
    """Every pair of forms that the address relation and the score accept is among the candidates, against all pairs."""
    from pyspark.sql import functions as F

    sf = data.replace("0.001", "0.01")
    f = names.records(spark.read.parquet(f"{sf}/nonqueue_facility.parquet"), "facility_id", "facility", "address", "prefecture")
    l = names.records(spark.read.parquet(f"{sf}/locator.parquet"), "locator_id", "name", "address")
    forms = names.forms_of(names.keyed(f.unionByName(l))).cache()
    side = lambda s: forms.select(F.col("form").alias(s), F.col("snd").alias(f"{s}_snd"), *[F.col(p).alias(f"{s}_{p}") for p in names.PLACES])
    every = side("a").join(side("b"), (F.col("a_city") == F.col("b_city")) & (F.col("a_city") != "") & (F.col("a") < F.col("b"))).withColumn("relation", names.relation("a", "b")).where("relation != 'apart'")
    share = F.size(F.array_intersect(names.grams(F.col("a_snd"), 3), names.grams(F.col("b_snd"), 3))) / F.greatest(F.size(names.grams(F.col("a_snd"), 3)), F.size(names.grams(F.col("b_snd"), 3)))
    every = every.where((F.col("relation") == "full") | (share >= names.NEAR)).select("a", "b", "relation")
    kept = names.passes(F.col("relation"), F.col("score")) | ((F.col("relation") == "city") & (F.col("score") >= names.LEAST["city"]))
    want = {(r.a, r.b) for r in names.scored(every, forms).where(kept).collect()}
    got = {(r.a, r.b) for r in names.candidates(forms).collect()}
    assert len(want) > 150 and want <= got


def far_sounds(seed, letters, sizes, n):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        s = "".join(rng.choice(list(letters), int(rng.integers(*sizes))))
        for _ in range(int(rng.integers(0, 4))):  # and one some letters off
            k = int(rng.integers(0, len(s)))
            s = [s[:k] + s[k + 1 :] or "a", s[:k] + "b" + s[k:], s[:k] + "a" + s[k + 1 :]][int(rng.integers(0, 3))]
            out.append(s)
        out.append(s)
    return out


def most_edits(n):
    return 0 if n < 6 else 1 if n < 10 else 2 if n < 18 else 4


@pytest.mark.parametrize("letters", ["ab", "aiuekst"])
def test_sounds_some_edits_apart_share_a_key(letters):
    sounds = sorted(set(far_sounds(5, letters, (1, 24), 60)))
    for a in sounds:
        of = set(names.probes(a))
        for b in sounds:
            most = most_edits(min(len(a), len(b)))
            if abs(len(a) - len(b)) <= 2 and plain_distance(a, b) <= most:
                assert of & set(names.pieces(b)) and (names.bits(a) ^ names.bits(b)).bit_count() <= 4 * most


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_names_without_a_municipality_meet_all_that_are_some_edits_apart(spark):
    """Against all pairs; sounds of few letters, whose grams repeat, included."""
    rng = np.random.default_rng(6)
    sounds = far_sounds(7, "ab", (5, 22), 40) + far_sounds(8, "aiuekst", (5, 22), 40)
    forms = [(k, s, str(rng.choice(["p", "q", ""])), str(rng.choice(["", "x"])), str(rng.choice(["", "y"])), str(rng.choice(["", "1-2-3"]))) for k, s in enumerate(sounds)]
    df = spark.createDataFrame([(k, s, p, c, *((q, n) if c else ("", ""))) for k, s, p, c, q, n in forms], "form long, snd string, pref string, city string, quarter string, nums string")
    want = {(a[0], b[0]) for a in forms for b in forms if a[0] < b[0] and not (a[3] and b[3]) and ("" in (a[2], b[2]) or a[2] == b[2])
            and abs(len(a[1]) - len(b[1])) <= 2 and plain_distance(a[1], b[1]) <= most_edits(min(len(a[1]), len(b[1])))}
    assert {(r.a, r.b) for r in names.candidates(df).where("relation = 'open'").collect()} == want and len(want) > 100
    # two tables: the left's and the right's names without a municipality
    left, right = df.where("form % 2 = 0"), df.where("form % 2 = 1")
    got = {tuple(sorted((r.a, r.b))) for r in names.candidates(left, right).where("relation = 'open'").collect()}
    assert got == {(a, b) for a, b in want if (a + b) % 2}


def test_few_names_without_a_municipality_are_compared(spark, monkeypatch):
    """Names that begin and end alike, as most do, are not all compared, and equal ones only once."""
    seen = []
    joined = names.joined
    monkeypatch.setattr(names, "joined", lambda *a: (seen.append(joined(*a)), seen[-1])[1])
    rng = np.random.default_rng(3)
    sounds = ["simo" + "".join(rng.choice(list("aiueokstnmr"), 8)) + "hikasikuti" for _ in range(150)] * 2
    df = spark.createDataFrame([(k, s, "p", "x" if k % 3 else "", "y", "1-2-3" if k % 3 else "") for k, s in enumerate(sounds)], "form long, snd string, pref string, city string, quarter string, nums string")
    assert names.candidates(df).where("relation = 'open'").count() >= 50
    compared = next(d for d in seen if "a_snd" in d.columns)
    assert compared.count() < 0.6 * 100 * 300


def test_groups_count_their_links(spark):
    got = {r.rec: (r.root, r.links) for r in names.linked(rows(spark, DATA)).collect()}
    assert {got[x][1] for x in "ABCFI"} == {4} and got["D"][1] == 0 and len({got[x][0] for x in "ABCFI"}) == 1


def test_no_records(spark):
    assert names.same_facility(rows(spark, DATA).limit(0)).count() == 0


def test_components_against_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2)) if a != b]
    root = list(range(60))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    nodes = spark.createDataFrame([(i,) for i in range(60)], "node long")
    got = {r.node: r.root for r in names.components(nodes, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in range(60)}


def test_label_model_learns_accuracies():
    rng = np.random.default_rng(4)
    n = 6000
    truth = rng.random(n) < 0.4
    votes = [np.where(rng.random(n) < acc, np.where(truth, "same", "differ"), np.where(truth, "differ", "same")) for acc in (0.95, 0.8, 0.7)]
    votes.append(votes[1].copy())  # fully correlated with the second
    pats, idx, count = np.unique(np.stack(votes, 1), axis=0, return_inverse=True, return_counts=True)
    model = labelmodel.LabelModel([tuple(p) for p in pats], count)
    post = model.fit()[np.ravel(idx)]
    assert ((post > 0.5) == truth).mean() > 0.93
    assert (1, 3) in model.names


def test_described(spark):
    m = spark.createDataFrame([(1, "Kamikagurabuchi Clinic", "滝門市八雲6-34-8"), (2, "小鈴谷南整形外科", "鳩山市桃1-2-3"), (3, None, None), (4, "上神楽渕CL", "滝門市八雲6-34")], "match_id long, source_facility_name string, source_address string")
    f = spark.createDataFrame([("F1", "上神楽渕クリニック", "滝門市八雲6丁目34番8号", "熊本県"), ("F2", "医)緑会 上神楽渕クリニツク", "滝門市八雲6-34-8", "熊本県"), ("F3", "大柿島北病院", "緑市桃5-5-5", "佐賀県")], "facility_id string, facility string, address string, prefecture string")
    got = {(r.match_id, r.facility_id) for r in labelmodel.described(m, f).collect()}
    assert got >= {(1, "F1"), (1, "F2")} and not {x for x in got if x[0] in (2, 3) or x[1] == "F3"}


def final_plans(monkeypatch, run):
    """The plans that ran for each step that was cut and, last, for the result."""
    from reconlake import session
    from reconlake.llm import readings

    seen = []
    for module in (names, readings, labelmodel):
        monkeypatch.setattr(module, "cut", lambda df: (seen.append(df), session.cut(df))[1])
    seen.append(run())
    seen[-1].collect()
    return [df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0] for df in seen]


def test_no_side_of_a_pair_join_is_broadcast(spark, monkeypatch):
    """The planner would broadcast them here; at size the driver could not hold them."""
    plans = final_plans(monkeypatch, lambda: names.same_facility(rows(spark, DATA)))
    assert sum(p.count("SortMergeJoin") for p in plans) > 10 and not any("BroadcastHashJoin" in p for p in plans)


def test_only_the_vote_patterns_are_broadcast(spark, data, monkeypatch):
    from reconlake.session import load

    plans = final_plans(monkeypatch, lambda: labelmodel.described(load(spark, data, "locator_match"), load(spark, data, "nonqueue_facility")))
    assert [k for k, p in enumerate(plans) if "BroadcastHashJoin" in p] == [len(plans) - 1] and plans[-1].count("BroadcastHashJoin") == 1


def test_candidates_of_all_relations_meet_in_two_joins(spark):
    """A plan with a join for each relation took the driver's memory, however small the input."""
    recs = names.keyed(rows(spark, DATA))
    left, right = (names.forms_of(recs.where(w)).cache() for w in ("rec < 'D'", "rec >= 'C'"))
    for pairs in (names.candidates(left), names.candidates(left, right, contrast=True)):
        pairs.collect()
        plan = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") <= 5


def test_matching_takes_few_and_small_plans(spark, data, monkeypatch):
    from reconlake.session import load

    plans = final_plans(monkeypatch, lambda: labelmodel.described(load(spark, data, "locator_match"), load(spark, data, "nonqueue_facility")))
    assert max(p.count("Exchange hashpartitioning") for p in plans) <= 20
