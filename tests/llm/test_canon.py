"""One consistent form: widths, marks, blanks, invisible characters, look-alikes."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reconlake.llm import canon
from reconlake.llm.canon import canonical

CASES = [
    ("クりニック", "クリニック"), ("クリ二ック", "クリニック"), ("スポ一ツ整形", "スポーツ整形"), ("リ八病院", "リハ病院"), ("町リ八ビりテ一シ", "町リハビリテーシ"),
    ("東口クリニック", "東口クリニック"), ("第一クリニック", "第一クリニック"), ("通りクリニック", "通りクリニック"), ("ｽﾎ‍ﾟｰﾂ", "スポーツ"),
    ("ORTHAVIA Β", "ORTHAVIA Β"), ("Ｃｏｒｖａｎｅｘ Ａ/Ｂ", "Corvanex A/B"), ("Corvanex A/В", "Corvanex A/B"), ("キッ卜", "キット"), ("Étoile", "Étoile"),
    ("СL", "CL"), ("森\U000e0101橋", "森橋"), ("キネドラ", "キネドラ"), ("a　 b", "a b"), ("Оrth⁠аvia β", "Orthavia β"), ("療", "療"), ("⾧", "長"), ("", ""),
    ("Москва", "Москва"), ("Rêve", "Rêve"), ("セ八゙リウム", "セバリウム"),
]


@pytest.mark.parametrize("typed,want", CASES)
def test_cases(typed, want):
    assert canonical(typed) == want


@pytest.mark.parametrize("typed,want", [
    ("Βelmatrix", "Belmatrix"), ("Mont Βleu", "Mont Bleu"), ("FIΒROLANTA", "FIBROLANTA"), ("Kо́s", "Kós"), ("ＡＢＣ（株）", "ABC(株)"), ("Ａ＋Ｂ／Ｃ！", "A+B/C!"), ("Lumiёre", "Lumiëre"), ("｢ｱ｣", "「ア」"),
    ("x\nスポ一ツ", "x\nスポーツ"), ("クリニックへ", "クリニックへ"), ("センタ一病院", "センター病院"), ("ハ゛ス", "バス"), ("か\u200b\u3099", "が"),
])
def test_more_cases(typed, want):
    assert canonical(typed) == want


def test_table_is_stable():
    """Every output of the whole table, alone and in words of each script, is its own form."""
    t = canon._T
    for table in (t.plain, t.latin, t.kana):
        for key, out in table.items():
            for around in ("{}", "Abc{}d", "スポ{}ツ", "漢{}字", "{}"):
                once = canonical(around.format(key))
                assert canonical(once) == once, (key, around)
            if table is not t.plain:
                assert canonical(out) == out, key


def test_gate_passes_nothing_that_changes(spark):
    """Over every code point beside Latin letters, katakana, kanji and blanks."""
    import sys
    import unicodedata

    from pyspark.sql import functions as F

    odd = []
    for o in range(sys.maxunicode + 1):
        ch = chr(o)
        if unicodedata.category(ch) in ("Cn", "Cs", "Co"):
            continue
        odd += [t for t in (ch, f"Abcd{ch}e", f"ス{ch}ツ", f"漢{ch}", f"a {ch} b", f"x\n{ch}") if canonical(t) != t]
    assert len(odd) > 5000
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    assert df.where(~canon.suspicious(F.col("v"))).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aéАВЕオクリニックー二口八りﾊﾞｶ゙゚ ​　︀漢字AΒβ①"), max_size=20))
def test_idempotent(text):
    once = canonical(text)
    assert canonical(once) == once


def test_fast_check_misses_nothing(spark):
    from pyspark.sql import functions as F

    values = [a for a, _ in CASES] + [b for _, b in CASES] + ["plain text", "a  b", " a", "a ", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k long, v string")
    looked = {r.k for r in df.where(canon.suspicious(F.col("v"))).collect()}
    for i, v in enumerate(values):
        if v and canonical(v) != v:
            assert i in looked, v


def test_deviations(spark):
    df = spark.createDataFrame([(1, "СL", "x"), (2, "CL", "x"), (3, None, None), (4, "", ""), (5, "あ" * 50000 + "​", "")], "k long, v string, clean string")
    got = {r.k: r.clean for r in canon.deviations(df, "k", "v").collect()}
    assert got == {1: "CL", 5: "あ" * 50000}
    assert canon.deviations(df.limit(0), "k", "v").count() == 0
