"""Fixed character tables: letters that look like other letters.

Used to build tolerant patterns (this package) and the text normaliser of the llm subpackage.
"""

from __future__ import annotations

import unicodedata

# --- fixed values: look-alike letters of other scripts and their Latin counterpart ---
CYRILLIC = dict(zip(
    "АВЕЅІЈКМНОРСТУХаеіјорсухѕԁһԛԝ",
    "ABESIJKMHOPCTYXaeijopcyxsdhqw",
))
GREEK = dict(zip(
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναικρυχ",
    "ABEZHIKMNOPTYXovaikpux",
))
# Kanji and hiragana that look like katakana
KANA = dict(zip("二口工力夕卜八一千才三へべぺり", "ニロエカタトハーチオミヘベペリ"))
# Code points that are never visible: soft hyphen, zero-width and direction marks, variation selectors
INVISIBLE = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180e"
    "\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e"
    "\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
)
VARIATION = "\ufe00-\ufe0f\U000e0100-\U000e01ef"
# Radicals whose compatibility form is missing or is not the form used in Japanese
RADICALS = dict(zip("⺟⻁⻄⻑⻘⻝⻤⻨⻩⻫⻭⻯⻲戶", "母虎西長青食鬼麦黄斉歯竜亀戸"))

LATIN_LOOKALIKES = {**CYRILLIC, **GREEK}


def letter_class(ch: str) -> str:
    """A regular-expression class of everything that looks like ch, in either case and width."""
    out = {ch, ch.lower(), ch.upper()}
    for k, v in LATIN_LOOKALIKES.items():
        if v.lower() == ch.lower():
            out |= {k, k.lower(), k.upper()}
    for c in list(out):
        if len(c) == 1 and "!" <= c <= "~":
            out.add(chr(ord(c) + 0xFEE0))
    for k, v in KANA.items():
        if v == ch:
            out.add(k)
    return "[" + "".join(sorted(c if c.isalnum() else "\\" + c for c in out if len(c) == 1)) + "]"


def narrow(text: str) -> str:
    """Full-width ASCII, digits and circled forms to their ordinary form (compatibility normalisation)."""
    return unicodedata.normalize("NFKC", text)
