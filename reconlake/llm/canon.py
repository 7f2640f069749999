"""Visually identical text in different characters: one consistent form (problem 1).

Method: a longest-match transducer. Its table is generated once from the character tables by rule (widths, split
accents and voicing marks, odd blanks, invisible signs, compatibility ideographs and radicals, look-alike letters with
and without accents) and checked for conflicts: one output per input, and every output is its own form. A text is read
once, grapheme cluster by grapheme cluster: at each place the longest entry of the table is taken, a letter takes the
marks that follow it even across invisible signs, and look-alikes wait, as a state, for the end of their word, whose
script decides between their readings.

Words: a Cyrillic or Greek look-alike becomes Latin unless its word has letters of its own script that look like none;
a single Greek letter standing alone, and a capital beta that ends a Latin word, name a version and stay. A kanji or
hiragana look-alike becomes katakana between katakana and after katakana; one that begins the word stays, and so do the
particle へ at its end, and before kanji a sign that often begins a kanji word (a number, 口) after one katakana only.

Null gives null, an empty text stays empty. Very long texts are read in one linear pass.
"""

from __future__ import annotations

import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reconlake.functions.confusables import CYRILLIC, GREEK, INVISIBLE, KANA, RADICALS

# --- fixed values ---
BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
BEGINS_KANJI_WORDS = "一二三千口"  # katakana look-alikes that often begin a word in kanji
VOICING = {"\u3099": "\u3099", "\u309a": "\u309a", "\uff9e": "\u3099", "\uff9f": "\u309a", "\u309b": "\u3099", "\u309c": "\u309a"}
#: blocks whose signs have one form in common use: widths, radicals, compatibility ideographs, ligatures, styled letters
BLOCKS = ((0x2E80, 0x2FDF), (0xF900, 0xFAFF), (0xFB00, 0xFB06), (0xFF01, 0xFF5E), (0xFF61, 0xFF9D), (0xFFE0, 0xFFE6), (0x1D400, 0x1D7FF), (0x2F800, 0x2FA1F))
SELECTORS = ((0xFE00, 0xFE0F), (0xE0100, 0xE01EF))

_LATIN_LOOKALIKES = {**CYRILLIC, **GREEK}


def _is_mark(ch: str) -> bool:
    return unicodedata.combining(ch) != 0


def _alphabet(ch: str) -> str:
    """l Latin, c Cyrillic, g Greek letter; k katakana, h hiragana, j kanji; empty for anything else."""
    o = ord(ch)
    if not ch.isalpha() and o not in (0x30FC, 0x3005):
        return ""
    if o < 0x250 or 0x1E00 <= o <= 0x1EFF:
        return "l"
    if 0x370 <= o <= 0x3FF or 0x1F00 <= o <= 0x1FFF:
        return "g"
    if 0x400 <= o <= 0x52F:
        return "c"
    if 0x30A1 <= o <= 0x30FA or o in (0x30FC, 0x30FD, 0x30FE):
        return "k"
    if 0x3041 <= o <= 0x309F:
        return "h"
    return "j" if 0x4E00 <= o <= 0x9FFF or o == 0x3005 or 0x3400 <= o <= 0x4DBF or 0x20000 <= o <= 0x3FFFF else ""


class Transducer:
    """The compiled table: `plain` maps a letter with its marks (one to three signs), `latin` and `kana` the other
    reading of look-alikes, which the script of their word selects."""

    def __init__(self) -> None:
        self.plain: dict[str, str] = {}
        self.latin: dict[str, str] = {}
        self.kana: dict[str, str] = {}
        self._fill()
        self._check()
        self.longest = max(map(len, self.plain))
        self.first = frozenset(k[0] for k in self.plain)

    def _add(self, table: dict[str, str], key: str, out: str) -> None:
        if table.setdefault(key, out) != out:
            raise ValueError(f"conflicting mapping of {key!r}: {table[key]!r} and {out!r}")

    def _fill(self) -> None:
        for ch in INVISIBLE:
            self._add(self.plain, ch, "")
        for lo, hi in SELECTORS:
            for o in range(lo, hi + 1):
                self._add(self.plain, chr(o), "")
        for ch in BLANKS:
            self._add(self.plain, ch, " ")
        for ch, form in RADICALS.items():
            self._add(self.plain, ch, form)
        for lo, hi in BLOCKS:
            for o in range(lo, hi + 1):
                ch = chr(o)
                form = unicodedata.normalize("NFC", "".join(RADICALS.get(x, x) for x in unicodedata.normalize("NFKC", ch)))
                if form != ch and ch not in RADICALS:
                    self._add(self.plain, ch, form)
        self._add(self.plain, "\uff9e", "\u309b")
        self._add(self.plain, "\uff9f", "\u309c")
        # letters with their marks: every letter that is canonically composed of shorter ones
        for o in range(sys.maxunicode + 1):
            ch = chr(o)
            parts = unicodedata.decomposition(ch)
            if not parts or parts.startswith("<") or 0xAC00 <= o <= 0xD7A3:
                continue
            base = "".join(chr(int(x, 16)) for x in parts.split())
            if len(base) == 2 and unicodedata.normalize("NFC", base) == ch:
                self._add(self.plain, base, ch)
                for mark, joined in VOICING.items():
                    if base[1] == joined != mark:
                        self._add(self.plain, base[0] + mark, ch)
            elif len(base) == 1 and ch not in self.plain:
                self._add(self.plain, ch, RADICALS.get(base, unicodedata.normalize("NFC", base)))
        # half-width kana carry their voicing mark as a letter of its own
        for o in range(0xFF66, 0xFF9E):
            full = unicodedata.normalize("NFKC", chr(o))
            for mark, joined in VOICING.items():
                if len(both := unicodedata.normalize("NFC", full + joined)) == 1:
                    self._add(self.plain, chr(o) + mark, both)
        # a mark tells that a kanji or hiragana look-alike is katakana
        for ch, form in KANA.items():
            for mark, joined in VOICING.items():
                if len(both := unicodedata.normalize("NFC", form + joined)) == 1 and ch + mark not in self.plain:
                    self._add(self.plain, ch + mark, both)
            self._add(self.kana, ch, form)
        # look-alikes of Latin letters, bare and with the marks that a Latin letter can carry
        marks = sorted({k[1] for k, v in self.plain.items() if len(k) == 2 and _is_mark(k[1]) and _alphabet(v) == "l"})
        for ch, form in _LATIN_LOOKALIKES.items():
            self._add(self.latin, ch, form)
            for mark in marks:
                if len(both := unicodedata.normalize("NFC", form + mark)) == 1:
                    self._add(self.latin, unicodedata.normalize("NFC", ch + mark), both)

    def _check(self) -> None:
        """Every output is its own form, and no sign has both a plain and another reading."""
        for table in (self.plain, self.latin, self.kana):
            for key, out in table.items():
                for i in range(len(out)):
                    if out[i] in self.plain or table is not self.plain and (out[i] in self.latin or out[i] in self.kana):
                        raise ValueError(f"mapping of {key!r} is not stable")
        if both := set(self.latin) & set(self.kana) | set(self.plain) & (set(self.latin) | set(self.kana)):
            raise ValueError(f"more than one reading of {sorted(both)!r}")

    def clusters(self, text: str) -> list[str]:
        """The letters of a text with their marks, each in its plain form; blanks single, none at the ends."""
        out: list[str] = []
        i, n = 0, len(text)
        while i < n:
            ch = text[i]
            if out and (ch in VOICING or _is_mark(ch)):  # a mark joins the letter before, also across invisible signs
                mark = VOICING.get(ch, ch)
                both = self.plain.get(out[-1] + mark)
                if both is None and len(one := unicodedata.normalize("NFC", out[-1] + mark)) == 1:
                    both = one
                if both is not None:
                    out[-1] = both
                    i += 1
                    continue
                if _is_mark(ch) and out[-1] != " ":
                    out[-1] = unicodedata.normalize("NFC", out[-1] + mark)
                    i += 1
                    continue
            size, form = 1, ch
            if ch in self.first:
                for size in range(min(self.longest, n - i), 0, -1):
                    if (form := self.plain.get(text[i : i + size])) is not None:
                        break
                else:
                    size, form = 1, ch
            i += size
            for c in form:
                if c != " " or out and out[-1] != " ":
                    out.append(c)
        while out and out[-1] == " ":
            out.pop()
        return out

    def __call__(self, text: str) -> str:
        out = self.clusters(text)
        i, n = 0, len(out)
        while i < n:
            kind = _alphabet(out[i][0])
            if kind in ("l", "c", "g"):
                j = i + 1
                while j < n and _alphabet(out[j][0]) in ("l", "c", "g"):
                    j += 1
                self._alphabetic(out, i, j)
            elif kind == "k" or out[i] in self.kana:
                j = i + 1
                while j < n and (_alphabet(out[j][0]) == "k" or out[j] in self.kana):
                    j += 1
                self._katakana(out, i, j)
            else:
                j = i + 1
            i = j
        return "".join(out)

    def _alphabetic(self, out: list[str], i: int, j: int) -> None:
        """Look-alikes of one word in letters take their Latin reading, unless the word is in another script."""
        alike = [k for k in range(i, j) if out[k] in self.latin]
        if not alike:
            return
        kinds = [_alphabet(out[k][0]) for k in range(i, j)]
        latin = kinds.count("l")
        own = [kinds[k - i] for k in range(i, j) if kinds[k - i] != "l" and out[k] not in self.latin]
        if "c" in own or own and not latin:
            return
        touches = i and out[i - 1] == "/" or j < len(out) and out[j] == "/"
        if j - i == 1 and kinds[0] == "g" and not touches:
            return
        for k in alike:
            if not (out[k] == "Β" and k == j - 1 and latin >= 4):
                out[k] = self.latin[out[k]]

    def _katakana(self, out: list[str], i: int, j: int) -> None:
        """Look-alikes of one word take their katakana reading after the first real katakana."""
        start = next((k for k in range(i, j) if out[k] not in self.kana), None)
        if start is None:
            return
        last = max(k for k in range(i, j) if out[k] not in self.kana)
        kanji_after = j < len(out) and _alphabet(out[j][0]) == "j"
        for k in range(start + 1, j):
            if out[k] not in self.kana:
                continue
            if k > last:  # nothing but look-alikes up to the end of the word
                if out[k] == "へ" and k == j - 1:
                    return
                if kanji_after and out[k] in BEGINS_KANJI_WORDS and k - i < 2:
                    return
            out[k] = self.kana[out[k]]


_T = Transducer()


def canonical(text: str) -> str:
    """The text in the consistent form: normal width and script, joined marks, single blanks, nothing invisible."""
    return _T(text)


@F.pandas_udf(StringType())
def canonical_udf(s: pd.Series) -> pd.Series:
    """canonical() by distinct value of a batch; null stays null."""
    known = {v: canonical(v) for v in s.dropna().unique()}
    return s.map(known)


def _ranges(codes: set[int]) -> str:
    """A character class of the code points, as ranges."""
    out, run = [], []
    for c in [*sorted(codes), -1]:
        if run and c != run[-1] + 1:
            out.append(f"\\x{{{run[0]:X}}}" + (f"-\\x{{{run[-1]:X}}}" if len(run) > 1 else ""))
            run = []
        run.append(c)
    return "[" + "".join(out) + "]"


def _dangerous() -> set[int]:
    """Code points with which a text may change, whatever stands beside them."""
    marks = {o for o in range(0x300, 0x10FFFF) if _is_mark(chr(o))} | {ord(c) for c in VOICING}
    return marks | {ord(k) for k in _T.plain if len(k) == 1} | {ord(k) for k in _T.latin if len(k) == 1}


#: blocks most texts are made of; what of them is not dangerous is one short class that is looked at first
COMMON_BLOCKS = ((0x09, 0x0A), (0x20, 0x7E), (0x3001, 0x3005), (0x3041, 0x3096), (0x30A1, 0x30FE), (0x4E00, 0x9FFF))
_COMMON_ONLY = f"^{_ranges({o for lo, hi in COMMON_BLOCKS for o in range(lo, hi + 1)} - _dangerous())}*$"
_ODD_SIGN = _ranges(_dangerous())
_ODD_PLACE = f"[ァ-ヺーヽヾ][{''.join(_T.kana)}]|^ |  | $"


def suspicious(col: Column) -> Column:
    """False where a text is certainly in the consistent form (decided in the JVM); true where the transducer must look.

    The patterns are generated from the table: they hold for every text that the transducer would change.
    """
    return col.isNotNull() & (col != "") & (col.rlike(_ODD_PLACE) | (~col.rlike(_COMMON_ONLY) & col.rlike(_ODD_SIGN)))


def deviations(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, clean) of the rows whose value is not in the consistent form."""
    odd = df.select(F.col(key), F.col(column).alias("_v")).where(suspicious(F.col("_v")))
    return odd.withColumn("clean", canonical_udf("_v")).where(F.col("clean") != F.col("_v")).select(key, "clean")
