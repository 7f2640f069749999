"""SQL fragments that mean the same as the text functions, for the SQL of queries."""

from __future__ import annotations

import unicodedata

from reconlake.functions import text as T

_BLOCKS = ((0x00A0, 0x00A0), (0x2000, 0x200A), (0x202F, 0x202F), (0x205F, 0x205F), (0x2E80, 0x2FDF), (0x3000, 0x3000), (0xF900, 0xFAFF), (0xFF01, 0xFF5E), (0xFF61, 0xFF9F), (0xFFE0, 0xFFE6))


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def nfkc(c: str) -> str:
    """Compatibility form as far as single letters go, then canonical composition."""
    pairs = [(chr(o), unicodedata.normalize("NFKC", chr(o))) for lo, hi in _BLOCKS for o in range(lo, hi + 1)]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return f"nfc_normalize(translate({c}, {quoted(''.join(a for a, _ in pairs))}, {quoted(''.join(b for _, b in pairs))}))"


def compact(c: str, signs: str = T.PUNCTUATION) -> str:
    """Of a column already in compatibility form."""
    return f"lower(regexp_replace({c}, '{signs}', '', 'g'))"


def strip_legal(c: str) -> str:
    for f in T.LEGAL_FORMS:
        c = f"replace({c}, '{f}', '')"
    return c


def prefecture(c: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({c}, '{p}') THEN '{p}'" for p in T.PREFECTURES) + " END"


def digits_key(c: str) -> str:
    """Of a column already in compatibility form."""
    return f"regexp_replace(regexp_replace(lower({c}), '丁目|番地|番|号', '', 'g'), '[^0-9a-z一-龥ぁ-んァ-ヶ]', '', 'g')"


def address_key(c: str, pref: str | None = None) -> str:
    a = f"regexp_replace({c}, '〒?[0-9]{{3}}-?[0-9]{{4}}', '', 'g')"
    if pref:
        a = f"CASE WHEN {pref} <> '' THEN replace({a}, {pref}, '') ELSE {a} END"
    return f"regexp_replace(lower(regexp_replace({a}, '{T.LIST_SIGNS}', '', 'g')), '丁目|番地|番|号', '', 'g')"


def words(names: tuple[str, ...] | list[str]) -> str:
    return "[" + ", ".join(quoted(n) for n in names) + "]"
