"""Free-entered values mapped to the canonical list of products (problem 5).

Method: a multi-pattern automaton over the canonical names and their aliases (registry aliases, version parts in
other spellings) finds the mentions embedded anywhere in a value; a mention begins and ends at a token border, and of
overlapping mentions the longest wins. What stands beside a mention decides whether it is the product meant: words in
a script in which no name of the list is written or other than that of the mention, words in brackets, numbers with a counter, and words that the values
themselves show beside many different products (context_words, counted over all values) are only context; any other
word beside it is a name part of its own and makes another product.
Values without a mention go to token-set similarity: each token to its best counterpart in any order (few edits, for
katakana also by sound), versions equal, a token split or joined counting as one. Candidates come from indexes
(positional bigrams, consonants), never from the whole list. Everything else is UNMATCHED.

Null and blank values give no row. Repeated values each keep their row. An empty registry maps all to UNMATCHED.
The registry is a reference list; more than MAX_PRODUCTS entries are refused rather than broadcast.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reconlake.llm.canon import canonical
from reconlake.session import bounded, cut, ship_package

UNMATCHED = "UNMATCHED"
MAX_PRODUCTS = 50_000
MAX_CONTEXT = 10_000  # context words sent to the tasks; more are refused
#: a word is context if it stands beside this share of the products that any word stands beside, three products at least
COMMON = 0.1

# --- fixed values: words for a package of any product, and spellings of version parts ---
PACKAGES = ("kit", "system", "キット", "システム")
VERSIONS = (
    ("ii", "2", "ⅱ", "ツー"), ("iii", "3", "ⅲ", "スリー"), ("iv", "4", "ⅳ"), ("i", "1", "ⅰ"), ("v", "5", "ⅴ"),
    ("β", "beta", "ベータ"), ("α", "alpha", "アルファ"), ("γ", "gamma", "ガンマ"),
    ("duo", "double", "デュオ", "ダブル"), ("mini", "ミニ"), ("pro", "プロ"), ("a/b", "ab"),
    ("plus", "プラス", "+"), ("max", "マックス"), ("neo", "ネオ"), ("lite", "ライト"), ("x",),
)
_VERSION = {form: group[0] for group in VERSIONS for form in group}
LONGEST_VERSION = max(map(len, _VERSION))
# katakana syllables and their rough Latin sound, consonants only (vowels are dropped before comparing)
_ROW = {"カ": "k", "ガ": "g", "サ": "s", "ザ": "s", "タ": "t", "ダ": "d", "ナ": "n", "ハ": "h", "バ": "b", "パ": "p", "マ": "m", "ヤ": "", "ラ": "r", "ワ": ""}
_SYLLABLES = {
    "カ": "カキクケコ", "ガ": "ガギグゲゴ", "サ": "サシスセソ", "ザ": "ザジズゼゾ", "タ": "タチツテト", "ダ": "ダヂヅデド",
    "ナ": "ナニヌネノ", "ハ": "ハヒフヘホ", "バ": "バビブベボ", "パ": "パピプペポ", "マ": "マミムメモ", "ヤ": "ヤユヨ", "ラ": "ラリルレロ", "ワ": "ワヲ",
}
_KANA_SOUND = {s: _ROW[r] for r, row in _SYLLABLES.items() for s in row} | {"ン": "n", "ヴ": "b", "フ": "f", "ジ": "g", "チ": "t"}
_TOKEN = re.compile(r"[a-z\u00df-\u024f\u0370-\u03ff\u0400-\u04ff]+(?:/[a-z]\b)?|[0-9]+|[ァ-ヺー]+|[ぁ-んゝゞ]+|[一-鿿々〆ヶ]+|[+]|[^\W_]", re.I)
_OPEN, _CLOSE = "(（[［【〔「『", ")）]］】〕」』"


def osa(a: str, b: str, most: int = 2) -> int:
    """Edit distance with neighbour swaps; most + 1 where it is larger than most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


def kana_sound(text: str) -> str:
    """Consonants of a katakana word."""
    return "".join(_KANA_SOUND.get(c, "") for c in text)


def kana_full(text: str) -> str:
    """A katakana word in Latin letters, small vowels replacing the vowel before them."""
    out = ""
    for c in text:
        if c in "ァィゥェォャュョ":
            out = out.rstrip("aiueo") + "aiueoauo"["ァィゥェォャュョ".index(c)]
        elif c in "アイウエオ":
            out += "aiueo"["アイウエオ".index(c)]
        elif c == "ヴ":
            out += "bu"
        elif c in _KANA_SOUND:
            row = next((r for r in _SYLLABLES.values() if c in r), "")
            vowel = "" if c == "ン" else ("aiueo" if len(row) == 5 else "auo" if len(row) == 3 else "ao")[row.index(c)]
            out += _KANA_SOUND[c] + vowel
    return out


def latin_sound(text: str) -> str:
    """Consonants of a Latin name as its katakana form renders them."""
    return re.sub(r"[aeiou]", "", latin_full(text))


def latin_full(text: str) -> str:
    """A Latin name as its katakana form renders it, vowels kept."""
    t = text.lower()
    for a, b in (("ch", "k"), ("th", "s"), ("ph", "f"), ("qu", "k"), ("x", "ks"), ("gu", "g")):
        t = t.replace(a, b)
    t = re.sub(r"c(?=[eiy])", "s", t)
    t = t.translate(str.maketrans({"c": "k", "q": "k", "v": "b", "l": "r", "z": "s", "j": "g", "y": "i"}))
    t = re.sub(r"([bdfghkmnprst])\1+", r"\1", t)
    return re.sub(r"[wβ\W\d]", "", t)


def _is_kana(text: str) -> bool:
    return bool(text) and all("ァ" <= c <= "ヺ" or c == "ー" for c in text)


def script(token: str) -> str:
    """l Latin and other alphabets, 0 digits, k katakana, h hiragana, c kanji."""
    ch = token[0]
    if ch.isdigit():
        return "0"
    if "ァ" <= ch <= "ヺ" or ch == "ー":
        return "k"
    if "ぁ" <= ch <= "ゞ":
        return "h"
    return "c" if "一" <= ch <= "鿿" or ch in "々〆ヶ" else "l"


class Token:
    """A run of letters of one script: its place in the text without separators, whether it stands in brackets or
    touches the next one."""

    __slots__ = ("text", "start", "end", "inside", "touches", "script")

    def __init__(self, text: str, start: int, inside: bool) -> None:
        self.text, self.start, self.end, self.inside, self.touches, self.script = text, start, start + len(text), inside, False, script(text)


def tokenize(text: str) -> list[Token]:
    """The tokens of a text in consistent form and lower case; all separators count alike."""
    out: list[Token] = []
    depth = at = end = 0
    for m in _TOKEN.finditer(text):
        gap = text[end : m.start()]
        for ch in gap:
            depth = depth + 1 if ch in _OPEN else max(depth - 1, 0) if ch in _CLOSE else depth
        if out and not gap:
            out[-1].touches = True
        out.append(Token(m[0], at, depth > 0))
        at, end = at + len(m[0]), m.end()
    return out


def plain(value: str) -> str:
    return re.sub("[®™]", " ", canonical(value).lower()).strip()


class NearIndex:
    """Strings by positional bigrams: finds all within `most` edits or neighbour swaps without a walk over the list.

    An edit spoils at most two padded bigrams and a swap three, and none moves a bigram by more than `most` places.
    """

    def __init__(self) -> None:
        self.at: dict[str, list[int]] = {}
        self.names: list[str] = []

    @staticmethod
    def _bigrams(s: str) -> list[str]:
        p = "\x02" + s + "\x03"
        return [p[i : i + 2] for i in range(len(p) - 1)]

    def add(self, name: str) -> None:
        k = len(self.names)
        self.names.append(name)
        for i, g in enumerate(self._bigrams(name)):
            self.at.setdefault(f"{len(name)},{i},{g}", []).append(k)

    def near(self, s: str, most: int) -> list[tuple[int, str]]:
        """(distance, name) of the names within `most`."""
        shared: dict[int, int] = {}
        for i, g in enumerate(self._bigrams(s)):
            for n in range(len(s) - most, len(s) + most + 1):
                seen: set[int] = set()
                for j in range(i - most, i + most + 1):
                    seen.update(self.at.get(f"{n},{j},{g}", ()))
                for k in seen:
                    shared[k] = shared.get(k, 0) + 1
        out = []
        for k, c in shared.items():
            name = self.names[k]
            if c >= max(len(s), len(name)) + 1 - 3 * most and (d := osa(s, name, most)) <= most:
                out.append((d, name))
        return out


def _shorter(s: str) -> set[str]:
    """s and all strings with one character less: two strings within one edit or swap share one of them."""
    return {s, *(s[:i] + s[i + 1 :] for i in range(len(s)))}


class Matcher:
    """Compiled matcher of one registry: (product, canonical_product) pairs, and the words that are only context."""

    def __init__(self, pairs: list[tuple[str, str]], context: Iterable[str] = ()) -> None:
        self.context = frozenset(context) | frozenset(PACKAGES)
        self.longest_context = max(map(len, self.context))
        forms: dict[str, str] = {}
        names: set[tuple[str, str, str]] = set()  # stem, version, canonical
        words: dict[tuple[tuple[str, ...], str], str] = {}  # stem tokens, version
        for product, canon in pairs:
            tokens = [t.text for t in tokenize(plain(product))]
            if not tokens:
                continue
            version = _VERSION.get(tokens[-1], "") if len(tokens) > 1 else ""
            stem = tuple(tokens[:-1] if version else tokens)
            names.add(("".join(stem), version, canon))
            words[stem, version] = canon
            forms["".join(tokens)] = canon
        # stems of one canonical stem are interchangeable before its versions
        unversioned = {stem: canon for stem, version, canon in names if not version}
        alike: dict[str, set[str]] = {}
        for stem, canon in unversioned.items():
            alike.setdefault(canon, set()).add(stem)
        for stem, version, canon in sorted(names):
            if version:
                names |= {(s, version, canon) for s in alike.get(unversioned.get(stem, ""), ())}
        self.of: dict[tuple[str, str], str] = {}  # (stem, version): canonical
        spellings: dict[str, list[str]] = {}
        for form, version in _VERSION.items():
            spellings.setdefault(version, []).append(form)
        for stem, version, canon in sorted(names):
            self.of.setdefault((stem, version), canon)
            for form in spellings[version] if version else [""]:
                forms.setdefault(stem + form, canon)
        self.forms = forms
        self.scripts = {script(t.text) for p, _ in pairs for t in tokenize(plain(p))} | {"0"}
        self.automaton = ahocorasick.Automaton()
        for form, canon in forms.items():
            self.automaton.add_word(form, (form, canon))
        if forms:
            self.automaton.make_automaton()
        self.sorted = sorted({(s, c) for (s, v), c in self.of.items() if not v})
        self.stems, self.parts, self.whole = NearIndex(), NearIndex(), NearIndex()
        self.sounds: dict[str, list[str]] = {}  # consonants, also with one left out: stems
        self.sound_of: dict[str, str] = {}
        self.with_part: dict[str, list[tuple[tuple[str, ...], str]]] = {}
        for stem in sorted({s for s, _ in self.of}):
            self.stems.add(stem)
            self._add_sound(stem)
        for form in sorted(forms):
            if len(form) >= 7:
                self.whole.add(form)
        for key in sorted(words):
            for part in set(key[0]):
                if part not in self.with_part:
                    self.parts.add(part)
                    self._add_sound(part)
                self.with_part.setdefault(part, []).append(key)
        self.word_forms = words

    def _add_sound(self, stem: str) -> None:
        if not _is_kana(stem) and stem not in self.sound_of:
            self.sound_of[stem] = latin_sound(stem)
            if len(self.sound_of[stem]) >= 3:
                for k in _shorter(self.sound_of[stem]):
                    self.sounds.setdefault(k, []).append(stem)

    def mentions(self, text: str) -> list[tuple[int, int, str]]:
        """Longest non-overlapping mentions in a text without separators: (start, end, canonical)."""
        return self._longest([(e + 1 - len(f), e + 1, c) for e, (f, c) in self.automaton.iter(text)]) if self.forms else []

    @staticmethod
    def _longest(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        out: list[tuple[int, int, str]] = []  # in order of place, without overlaps
        for m in sorted(found, key=lambda m: (m[0] - m[1], m[0])):
            i = bisect.bisect_left(out, m)
            if (not i or out[i - 1][1] <= m[0]) and (i == len(out) or out[i][0] >= m[1]):
                out.insert(i, m)
        return out

    def _borders(self, tokens: list[Token]) -> tuple[set[int], set[int]]:
        """Where a mention may begin and end: at tokens, and inside one before or after a context word."""
        begin, end = {t.start for t in tokens}, {t.end for t in tokens}
        for t in tokens:
            for i in range(1, min(len(t.text), self.longest_context + 1)):
                if t.text[:i] in self.context:
                    begin.add(t.start + i)
                if t.text[-i:] in self.context:
                    end.add(t.end - i)
        return begin, end

    def embedded(self, tokens: list[Token]) -> list[tuple[int, int, str]]:
        """The mentions at token borders, longest first where they overlap."""
        if not self.forms:
            return []
        begin, end = self._borders(tokens)
        found = [(e + 1 - len(f), e + 1, c) for e, (f, c) in self.automaton.iter("".join(t.text for t in tokens))]
        return self._longest([m for m in found if m[0] in begin and m[1] in end])

    def is_part(self, tokens: list[Token], i: int) -> bool:
        """Whether token i can be a name part: not context by its script, its word, its brackets or its counter."""
        t = tokens[i]
        if t.script not in self.scripts or t.text in self.context or t.inside:
            return False
        after = tokens[i + 1] if t.touches else None
        if after and after.script in "ch" and after.script not in self.scripts:
            return not (t.script == "0" or len(after.text) >= 2)  # a number with its counter, the head of a compound word
        return True

    def match(self, value: str) -> str:
        text = plain(value)
        cut_short = text.endswith((".", "…"))
        tokens = tokenize(text)
        if not tokens:
            return UNMATCHED
        if cut_short and len(tokens) == 1:
            hits = self._beginning(tokens[0].text)
            return hits.pop() if len(hits) == 1 else self._similar([tokens[0].text])
        found = self.embedded(tokens)
        whole = "".join(t.text for t in tokens)
        starts, ends = [t.start for t in tokens], [t.end for t in tokens]
        for a, b, canon in sorted(found, key=lambda m: (m[0] - m[1], m[0])):
            before, after = bisect.bisect_right(ends, a), bisect.bisect_left(starts, b)  # tokens wholly on either side
            left, right = ([before - 1] if before else []), ([after] if after < len(tokens) else [])
            kinds = {t.script for t in tokens[before:after]} | {"0"}
            beside = [i for i in left + right if self.is_part(tokens, i) and (tokens[i].script in kinds or tokens[i].text in _VERSION)]
            if not beside:
                return canon
            if len(beside) == 1 and (v := _VERSION.get(tokens[beside[0]].text)):
                return self.of.get((whole[a:b], v), UNMATCHED)  # a version of its own, wherever it stands
        if found and not self._maybe_typed_apart(whole, found):
            return UNMATCHED  # a name part of its own
        given = [t.text for i, t in enumerate(tokens) if self.is_part(tokens, i)]
        out = self._similar(given) if given else UNMATCHED
        bare = [self._bare(t) for t in given]
        return self._similar(bare) if out == UNMATCHED and bare != given else out

    def _maybe_typed_apart(self, whole: str, found: list[tuple[int, int, str]]) -> bool:
        """Whether the mentions could be pieces of a longer name that the list holds in several tokens."""
        return any(len(k[0]) > 1 for a, b, _ in found for k in self.with_part.get(whole[a:b], ()))

    def _bare(self, token: str) -> str:
        """A token without a context word written together with it."""
        most = min(len(token) - 3, self.longest_context)
        for i in range(most, 0, -1):
            if token[-i:] in self.context:
                return token[:-i]
        for i in range(1, most + 1):
            if token[:i] in self.context:
                return token[i:]
        return token

    def _beginning(self, s: str) -> set[str]:
        """Products whose name begins with an abbreviation of at least four letters."""
        if len(s) < 4:
            return set()
        a, z = bisect.bisect_left(self.sorted, (s, "")), bisect.bisect_left(self.sorted, (s + "\uffff", ""))
        return {c for _, c in self.sorted[a:z]}

    def _similar(self, tokens: list[str]) -> str:
        """Token-set similarity: version parts apart and in any place; tokens joined, then token by token in any order."""
        given = tokens
        if len(tokens) > 1 and any(t in _VERSION for t in tokens[:-1]):
            tokens = [t for t in tokens if t not in _VERSION] + [t for t in tokens if t in _VERSION]
        best: tuple[float, int, str] | None = None
        for k in range(len(tokens), 0, -1):
            rest = "".join(tokens[k:])
            if len(rest) > LONGEST_VERSION:
                break
            stem = "".join(tokens[:k])
            if rest and rest not in _VERSION or not rest and len(tokens) > 1 and tokens[-1] in _VERSION:
                continue
            options = [(stem, _VERSION.get(rest, ""))]
            if not rest:
                for form, version in _VERSION.items():
                    if form and stem.endswith(form) and len(stem) - len(form) >= (5 if stem.isascii() else 3) and (not form.isascii() or len(form) > 1 or form.isdigit()):
                        options.append((stem[: -len(form)], version))
            for s, version in options:
                for d, name in self._near(s, self.stems):
                    canon = self.of.get((name, version))
                    if canon is not None and (best is None or (d, -len(s), canon) < best) and not self._spare(tokens[:k], name, d):
                        best = (d, -len(s), canon)
            if best and best[0] <= 1.2:
                break
        if best is None and len(tokens) > 1 and tokens[-1] not in _VERSION:
            # a slip inside the version part itself
            whole = "".join(tokens)
            for d, form in sorted(self.whole.near(whole, 1)):
                if d == 1 and not re.search(r"(?:i+|\d)$", form) and not self._spare(tokens, form, 1):
                    best = (1, -len(whole), self.forms[form])
                    break
        return best[2] if best else self._same_tokens(given)

    def _spare(self, tokens: list[str], name: str, d: float) -> bool:
        """Whether the name is as near without one of the tokens, which then is a name part of its own."""
        for i in range(len(tokens) if len(tokens) > 1 else 0):
            less = self._distance("".join(tokens[:i] + tokens[i + 1 :]), name)
            if less is not None and less <= d:
                return True
        return False

    def _same_tokens(self, tokens: list[str]) -> str:
        """The name with the nearest set of tokens: each token to its best counterpart, versions equal, in any order."""
        versions = [_VERSION[t] for t in tokens if t in _VERSION]
        typed = [t for t in tokens if t not in _VERSION]
        if len(typed) < 2 or len(versions) > 1:
            return UNMATCHED
        near = {t: dict((name, d) for d, name in self._near(t, self.parts)) for t in typed}
        keys = {k for t in typed for name in near[t] for k in self.with_part[name]}
        best: tuple[float, str] | None = None
        for words, version in keys:
            if len(words) != len(typed) or version != (versions[0] if versions else ""):
                continue
            pairs = sorted((near[t][w], i, j) for i, t in enumerate(typed) for j, w in enumerate(words) if w in near[t])
            left, right, total = set(), set(), 0.0
            for d, i, j in pairs:
                if i not in left and j not in right:
                    left.add(i)
                    right.add(j)
                    total += d
            canon = self.word_forms[words, version]
            if len(left) == len(typed) and (best is None or (total, canon) < best):
                best = (total, canon)
        return best[1] if best else UNMATCHED

    def _near(self, s: str, index: NearIndex) -> list[tuple[float, str]]:
        """(distance, name) of the indexed names that are near enough; sound counts for katakana."""
        out: dict[str, float] = {}
        known = index.near(s, 0)
        out.update({name: 0.0 for _, name in known})
        if len(s) >= 4:
            for d, name in index.near(s, 2):
                if len(name) >= 5 and d <= (2 if len(name) >= 9 else 1):
                    out.setdefault(name, float(d))
        if _is_kana(s):
            names = set(index.names) if len(index.names) < 64 else None
            for k in _shorter(kana_sound(s)):
                for name in self.sounds.get(k, ()):
                    if name not in out and (names is None or name in names) and (d := self._distance(s, name)) is not None:
                        out[name] = d
        return sorted((d, name) for name, d in out.items())

    def _distance(self, s: str, name: str) -> float | None:
        """Edits between a typed stem and a name, if near enough; sound counts for katakana."""
        if s == name:
            return 0
        if _is_kana(s) and not _is_kana(name):
            a, b = kana_sound(s), self.sound_of.get(name, "")
            if len(b) < 3 or len(a) < 2 or osa(a, b, 1) > 1:
                return None
            x, y = kana_full(s), latin_full(name)
            part = osa(x, y, 9) / max(len(x), len(y))
            return 0.5 * (a != b) + part if part <= 0.6 else None
        if len(name) >= 5 and len(s) >= 4:
            most = 2 if len(name) >= 9 else 1
            d = osa(s, name, most)
            if d <= most:
                return d
        return None


_COMPILED: dict[str, Matcher] = {}


def _matcher(digest: str, pairs: tuple[tuple[str, str], ...], context: tuple[str, ...]) -> Matcher:
    """The matcher of a registry, compiled once in each worker."""
    if digest not in _COMPILED:
        if len(_COMPILED) >= 4:
            _COMPILED.clear()
        _COMPILED[digest] = Matcher(list(pairs), context)
    return _COMPILED[digest]


def registry_pairs(registry: DataFrame) -> tuple[tuple[str, str], ...]:
    """The (product, canonical_product) pairs, refused above MAX_PRODUCTS."""
    rows = registry.where("product is not null and canonical_product is not null").select("product", "canonical_product").limit(MAX_PRODUCTS + 1).collect()
    if len(rows) > MAX_PRODUCTS:
        raise ValueError(f"the list has more than {MAX_PRODUCTS} entries")
    return tuple(sorted((r[0], r[1]) for r in rows))


def _digest(*of: object) -> str:
    return hashlib.sha1(repr(of).encode()).hexdigest()


def context_words(values: DataFrame, column: str, pairs: tuple[tuple[str, str], ...]) -> tuple[str, ...]:
    """The words that stand directly beside mentions of many different products, counted over all values.

    Version parts that the list itself uses are name parts, whatever they stand beside.
    """
    digest = _digest(pairs)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = _matcher(digest, pairs, ())
        for b in batches:
            seen: set[tuple[str, str]] = set()
            for v in b[column]:
                tokens = tokenize(plain(v))
                text = "".join(t.text for t in tokens)
                for a, z, canon in m.mentions(text):
                    for t in tokens:
                        if t.end == a or t.start == z:
                            seen.add((t.text, canon))
                        elif t.start == a and t.end > z and t.script == "k":  # written together, as words in katakana often are
                            seen.add((t.text[z - a :], canon))
            yield pd.DataFrame(sorted(seen), columns=["word", "canon"])

    found = cut(values.where(F.col(column).isNotNull()).select(column).distinct().mapInPandas(words, "word string, canon string").distinct())
    most = found.agg(F.countDistinct("canon")).first()[0]
    common = found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= max(3, COMMON * most)).select("word").limit(MAX_CONTEXT + 1).collect()
    if len(common) > MAX_CONTEXT:
        raise ValueError(f"more than {MAX_CONTEXT} words stand beside the products")
    own = {_VERSION[ts[-1].text] for p, _ in pairs if len(ts := tokenize(plain(p))) > 1 and ts[-1].text in _VERSION}
    return tuple(sorted(r.word for r in common if _VERSION.get(r.word) not in own))


def map_values(values: DataFrame, column: str, registry: DataFrame) -> DataFrame:
    """values with canonical_product; values written exactly as some product of the list are left out."""
    pairs = registry_pairs(registry)
    ship_package(values.sparkSession)
    exact = registry.select(F.col("product").alias("_exact")).where(F.col("_exact").isNotNull()).distinct()
    rows = values.where(F.col(column).isNotNull())
    rows = cut(rows.join(bounded(exact, MAX_PRODUCTS), F.col(column) == F.col("_exact"), "left_anti"))
    context = context_words(rows, column, pairs)
    digest = _digest(pairs, context)

    @F.pandas_udf(StringType())
    def mapped(s: pd.Series) -> pd.Series:
        m = _matcher(digest, pairs, context)
        return s.map({v: m.match(v) for v in s.dropna().unique()})

    return rows.withColumn("canonical_product", mapped(F.col(column)))
