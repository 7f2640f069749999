"""Text of PDF files by page, with the standard library only.

Reads what most text documents use: compressed and plain streams, object streams, simple fonts, and fonts whose
ToUnicode map tells what their codes mean. Pictures, encrypted files and other filters give no text; whether a page
needs text recognition is then decided by readers.needs_recognition. A file that cannot be read gives no pages and
its error as text.
"""

from __future__ import annotations

import re
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)(?:\bendobj\b|(?=\b\d+\s+\d+\s+obj\b)|\Z)", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_REF = rb"(\d+)\s+\d+\s+R"
_STRING = rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>"
_SHOW = re.compile(
    rb"/(?P<font>[^\s/\[\]()<>]+)\s+[-\d.]+\s+Tf|(?P<text>" + _STRING + rb")\s*(?:Tj|'|\")|\[(?P<list>(?:" + _STRING + rb"|[^\]])*)\]\s*TJ"
    rb"|(?P<line>T\*|-?[\d.]+\s+-?[\d.]+\s+T[dD]\b|(?:-?[\d.]+\s+){6}Tm|\bET\b)", re.S,
)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Pdf:
    """The objects of one file."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != b"%PDF":
            raise ValueError("no PDF file")
        if b"/Encrypt" in data:
            raise ValueError("encrypted")
        self.objects = {int(m[1]): m[3] for m in _OBJECT.finditer(data)}
        for body in list(self.objects.values()):
            if re.search(rb"/Type\s*/ObjStm", body):
                self._unpack(body)

    def _unpack(self, body: bytes) -> None:
        """Objects kept inside a compressed stream."""
        first = re.search(rb"/First\s+(\d+)", body)
        data = self.stream(body)
        if not first or data is None:
            return
        start = int(first[1])
        heads = [int(x) for x in data[:start].split()]
        places = list(zip(heads[::2], heads[1::2], strict=False))
        for k, (number, at) in enumerate(places):
            end = places[k + 1][1] if k + 1 < len(places) else len(data) - start
            self.objects.setdefault(number, data[start + at : start + end])

    def stream(self, body: bytes) -> bytes | None:
        m = _STREAM.search(body)
        if not m:
            return None
        if re.search(rb"/Filter\s*\[?\s*/FlateDecode\s*\]?", body):
            try:
                return zlib.decompressobj().decompress(m[1])
            except zlib.error:
                return None
        return None if b"/Filter" in body[: m.start()] else m[1]

    def value(self, body: bytes, name: bytes) -> bytes:
        """The entry of a dictionary, a reference followed."""
        m = re.search(rb"/" + name + rb"\b\s*(?:" + _REF + rb"|(<<.*))", body, re.S)
        if not m:
            return b""
        return self.objects.get(int(m[1]), b"") if m[1] else m[2]

    def kids(self, number: int, seen: set[int]) -> list[int]:
        """The pages below a node of the page tree, in order."""
        body = self.objects.get(number, b"")
        m = re.search(rb"/Kids\s*\[(.*?)\]", body, re.S)
        if number in seen:
            return []
        seen.add(number)
        if not m:
            return [number]
        return [p for k in re.findall(_REF, m[1]) for p in self.kids(int(k), seen)]

    def pages(self) -> list[str]:
        root = next((n for n, b in self.objects.items() if re.search(rb"/Type\s*/Catalog\b", b)), None)
        top = re.search(rb"/Pages\s+" + _REF, self.objects[root]) if root is not None else None
        numbers = self.kids(int(top[1]), set()) if top else sorted(n for n, b in self.objects.items() if re.search(rb"/Type\s*/Page\b", b))
        return [self.text(self.objects.get(n, b"")) for n in numbers]

    def text(self, page: bytes) -> str:
        m = re.search(rb"/Contents\s*(?:\[(.*?)\]|" + _REF + rb")", page, re.S)
        parts = re.findall(_REF, m[1]) if m and m[1] is not None else [m[2]] if m else []
        content = b"\n".join(self.stream(self.objects.get(int(p), b"")) or b"" for p in parts)
        fonts = self.value(self.value(page, b"Resources") or page, b"Font")
        maps = {name: self.codes(self.objects.get(int(ref), b"")) for name, ref in re.findall(rb"/([^\s/\[\]()<>]+)\s+" + _REF, fonts)}
        out, codes = [], None
        for m in _SHOW.finditer(content):
            if m["font"]:
                codes = maps.get(m["font"])
            elif m["line"]:
                out.append("\n")
            else:
                for s in re.findall(_STRING, m["text"] if m["text"] is not None else m["list"]):
                    out.append(self.decoded(s, codes))
        return "\n".join(x for x in (" ".join(line.split()) for line in "".join(out).split("\n")) if x)

    def codes(self, font: bytes) -> dict[bytes, str] | None:
        """What the codes of a font stand for, if it tells."""
        ref = re.search(rb"/ToUnicode\s+" + _REF, font)
        cmap = self.stream(self.objects.get(int(ref[1]), b"")) if ref else None
        if not cmap:
            return None
        out: dict[bytes, str] = {}
        read = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
        for block in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
            for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
                out[bytes.fromhex(a.decode())] = read(b)
        for block in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
            for a, z, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
                first, width, to = int(a, 16), len(a) // 2, int(b, 16)
                for k in range(min(int(z, 16) - first, 0xFFFF) + 1):
                    out[(first + k).to_bytes(width, "big")] = read(f"{to + k:0{len(b)}x}".encode())
        return out

    @staticmethod
    def decoded(s: bytes, codes: dict[bytes, str] | None) -> str:
        if s[:1] == b"<":
            digits = re.sub(rb"\s", b"", s[1:-1]).decode()
            raw = bytes.fromhex(digits + "0" * (len(digits) % 2))
        else:
            raw = re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else b"" if m[1][-1:] == b"\n" else _ESCAPES.get(m[1], m[1]), s[1:-1], flags=re.S)
        if not codes:
            return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("cp1252", "replace")
        out, i, widths = [], 0, sorted({len(k) for k in codes}, reverse=True)
        while i < len(raw):
            for w in widths:
                if raw[i : i + w] in codes:
                    out.append(codes[raw[i : i + w]])
                    i += w
                    break
            else:
                i += widths[-1]
        return "".join(out)


@F.pandas_udf(StructType([StructField("pages", ArrayType(StringType())), StructField("error", StringType())]))
def pdf_pages(content: pd.Series) -> pd.DataFrame:
    """The text of each page, and the error of a file that cannot be read; null gives nulls."""
    out = []
    for b in content:
        try:
            out.append((None if b is None else Pdf(bytes(b)).pages(), None))
        except Exception as e:  # kept as a value, the job goes on
            out.append(([], f"{type(e).__name__}: {e}"[:300]))
    return pd.DataFrame(out, columns=["pages", "error"])
