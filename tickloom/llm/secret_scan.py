"""Secret scan with a recursive decoding worklist.

A text is layer 0. Each layer is scanned, and its URL-, Unicode-escape-, base64- and compression-encoded parts are decoded
into new layers, until none is left. A layer that was seen before in the same text is dropped, so cycles end. Every layer
knows which code points of the whole text each of its characters stands for, so finds in any layer map to spans of the text.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import python_ready

KINDS = ("assign", "access", "hex")
#: Spans found in a decoded layer: the same kinds, listed after the base ones.
DECODED = {k: f"decoded_{k}" for k in KINDS}
ORDER = {k: i for i, k in enumerate([*KINDS, *DECODED.values()])}
REDACTED = "[SECRET]"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: Leftmost greedy runs of at least this length are what remains of all runs when short ones are dropped.
_ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
_HEX = re.compile("[0-9a-f]{16,}")

_SOLID = re.compile("[!-~]+")
_HEXED, _TWO = re.compile("%([0-9A-Fa-f]{2})"), re.compile("[0-9A-Fa-f]{2}")
_ONE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
#: What makes an escape of a decoded backslash or ampersand.
_REST = {"\\": re.compile(r"u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|x([0-9A-Fa-f]{2})()()"), "&": re.compile(r"()()()#x([0-9A-Fa-f]{1,6});|#([0-9]{1,7});")}
#: Base64 characters, also across line breaks: what has 20 in a row or reaches the end of its line.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{20}|[A-Za-z0-9+/_-]++[ \t]*+[\r\n])[A-Za-z0-9+/_-]++(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+={0,2}")
_RUN = re.compile("[A-Za-z0-9+/_-]+")
#: A find and whatever encodes one is a stretch of ASCII text of at least 16 characters.
_STRETCH = re.compile(rb"[\t\n\r\x20-\x7e]{16,}")
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
#: First bytes of gzip, zlib, bzip2 and xz data.
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00")
#: Bytes that are fed to a decompressor, taken from it and scanned at a time, and that two windows share.
FEED, PIECE, WINDOW, OVERLAP = 1 << 16, 1 << 20, 1 << 22, 1 << 21
#: Packed data directly inside packed data is opened this often; data that unpacks to itself ends there.
DEPTH = 32


def scan_layer(text: str) -> list[tuple[str, int, int]]:
    """Base spans (kind, start, end) of one layer, leftmost and non-overlapping in each kind."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


class Layer:
    """A decoded text with, for each run of its characters, the span of the whole text behind it.

    at: where runs begin; a run (start, end, step) maps character i of the run to start + i * step (step 1: one to one, step
    0: all of start..end).
    """

    def __init__(self, text: str, at: list[int], runs: list[tuple[int, int, int]]):
        self.text, self.at, self.runs = text, at, runs

    def span(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        a, b, one = self.runs[i]
        low = a + (start - self.at[i]) if one else a
        a, b, one = self.runs[j]
        return low, a + (end - 1 - self.at[j]) + 1 if one else b

    def replaced(self, start: int, end: int, parts: list[tuple[int, int, str]]) -> Layer:
        """The part start..end with parts (start, end, new) replaced; each new text maps to all of what it replaces."""
        pieces, at, runs, n, last = [], [], [], 0, start

        def plain(a: int, b: int) -> None:
            nonlocal n
            while a < b:
                i = bisect_right(self.at, a) - 1
                stop = min(b, self.at[i + 1]) if i + 1 < len(self.at) else b
                x, y, one = self.runs[i]
                at.append(n)
                runs.append((x + a - self.at[i], y, 1) if one else (x, y, 0))
                pieces.append(self.text[a:stop])
                n += stop - a
                a = stop

        for a, b, new in parts:
            plain(last, a)
            if new:
                at.append(n)
                runs.append((*self.span(a, b), 0))
                pieces.append(new)
                n += len(new)
            last = b
        plain(last, end)
        return Layer("".join(pieces), at, runs)


_BROKEN = (zlib.error, lzma.LZMAError, OSError, EOFError, ValueError)


def _opener(data: bytes):
    return bz2.BZ2Decompressor() if data[:1] == b"B" else lzma.LZMADecompressor() if data[:1] == b"\xfd" else zlib.decompressobj(47)


def _stream(feed: Iterator[bytes], used: list[int]) -> Iterator[bytes]:
    """In pieces, what streams that follow one another hold, up to an error; used[0] becomes the length of the whole ones."""
    one, fed, data = None, 0, b""
    for new in feed:
        fed += len(new)
        data += new
        while data:
            if one is None:
                if not _PACKED.match(data):
                    break
                one = _opener(data)
            more = data
            while True:
                try:
                    out = one.decompress(more, PIECE)
                except _BROKEN:
                    return
                if out:
                    yield out
                if one.eof:
                    data, one = one.unused_data, None
                    used[0] = fed - len(data)
                    break
                more = getattr(one, "unconsumed_tail", b"")
                if not more and (one.needs_input if hasattr(one, "needs_input") else len(out) < PIECE):
                    data = b""
                    break
        if one is None and len(data) >= 10:
            return


def _opened(feed: Iterator[bytes], depth: int = 0) -> Iterator[bytes]:
    """feed in windows that overlap; if it begins like packed data, its first piece and the windows of what it holds."""
    first = b""
    while len(first) < 10 and (new := next(feed, None)) is not None:
        first += new
    if depth < DEPTH and _PACKED.match(first):
        yield first
        yield from _opened(_stream(itertools.chain([first], feed), [0]), depth + 1)
        return
    held = bytearray(first)
    fresh = len(held) > 0
    for new in feed:
        held += new
        fresh = True
        if len(held) >= WINDOW:
            yield bytes(held)
            del held[:-OVERLAP]
            fresh = False
    if fresh:
        yield bytes(held)


def _texts(data: bytes) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, text, packed) of the stretches of text in data, and of those in its packed parts, at any depth."""
    for m in _STRETCH.finditer(data):
        yield *m.span(), m[0].decode(), False
    at = 0
    while m := _PACKED.search(data, at):
        at = m.start() + 1
        used = [0]
        feed = (data[i : i + FEED] for i in range(m.start(), len(data), FEED))
        for window in _opened(_stream(feed, used)):
            end = m.start() + used[0] if used[0] else len(data)
            for x in _STRETCH.finditer(window):
                yield m.start(), end, x[0].decode(), True
        at += max(0, used[0] - 1)


def _from_base64(layer: Layer, m: re.Match) -> Iterator[Layer]:
    """The texts behind base64 characters at each of the four alignments. A text that is not packed maps to lines."""
    runs = [r.span() for r in _RUN.finditer(layer.text, *m.span())]
    raw = "".join(layer.text[a:b] for a, b in runs).encode().translate(_URL_SAFE)
    if len(raw) < 20:
        return
    first = [0]
    for a, b in runs:
        first.append(first[-1] + b - a)

    def place(i: int) -> int:  # of a base64 character in the layer
        k = min(bisect_right(first, i) - 1, len(runs) - 1)
        return runs[k][0] + i - first[k]

    for skip in range(4):
        part = raw[skip:]
        part = part[:-1] if len(part) % 4 == 1 else part
        data = base64.b64decode(part + b"=" * (-len(part) % 4))

        def span(a: int, b: int) -> tuple[int, int]:
            end = m.end() if b == len(data) else place(skip + (8 * b - 1) // 6) + 1  # noqa: B023
            return layer.span(place(skip + 8 * a // 6), end)  # noqa: B023

        for a, b, text, packed in _texts(data):
            cuts = [a]
            if not packed:  # the first whole byte of each line begins a run
                cuts += sorted({c for f in first[1:-1] if a < (c := -(-6 * (f - skip) // 8)) < b})
            yield Layer(text, [c - a for c in cuts], [(*span(c, d), 0) for c, d in zip(cuts, [*cuts[1:], b], strict=True)])


def _unquoted(text: str, start: int, stop: int) -> list[tuple[int, int, str]]:
    """(start, end, new) of the runs of percent escapes in text[start:stop].

    A percent sign that comes of an escape and begins another one is decoded with it, as often as that goes on: what lies
    between differs from this layer and the next only in digits that end a longer run here. So %252525... takes linear time.
    """
    out, at = [], start
    while (m := _HEXED.search(text, at, stop)) is not None:
        begin, end, raw = m.start(), m.start(), bytearray()
        while (m := _HEXED.match(text, end, stop)) is not None:
            code, end = int(m[1], 16), m.end()
            while code == 0x25 and (n := _TWO.match(text, end, stop)) is not None:
                code, end = int(n[0], 16), n.end()
            raw.append(code)
        out.append((begin, end, raw.decode("utf-8", "ignore")))
        at = end
    return out


def _unescaped(text: str) -> list[tuple[int, int, str]]:
    """(start, end, new) of the runs of escapes. One that begins with a decoded backslash or ampersand is decoded with it."""

    def char(m: re.Match) -> str:
        code = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else ""

    out, at = [], 0
    while (m := _ONE.search(text, at)) is not None:
        begin, end, new = m.start(), m.start(), []
        while (m := _ONE.match(text, end)) is not None:
            c, end = char(m), m.end()
            while c in _REST and (m := _REST[c].match(text, end)) is not None:
                c, end = char(m), m.end()
            new.append(c)
        out.append((begin, end, "".join(new)))
        at = end
    return out


def decoded(layer: Layer) -> Iterator[Layer]:
    """The layers one step under a layer."""
    text = layer.text
    if "%" in text:
        every = []
        for m in _SOLID.finditer(text):
            if "%" in m[0] and (parts := _unquoted(text, *m.span())):
                if len(m[0]) < len(text):
                    yield layer.replaced(*m.span(), parts)
                every += parts
        if every:
            yield layer.replaced(0, len(text), every)
    if "\\u" in text or "\\x" in text or "&#" in text:
        parts = _unescaped(text)
        if parts:
            yield layer.replaced(0, len(text), parts)
    for m in _BASE64.finditer(text):
        yield from _from_base64(layer, m)


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) of a whole text in code points: base ones, and those of decoded layers.

    Sorted by start, kind and end; distinct. A decoded find that a base span of the same kind covers is left out.
    """
    text = text or ""
    if not text:
        return []
    found = set(scan_layer(text))
    base = {k: sorted((a, b) for kind, a, b in found if kind == k) for k in KINDS}  # of one kind they do not overlap

    def covered(kind: str, a: int, b: int) -> bool:
        i = bisect_right(base[kind], (a, len(text) + 1)) - 1
        return i >= 0 and b <= base[kind][i][1]

    seen = {hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()}
    # Layers are made one at a time, and a parent is let go with its last child: memory is bounded by windows and depth.
    layers = decoded(Layer(text, [0], [(0, len(text), 1)]))
    work = [(next(layers, None), layers)]
    while work:
        layer, layers = work.pop()
        if layer is None:
            continue
        if (after := next(layers, None)) is not None:
            work.append((after, layers))
        mark = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass") + b"%d" % (layer.runs[0][0] if layer.runs else 0), digest_size=16).digest()
        if layer.text and mark not in seen:
            seen.add(mark)
            for kind, start, end in scan_layer(layer.text):
                a, b = layer.span(start, end)
                if not covered(kind, a, b):
                    found.add((DECODED[kind], a, b))
            layers = decoded(layer)
            work.append((next(layers, None), layers))
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with the union of its spans replaced by REDACTED."""
    if not text or not spans:
        return text
    out, at, until = [], 0, -1
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= until:
            out += [text[at:start], REDACTED]
        until = max(until, end)
        at = until
    return "".join([*out, text[at:]])


def _named(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            spans = find_secrets(text)
            base = [s for s in spans if s[0] in KINDS]
            count = [sum(s[0] == k for s in base) for k in KINDS]
            rows.append((*count, hashlib.sha256(_named(base).encode()).hexdigest(), _named(spans)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def _redacting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        spans = [find_secrets(t) for t in texts]
        new = [redact(t, s) for t, s in zip(texts, spans, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(new, pa.string()) if c == "text" else batch.column(c) for c in batch.schema.names), pa.array([[{"kind": k, "start": a, "stop": b} for k, a, b in s] for s in spans], _SPANS)],
            [*batch.schema.names, "secrets"],
        )


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with secrets in text replaced, and secrets: an array of (kind, start, stop) in the old text.

    Null texts stay null, with no secrets. Every row is scanned by itself; a column named secrets is replaced.
    """
    python_ready(docs.sparkSession)
    docs = docs.drop("secrets")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["secrets array<struct<kind:string,start:bigint,stop:bigint>>"])
    return docs.mapInArrow(_redacting, schema)


def scan_documents(docs: DataFrame) -> DataFrame:
    """The digest of a scan: counts and a hash of base spans, and all spans. A null text is an empty one."""
    python_ready(docs.sparkSession)
    rows = docs.select("doc_id", "text").mapInArrow(_digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return rows
