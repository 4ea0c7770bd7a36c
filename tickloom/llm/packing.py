"""Packing token sequences by non-negative least squares over a histogram of lengths.

Documents are cut into full windows and one remainder. Remainders are counted by length class, one for each short length and
one for each STEP of the others; combinations of up to three classes that fill a window are enumerated, a short class as often
as it fits; repeat counts that reproduce the histogram best (non-negative least squares) are rounded down to what is there;
greedy packing takes the rest. Only the histogram reaches the driver.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex as re
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import materialize, python_ready, ranked

WINDOW = 4096
#: Pieces of up to SHORT tokens have a class for each length; longer ones are packed as if rounded up to a multiple of STEP.
STEP, SHORT = 16, 512
END = 2
#: White-space-free parts, and pretokens, whose ids a worker remembers.
CACHE = 400_000
#: Parts of these characters only are lower-cased and split here; the tokenizer itself takes all others.
_PLAIN = re.compile("[!-~\u00a1-\u012f\u0132-\u017e]+")
#: The tokenizer's own split pattern.
_split = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall

_parts: dict[bytes, bytes] = {}
_pretokens: dict[str, bytes] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@lru_cache(1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(1)
def _letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(other)}


def _encoded(part: bytes, path: str) -> bytes:
    """Ids of a white-space-free part."""
    text = part.decode("utf-8")
    if not _PLAIN.fullmatch(text) or "<|" in text:
        return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    out = []
    for pretoken in _split(text.lower()):
        ids = _pretokens.get(pretoken)
        if ids is None:
            raw = pretoken if pretoken.isascii() else "".join(map(_letters().__getitem__, pretoken.encode("utf-8")))
            ids = np.array([t.id for t in _tokenizer(path).model.tokenize(raw)], "<u4").tobytes()
            if len(_pretokens) >= CACHE:
                _pretokens.clear()
            _pretokens[pretoken] = ids
        out.append(ids)
    return b"".join(out)


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text, then the end id.

    The tokenizer never joins characters across white space, so ids of a text are those of its white-space-free parts; the
    parts' ids are remembered, and only new parts are encoded.
    """
    end = np.array([END], "<u4").tobytes()
    out = []
    for text in texts:
        words = text.encode("utf-8").split()
        try:
            ids = [_parts[w] for w in words]
        except KeyError:
            ids = []
            for w in words:
                got = _parts.get(w)
                if got is None:
                    got = _encoded(w, path)
                    if len(_parts) < CACHE:
                        _parts[w] = got
                ids.append(got)
        out.append(b"".join(ids) + end)
    return out


def _pieces(path: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            ids = batch.column("doc_id").to_pylist()
            for doc, blob in zip(ids, token_bytes([t or "" for t in batch.column("text").to_pylist()], path), strict=True):
                n = len(blob) // 4
                for start in range(0, n, window):
                    part = blob[4 * start : 4 * (start + window)]
                    for column, value in zip(out, (doc, start, len(part) // 4, zlib.crc32(part), n), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def sizes(window: int = WINDOW, step: int = STEP) -> np.ndarray:
    """The length that each class stands for, ascending; the last one is the window."""
    short = min(SHORT, window) // step * step
    return np.concatenate([np.arange(1, short + 1), np.arange(short + step, window + 1, step)]) if short else np.arange(step, window + 1, step)


def combinations(histogram: np.ndarray, size: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Combinations of up to three classes that occur, which fill a window but for less than a step: (classes, how often).

    Of long classes: pairs and triples. Of short ones: as often as one fits, alone or after one long class, and then the
    class that fills the rest, if there is one.
    """
    step = int(size[-1] - size[-2]) if len(size) > 1 else 1
    number = {int(n): i for i, n in enumerate(size)}
    here = [int(size[i]) for i in np.flatnonzero(histogram) if size[i] < window]
    there = set(here)
    found: set[tuple[tuple[int, int], ...]] = set()

    def add(*parts: tuple[int, int]) -> None:
        many: dict[int, int] = {}
        for n, k in parts:
            if n and k:
                many[n] = many.get(n, 0) + k
        if window - step < sum(n * k for n, k in many.items()) <= window:
            found.add(tuple(sorted(many.items())))

    grid = [n for n in here if n % step == 0]
    for i, a in enumerate(grid):
        add((a, 1), (window - a if window - a in there else 0, 1))
        for b in grid[i:]:
            if b <= (c := window - a - b) and c in there:
                add((a, 1), (b, 1), (c, 1))
    for a in (n for n in here if n <= SHORT):
        for b in [0, *(n for n in here if n > SHORT)]:
            rest = (window - b) % a
            add((b, 1), (a, (window - b) // a), (rest if rest in there else 0, 1))
    rows = sorted(found)
    kinds, times = np.zeros((len(rows), 3), np.int64), np.zeros((len(rows), 3), np.int64)
    for i, row in enumerate(rows):
        for j, (n, k) in enumerate(row):
            kinds[i, j], times[i, j] = number[n], k
    return kinds, times


def solve(kinds: np.ndarray, times: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative x that minimises |sum of x times combinations - histogram|^2, by accelerated projected gradient.

    Each combination is scaled to length one, so that those with many pieces do not set the pace of the others.
    """
    length = np.sqrt((times**2).sum(1))
    each = times / length[:, None]

    def forward(x):
        return np.bincount(kinds.ravel(), (x[:, None] * each).ravel(), len(histogram))

    def backward(r):
        return (r[kinds] * each).sum(1)

    v = np.ones(len(kinds))
    for _ in range(50):
        v = backward(forward(v))
        v /= np.linalg.norm(v)
    rate = 1 / (1.01 * np.linalg.norm(backward(forward(v))))
    x = y = np.zeros(len(kinds))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - rate * backward(forward(y) - histogram), 0)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / s * (new - x)
        x, t = new, s
    return x / length


def plan(histogram: np.ndarray, size: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """(classes of a sequence, each with how often; how many such sequences) that use up the histogram exactly.

    Its length follows the classes, not the data.
    """
    left = histogram.astype(np.int64).copy()
    out = []
    if left[-1]:
        out.append((((len(left) - 1, 1),), int(left[-1])))
        left[-1] = 0
    kinds, times = combinations(left, size, window)
    if len(kinds):
        x = solve(kinds, times, left / left.max()) * left.max()
        for i in np.argsort(-x, kind="stable"):
            if x[i] < 0.5:
                break
            parts = [(int(c), int(k)) for c, k in zip(kinds[i], times[i], strict=True) if k]
            many = int(min(np.floor(x[i] + 0.5), *(left[c] // k for c, k in parts)))
            if many:
                for c, k in parts:
                    left[c] -= k * many
                out.append((tuple(parts), many))
    while left.any():
        room, taken = window, []
        for c in np.flatnonzero(left)[::-1]:
            k = int(min(room // size[c], left[c]))
            if k:
                taken.append((int(c), k))
                room -= int(size[c]) * k
        many = min(int(left[c]) // k for c, k in taken)
        for c, k in taken:
            left[c] -= k * many
        out.append((tuple(taken), many))
    return out


def _places(plans: list[tuple[tuple[tuple[int, int], ...], int]], classes: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By class: the ranks at which runs begin, each run's first sequence, its place there, and its pieces a sequence."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {c: [] for c in range(classes)}
    used = [0] * classes
    base = 0
    for parts, many in plans:
        place = 0
        for c, k in parts:
            runs[c].append((used[c], base, place, k))
            used[c] += k * many
            place += k
        base += many
    return {c: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for c, r in runs.items() if r}


def _assign(places: dict[int, tuple[np.ndarray, ...]], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "rank"))
            sequence, position = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
            for c in np.unique(kind):
                at = np.flatnonzero(kind == c)
                begin, base, place, many = places[int(c)]
                i = np.searchsorted(begin, rank[at], "right") - 1
                within = rank[at] - begin[i]
                sequence[at], position[at] = base[i] + within // many[i], place[i] + within % many[i]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(position)], [*names, "sequence_id", "position"])

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """Pack all documents into sequences of at most `window` tokens.

    Returns a row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A document's tokens are
    its ids and the end id, so a null or empty text has one. Only documents longer than the window are cut, at its multiples.
    Offsets are gapless; what a sequence lacks is padding at its end. Rows that repeat a doc_id are documents of their own, and
    which sequence a piece goes to follows from a number of its row, so copies are apart. Other columns are left out; an empty
    table gives no rows.
    """
    python_ready(docs.sparkSession)
    run = _pieces(tokenizer or default_tokenizer(), window)
    pieces = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    size = sizes(window, step)
    short = int((size <= SHORT).sum()) if size[0] == 1 else 0
    kind = F.when(F.col("length") <= short, F.col("length") - 1).otherwise(F.ceil(F.col("length") / step) + (short - short // step - 1))
    pieces = materialize(pieces.withColumns({"kind": kind.cast("long"), "number": F.monotonically_increasing_id()}), "pieces")
    histogram = np.zeros(len(size), np.int64)
    for kind, n in pieces.groupBy("kind").count().collect():  # at most as many rows as classes
        histogram[kind] = n
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rows = ranked(pieces, ["kind"], [F.xxhash64("number"), F.col("number")], "rank", int(max(histogram.max(), 1)))
    placed = rows.select(*names, "kind", "rank").mapInArrow(_assign(_places(plan(histogram, size, window), len(size)), names), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, position long")
    before = Window.partitionBy("sequence_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("position")
