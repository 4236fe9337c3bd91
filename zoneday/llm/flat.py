"""Many texts as one flat array of code points, cut into words by array operations."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

CHUNK_CHARS = 1 << 20  # texts handled at once; one longer text is a chunk of its own
SLICE_ROWS = 1024
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
_BASE = 0x9E3779B97F4A7C15


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def few_rows_per_batch(spark: SparkSession, rows: int = 1000) -> None:
    """Lets the session send at most ``rows`` rows to Python at once: texts are long, and both sides hold whole batches."""
    now = int(spark.conf.get(BATCH_ROWS))
    if now <= 0 or now > rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` characters, or of one longer text."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def text_rows(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]:
    """Each batch in slices of about one chunk: the slice, its texts (null: empty) and which were null."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
        null = np.array([t is None for t in texts], dtype=bool)
        texts = ["" if t is None else t for t in texts]
        for a, b in chunks(texts):
            yield batch.slice(a, b - a), texts[a:b], null[a:b]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts in a row, and where each text begins (one bound more than texts)."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), bounds


@cache
def classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or other."""
    import regex

    table = np.zeros(0x110000, dtype=np.uint8)
    whole = "".join(chr(i) if not 0xD800 <= i < 0xE000 else "\x00" for i in range(0x110000))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, whole):
            table[m.start() : m.end()] = kind
    return table


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n."""
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, CHUNK_CHARS + 1), base, dtype=np.uint64)
        p[0] = 1
        _powers[base] = np.cumprod(p)
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits; one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of a flat array; equal spans have equal hashes wherever they lie.

    For features and for finding what may be equal: texts can be written whose
    hashes meet, so where equality decides, letters are compared as well.
    """
    n = len(values)
    v = mix(values.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(v, out=sums[1:])
    back = powers(pow(_BASE, -1, 1 << 64), n + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def equal_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each span of a flat array equals span number ``other`` of it, value by value."""
    sizes = ends - starts
    same = sizes == sizes[other]
    a, b, n = starts[same], starts[other][same], sizes[same]
    before = np.cumsum(n) - n
    at = np.arange(int(n.sum())) + np.repeat(a - before, n)
    differ = values[at] != values[at + np.repeat(b - a, n)]
    bad = np.bincount(np.repeat(np.flatnonzero(same), n)[differ], minlength=len(starts)) > 0
    return same & ~bad


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of true cells that do not cross a bound: starts and ends."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = bounds[1:-1]
    cut = edge[(edge > 0) & (edge < n)]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def owner(positions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The text in which each flat position lies."""
    return np.searchsorted(bounds, positions, side="right") - 1


def byte_chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_CHARS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch in slices of about one chunk: the slice, the UTF-8 bytes of its texts (null: none) and their bounds."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):  # a few rows at a time are copied
            batch = whole.slice(at, SLICE_ROWS)
            texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
            bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
            a = 0
            while a < len(texts):
                b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + limit, side="right")) - 1)
                yield batch.slice(a, b - a), data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                a = b


PRIME = (1 << 31) - 1
_POINTS = (0x4F1BBCDD, 0x2C9277B5)  # where the two polynomials are taken


def _mod(x: np.ndarray) -> np.ndarray:
    """Modulo PRIME, by folding; below 2**62."""
    p, shift = np.uint64(PRIME), np.uint64(31)
    x = (x & p) + (x >> shift)
    x = (x & p) + (x >> shift)
    return np.where(x >= p, x - p, x)


FIELD_CELLS = (1 << 18) + 1  # powers kept at least; a worker keeps four lists of them
_field: dict[int, np.ndarray] = {}


def field_powers(base: int, n: int) -> np.ndarray:
    """base**i modulo PRIME for i < n."""
    if base not in _field or len(_field[base]) < n:
        size, p = max(n, FIELD_CELLS), np.ones(1, dtype=np.uint64)
        while len(p) < size:
            p = np.concatenate([p, _mod(p[: size - len(p)] * np.uint64(pow(base, len(p), PRIME)))])
        _field[base] = p
    return _field[base][:n]


class FieldHashes:
    """62-bit hashes of any spans of one array of bytes: two polynomials over the field of PRIME elements.

    Unlike sums modulo a power of two, they have no words that meet for every base.
    """

    _table = mix(np.arange(1, 257, dtype=np.uint64)) % np.uint64(PRIME)

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums, self.back = [], []
        values = self._table[data]
        for point in _POINTS:
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_mod(values * field_powers(point, n)), out=sums[1:])
            self.sums.append(sums)
            self.back.append(field_powers(pow(point, -1, PRIME), n + 1))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        one, two = (_mod(_mod(s[ends] - s[starts]) * b[starts]) for s, b in zip(self.sums, self.back, strict=True))
        return mix((one << np.uint64(31) | two) + mix((ends - starts).astype(np.uint64)))


class SpanHashes:
    """64-bit hashes of any spans of one array of bytes, for spans of a few hundred bytes.

    Sums modulo a power of two have words of a thousand letters that meet for
    every base: ``FieldHashes`` is for spans of any length.
    """

    _table = mix(np.arange(1, 257, dtype=np.uint64))

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self._table[data] * powers(_BASE, n), out=self.sums[1:])
        self.back = powers(pow(_BASE, -1, 1 << 64), n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """Of every window of ``size`` bytes."""
        if len(self.sums) <= size:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])
