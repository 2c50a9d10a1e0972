"""Numpy helpers over Arrow batches of texts: slices by bytes, words, shingles.

A text is seen as its UTF-8 bytes, A-Z lowered; words are runs of bytes other than
space and 0x09 to 0x0D. Words and shingles stand for themselves as 64-bit hashes.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructType

U64 = np.uint64
SHINGLE_WORDS = 5

#: Bytes handled at once; a single text may be longer and is then cut at white space.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.Generator(np.random.PCG64(2024)).integers(1, 2**63, 256).astype(U64)
_LOWERED = _BYTE[_LOWER]
_BASE = U64(0x9E3779B97F4A7C15)
_WORD_WEIGHTS = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=U64,
)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers, one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Bytes of an Arrow batch between Spark and its Python workers.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, as 10,000 rows of text may be any size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_held: dict[str, Callable[[], None]] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def trim() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def _give_back() -> None:
    """Let go of what helpers keep, as workers wait for their next task beside a busy JVM."""
    _POWERS.up = _POWERS.down = np.ones(1, U64)
    trim()


def task(operator: str, release: Callable[[], None] = lambda: None):
    """Marks what an operator runs over a partition's batches.

    Python workers serve one operator after another. As a task begins, what other
    operators keep from task to task is let go of (their `release`).
    """

    def wrap(function):
        @functools.wraps(function)
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            others = [name for name in _held if name != operator]
            for name in others:
                _held.pop(name)()
            if others:
                gc.collect()
                _give_back()
            _held[operator] = release
            try:
                yield from function(batches)
            finally:
                _give_back()

        return run

    return wrap


def row_schema(rows: DataFrame, others: str) -> StructType:
    """The struct `row` of `rows`, whatever its columns are called, and other columns."""
    return StructType([rows.schema["row"], *DataType.fromDDL(others).fields])


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = powers(_BASE, n)
            self.down = powers(U64(pow(int(_BASE), -1, 1 << 64)), n)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most `limit` bytes of text, a longer text alone."""
    texts = batch.column(column)
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for i, n in enumerate(lengths):
        if total + n > limit and i > start:
            yield batch.slice(start, i - start)
            total, start = 0, i
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the n + 1 offsets; a null text is empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _hash_words(data: np.ndarray, first: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words; `first` marks bytes that open a text."""
    solid = ~_SPACE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1] | first[1:]
    starts = np.flatnonzero(opens)
    closes = solid.copy()
    closes[:-1] &= ~solid[1:] | first[1:]
    ends = np.flatnonzero(closes) + 1
    up, down = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((_LOWERED if lower else _BYTE)[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts, ends


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, start and end bytes of all words, and the n + 1 offsets of each text's words."""
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    cuts = [0]
    while len(data) - cuts[-1] > 2 * SLICE_BYTES:
        at = cuts[-1] + SLICE_BYTES
        while at < len(data) and not _SPACE[data[at]]:
            space = np.flatnonzero(_SPACE[data[at : at + SLICE_BYTES]])
            at = at + int(space[0]) if len(space) else min(at + SLICE_BYTES, len(data))
        cuts.append(at)
    parts = [_hash_words(data[a:b], first[a:b], lower) for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True) if b > a]
    hashes = np.concatenate([np.zeros(0, U64), *[h for h, _, _ in parts]])
    starts, ends = (np.concatenate([np.zeros(0, np.int64), *[part[k] + a for part, a in zip(parts, cuts, strict=False)]]) for k in (1, 2))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def shingles(texts: pa.Array, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of `size` words, in order, and the n + 1 offsets of each text's.

    A text of fewer words has its whole sequence as one; one without words has none.
    """
    hashes, _, _, offsets = words(*text_bytes(texts))
    return word_shingles(hashes, offsets, size)


def word_shingles(hashes: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    n_words = np.diff(offsets)
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    padded = np.concatenate([hashes, np.zeros(size, U64)])
    weights = _WORD_WEIGHTS if size == SHINGLE_WORDS else mix(np.arange(1, size + 1, dtype=U64))
    runs = np.zeros(len(hashes), U64)
    for k in range(size):
        runs += padded[k : k + len(hashes)] * weights[k]
    out_offsets = np.concatenate([[0], np.cumsum(counts)])
    take = np.arange(out_offsets[-1]) + np.repeat(offsets[:-1] - out_offsets[:-1], counts)
    out = runs[take]
    for i in np.flatnonzero((n_words > 0) & (n_words < size)):
        own = hashes[offsets[i] : offsets[i + 1]]
        out[out_offsets[i]] = (own * weights[: len(own)]).sum(dtype=U64) + U64(len(own))
    return mix(out), out_offsets


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    hashes, offsets = shingles(texts, size)
    return [np.unique(hashes[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
