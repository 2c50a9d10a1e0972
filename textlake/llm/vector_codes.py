"""Compression of vectors to a few bytes: product codes with exact nearest entries.

Components become integers, vectors are cut into equal parts, and each part is
replaced by the number of its codebook's nearest entry. Codebooks start as the parts
of the rows with the smallest ids and are fitted by some rounds of assigning all rows
and replacing each entry by the mean of its parts.

The nearest entry is found by slices and bitmasks. For each dimension the entries'
coordinates are sorted, and each place in that order carries the mask of the entries
before it. The entries next to a part in each dimension give it a first distance,
whose root is the radius. Two binary searches per dimension turn the radius into a range
of places; the two prefix masks differ in the entries inside it. The masks of all
dimensions, joined by AND over uint64 words, leave exactly the entries in the box of that
radius, and so every entry as near as the first one. Only these are measured in full.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm import text as T
from textlake.workspace import land

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components of rows times entries that are compared at once.
_COMPARED = 1 << 22


def largest_component(width: int) -> int:
    """Integers up to this, and their negatives, have distances over `width` dimensions below 2**63."""
    return math.isqrt((2**63 - 1) // max(width, 1)) // 2


class Nearest:
    """Finds the nearest rows of `entries` (n, width), ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable").T
        self.places = np.ascontiguousarray(np.sort(entries, axis=0).T)
        self.order = order
        prefix = np.zeros((width, n + 1, -(-n // 64)), np.uint64)
        for d in range(width):
            prefix[d, np.arange(1, n + 1), order[d] // 64] = np.uint64(1) << (order[d] % 64).astype(np.uint64)
        self.prefix = np.bitwise_or.accumulate(prefix, axis=1)

    def _radius(self, x: np.ndarray) -> np.ndarray:
        """The whole root of the least distance to the entries next to x in each dimension."""
        n, width = self.entries.shape
        best = np.full(len(x), np.iinfo(np.int64).max)
        for d in range(width):
            at = np.minimum(np.searchsorted(self.places[d], x[:, d]), n - 1)
            away = x - self.entries[self.order[d, at]]
            np.minimum(best, (away * away).sum(axis=1), out=best)
        root = np.sqrt(best.astype(np.float64)).astype(np.int64)
        root -= root > best // np.maximum(root, 1)
        return root + ((root + 1) <= best // (root + 1))

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The (len(x), words) masks of the entries within the radius in every dimension."""
        masks = np.full((len(x), self.prefix.shape[2]), np.iinfo(np.uint64).max, np.uint64)
        for d in range(x.shape[1]):
            low = np.searchsorted(self.places[d], x[:, d] - radius, "left")
            high = np.searchsorted(self.places[d], x[:, d] + radius, "right")
            masks &= self.prefix[d, high] ^ self.prefix[d, low]
        return masks

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of x the index of the nearest entry and the squared distance."""
        index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        rows = max(1, _COMPARED // self.entries.size)
        for first in range(0, len(x), rows):
            part = x[first : first + rows]
            masks = self.candidates(part, self._radius(part))
            held = np.unpackbits(masks.astype("<u8").view(np.uint8), axis=1, bitorder="little")
            row, entry = np.nonzero(held)
            away = part[row] - self.entries[entry]
            far = (away * away).sum(axis=1)
            least = np.minimum.reduceat(far, np.searchsorted(row, np.arange(len(part))))
            hits = np.flatnonzero(far == least[row])
            index[first : first + rows] = entry[hits[np.searchsorted(row[hits], np.arange(len(part)))]]
            distance[first : first + rows] = least
        return index, distance


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(1024 * x) of the rows' components, as (n, width)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    most = largest_component(-(-width // PARTS))
    return np.clip(np.floor(flat * SCALE), -most, most).astype(np.int64)


def _assigned(x: np.ndarray, finders: list[Nearest]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and distances (n, PARTS)."""
    found = [f.find(part) for f, part in zip(finders, np.split(x, PARTS, axis=1), strict=True)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(books: np.ndarray):
    """Counts and component sums of the parts of each entry, a row for each that a task has met."""

    @T.task("vector-codes")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n, width = books.shape
        finders = [Nearest(book) for book in books]
        counts, sums = np.zeros((parts, n), np.int64), np.zeros((parts, n, width), np.int64)
        for batch in batches:
            x = integers(batch.column("vector"), parts * width)
            codes, _ = _assigned(x, finders)
            for p, part in enumerate(np.split(x, parts, axis=1)):
                counts[p] += np.bincount(codes[:, p], minlength=n)
                np.add.at(sums[p], codes[:, p], part)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(counts.reshape(-1)[met], pa.int64()), pa.array(list(sums.reshape(-1, width)[met]), pa.list_(pa.int64()))],
            ["cell", "n", "sums"],
        )

    return run


def _codes(books: np.ndarray):
    @T.task("vector-codes")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [Nearest(book) for book in books]
        for batch in batches:
            codes, far = _assigned(integers(batch.column("vector"), books.shape[0] * books.shape[2]), finders)
            text = pa.array([bytes(row).hex() for row in codes.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), text, pa.array(far.sum(axis=1))], ["row", "code", "error"])

    return run


def fit(vectors: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (PARTS, entries, width) after `rounds` rounds over all rows (vector), from the rows `first`.

    A round is one scan; a task sends a row for each entry it has met, which are added
    up before the driver gets the means, as many as the codebooks have components.
    """
    books = np.stack(np.split(first, PARTS, axis=1))
    for _ in range(rounds):
        sums = vectors.mapInArrow(_sums(books), "cell int, n long, sums array<bigint>")
        total = F.sum(F.col("x").cast("decimal(38,0)"))
        cells = sums.select("cell", "n", F.posexplode("sums").alias("at", "x")).groupBy("cell", "at").agg(F.sum("n").alias("n"), total.alias("total"))
        means = books.copy().reshape(-1, books.shape[2])
        for cell, at, n, s in cells.collect():
            means[cell, at] = int(s) // n
        books = means.reshape(books.shape)
    return books


def compress(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(row, code, error) of each usable row, and the codebooks (PARTS, entries, width).

    `row` is the whole row as a struct, whatever its columns are called; `vectors` has
    vec_id and the column `vector`, and is scanned once a round. `code` has two hex
    digits a part, `error` is the squared distance from the row's integers to the
    entries, summed over parts.

    A row is left out if its vector is null or has null or non-finite components. The
    codebooks start with the 256 rows of smallest vec_id, of rows with one vec_id in the
    order of their vectors, fewer if there are no more; a row without vec_id is coded and
    counts for the means, but starts no entry. The first of them sets the length; a
    vector of another length, or any if that is not a multiple of 4 or zero, has null for code and
    error and counts for nothing. Components whose distances could pass 64 bits
    (beyond some 300,000 at 16 dimensions a part) count as the largest allowed. An
    empty table gives empty codebooks. What a task holds does not grow with its rows.
    """
    rows = vectors.select(F.struct(F.col("*")).alias("row"), F.col("vec_id").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.coalesce(F.expr("vector is not null and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"), F.lit(False)))
    first = [r.vector for r in rows.where("id is not null").orderBy("id", "vector").limit(ENTRIES).select("vector").collect()]
    width = len(first[0]) if first else 0
    schema = T.row_schema(rows, "code string, error long")
    if not width or width % PARTS:
        blank = rows.select("row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return blank, np.zeros((PARTS, 0, 0), np.int64)
    start = integers(pa.array([v for v in first if len(v) == width], pa.list_(pa.float64())), width)
    fits = rows.where(F.size("vector") == width)
    books = fit(fits.select("vector"), start, rounds)
    coded = fits.select("row", "vector").mapInArrow(_codes(books), schema)
    other = rows.where(F.size("vector") != width).select("row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(other), books


def decode(codes: list[str], books: np.ndarray) -> np.ndarray:
    """The vectors that codes stand for, (n, dimensions), in the unit of the input."""
    index = np.array([list(bytes.fromhex(c)) for c in codes], np.int64).reshape(-1, len(books))
    return np.concatenate([book[index[:, p]] for p, book in enumerate(books)], axis=1) / SCALE


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each usable row of `vectors` (vec_id, label, `vector`).

    label_error is the error summed over the rows of equal label, nulls together, as
    many as 2**63 - 1 at most. See `compress` for which rows are usable.
    """
    coded, books = compress(vectors, vector)
    coded = land(coded.select("row.vec_id", "row.label", "code", "error"), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    labels = land(coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "label-errors")
    out = coded.join(labels, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
