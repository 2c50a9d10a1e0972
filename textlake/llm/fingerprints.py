"""SimHash fingerprints of whole texts, and the search for all within a Hamming radius.

The terms of a text are its runs of two words; a text of one word is one term. Each
occurrence votes with its length in bytes (long terms are the rarer ones) for or
against each of 128 bits, by the bits of its hash. The fingerprint is the sign of the
sums; likeness is the share of equal bits. A text without words has all bits 0.

Search by permuted block tables: the bits are cut into `radius + 1` blocks, so two
fingerprints within the radius agree in one block at least. Table t holds the
fingerprints with block t brought to the front; a query looks at its entry in each
table, and every find is confirmed on all bits. Equal fingerprints are one entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm import text as T
from textlake.workspace import land

BITS = 128
RADIUS = 4
#: On sf0.01 pairs at a 5-word Jaccard of 0.75 or more are 8 to 22 bits apart, unlike texts 33 at least.
NEAR_RADIUS = 24
#: Query fingerprints in one broadcast; fingerprints compared at once.
_QUERIES = 1 << 18
_TILE = 1 << 17
_TERMS = 16_384


def fingerprints(texts: pa.Array) -> np.ndarray:
    """(n, 2) unsigned 64-bit halves of each text's fingerprint."""
    hashes, starts, ends, offsets = T.words(*T.text_bytes(texts))
    terms, term_offsets = T.word_shingles(hashes, offsets, 2)
    counts = np.diff(term_offsets)
    owner = np.repeat(np.arange(len(texts)), counts)
    first_word = np.arange(len(terms)) + np.repeat(offsets[:-1] - term_offsets[:-1], counts)
    last_word = np.minimum(first_word + 1, offsets[1:][owner] - 1)
    weight = (ends[last_word] - starts[first_word]).astype(np.int32)
    both = np.stack([terms, T.mix(terms ^ np.uint64(0x2545F4914F6CDD1D))], axis=1)
    votes = np.zeros((len(texts), BITS), np.int64)
    for a in range(0, len(terms), _TERMS):
        own, w = owner[a : a + _TERMS], weight[a : a + _TERMS]
        bits = np.unpackbits(both[a : a + _TERMS].view(np.uint8), axis=1)
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        votes[own[heads]] += 2 * np.add.reduceat(bits * w[:, None], heads, axis=0).astype(np.int64) - np.add.reduceat(w, heads)[:, None]
    return np.packbits(votes > 0, axis=1).view(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits of fingerprints, row by row."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def edited(text: str, following: str) -> str:
    """`text` with its last half (rounded down) replaced by as much of the beginning of `following`."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows(texts: list[str], following: list[str], prints: np.ndarray, next_prints: np.ndarray) -> list[pa.Array]:
    new = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    new_prints = fingerprints(pa.array(new, pa.large_string()))
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
        *(pa.array([x.tobytes().hex() for x in p], pa.string()) for p in (prints, new_prints)),
        pa.array(likeness(prints, new_prints), pa.float64()),
        pa.array(likeness(prints, next_prints), pa.float64()),
        *(pa.array(prints[:, k].view(np.int64), pa.int64()) for k in (0, 1)),
    ]


MEASURES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "high", "low"]
_TYPES = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, high long, low long"


@T.task("fingerprints")
def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text measured against the one after it; the partition's ends go out as they are."""
    part = TaskContext.get().partitionId()
    names = ["doc_id", *MEASURES, "part", "edge", "text"]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, *[pa.int64()] * 2, pa.int32(), pa.string(), pa.string()]

    def edge(which: str, doc_id, text: str) -> pa.RecordBatch:
        values = [doc_id, *[None] * len(MEASURES), part, which, text]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    held = None  # (doc_id, text, fingerprint) of the last text so far
    for batch in batches:
        for rows in T.slices(batch, "text"):
            column = rows.column("text").fill_null("")
            ids, texts, prints = rows.column("doc_id").to_pylist(), column.to_pylist(), fingerprints(column)
            if held is None:
                yield edge("first", ids[0], texts[0])
            else:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], np.concatenate([held[2], prints])
            held = ids[-1], texts[-1], prints[-1:]
            if len(ids) > 1:
                n = len(ids) - 1
                blank = [pa.array([part] * n, pa.int32()), *[pa.nulls(n, pa.string())] * 2]
                yield pa.RecordBatch.from_arrays([pa.array(ids[:-1], pa.int64()), *_rows(texts[:-1], texts[1:], prints[:-1], prints[1:]), *blank], names)
    if held is not None:
        yield edge("last", held[0], held[1])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in T.slices(batch, "text"):
            texts, following = (rows.column(c).to_pylist() for c in ("text", "following"))
            prints, next_prints = (fingerprints(pa.array(t, pa.large_string())) for t in (texts, following))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *_rows(texts, following, prints, next_prints)], ["doc_id", *MEASURES])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, high, low) of each row; `high` and `low` are the fingerprint's halves.

    The next document is the one of next smaller doc_id, after the last the first. A
    null text is an empty one. Rows of one doc_id stand in the order of their texts,
    from the largest; rows without doc_id come last. A sole row follows itself. Other
    columns are not read.

    Texts are shuffled once, into ranges of ids. Only the first and last text of a
    range meet those of its neighbours, in a join of two rows per range.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    ranged = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)
    table = land(ranged.mapInArrow(_in_order, f"doc_id long, {_TYPES}, part int, edge string, text string"), "fingerprints")
    inner = table.where("edge is null").select("doc_id", *MEASURES)
    firsts = table.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    # the range after each one: as many rows as there were tasks
    parts = table.where("edge = 'first'").select("part")
    after = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    lasts = table.where("edge = 'last'").select("part", "doc_id", "text").join(parts.select("part", after.alias("next_part")), "part").join(firsts, "next_part")
    return inner.unionByName(lasts.select("doc_id", "text", "following").mapInArrow(_pairs, f"doc_id long, {_TYPES}"))


def within_radius(queries: DataFrame, entries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(high, low, n_near): for each distinct query fingerprint the number of entry rows within `radius`.

    Both tables have `high` and `low`; rows where one is null are left out. An entry
    equal to the query counts too.
    """
    if not 0 <= radius < BITS // 2:
        raise ValueError("radius must be from 0 to 63")
    borders = np.linspace(0, BITS, radius + 2).astype(int).tolist()

    def block(t: int) -> Column:
        """Bits borders[t] to borders[t + 1], counted from the lowest of `low`, as one long."""
        a, b = borders[t], borders[t + 1]
        parts = []
        for half, base in (("low", 0), ("high", 64)):
            x, y = max(a - base, 0), min(b - base, 64)
            if x < y:
                bits = F.shiftrightunsigned(F.col(half), x)
                if y - x < 64:
                    bits = bits.bitwiseAND(F.lit((1 << (y - x)) - 1))
                parts.append(bits)
        return parts[0] if len(parts) == 1 else F.xxhash64(*parts)

    def tables(prints: DataFrame, *extra: str) -> DataFrame:
        entry = F.array(*[F.struct(F.lit(t).alias("t"), block(t).alias("key")) for t in range(radius + 1)])
        return prints.select("high", "low", *extra, F.explode(entry).alias("e")).select("high", "low", *extra, "e.t", "e.key")

    asked = tables(queries.select("high", "low").dropna().distinct())
    distinct = entries.select("high", "low").dropna().groupBy("high", "low").agg(F.count("*").alias("n"))
    known = tables(distinct, "n").withColumnsRenamed({"high": "e_high", "low": "e_low"})
    apart = F.bit_count(F.col("high").bitwiseXOR(F.col("e_high"))) + F.bit_count(F.col("low").bitwiseXOR(F.col("e_low")))
    near = asked.join(known, ["t", "key"]).where(apart <= radius)
    # a pair is met in every table where it agrees, and counted in one
    once = near.groupBy("high", "low", "e_high", "e_low").agg(F.first("n").alias("n"))
    return once.groupBy("high", "low").agg(F.sum("n").alias("n_near"))


_FOUND = "high long, low long, n_found long, found array<string>"


def _halves(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.stack([rows.column(c).to_numpy().view(np.uint64) for c in ("high", "low")], axis=1)


def _near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The indexes of all pairs of a row of `a` and one of `b` within `radius`, by tiles; those of `a` ascend in each."""
    (a_high, a_low), (b_high, b_low) = (np.ascontiguousarray(x.T) for x in (a, b))
    width = max(1, min(len(b), 4096))
    height = max(1, _TILE // width)
    mixed = np.empty((height, width), np.uint64)
    bits, more = np.empty((2, height, width), np.uint8)
    for i in range(0, len(a), height):
        for j in range(0, len(b), width):
            at = slice(min(height, len(a) - i)), slice(min(width, len(b) - j))
            x, n, m = mixed[at], bits[at], more[at]
            np.bitwise_count(np.bitwise_xor(a_high[i : i + height, None], b_high[None, j : j + width], out=x), out=n)
            np.bitwise_count(np.bitwise_xor(a_low[i : i + height, None], b_low[None, j : j + width], out=x), out=m)
            np.add(n, m, out=n)
            if n.min() <= radius:
                first, second = np.nonzero(n <= radius)
                yield first + i, second + j


def near_classes(queries: DataFrame, entries: DataFrame, radius: int = NEAR_RADIUS) -> DataFrame:
    """(high, low, n_found, found): for each distinct query fingerprint the number of entry
    rows within `radius`, and their distinct fingerprints in hex, sorted.

    Tables and nulls are as in `within_radius`. All is found, an equal entry too.
    """
    if not 0 <= radius <= BITS:
        raise ValueError("radius must be from 0 to 128")
    spark = queries.sparkSession
    asked = land(queries.select("high", "low").dropna().distinct(), "asked-fingerprints")
    classes = land(entries.select("high", "low").dropna().groupBy("high", "low").agg(F.count("*").alias("n")), "fingerprint-classes")
    n_parts = -(-asked.count() // _QUERIES)
    near = spark.createDataFrame([], _FOUND)
    for k in range(n_parts):
        part = asked.where(F.pmod(F.xxhash64("high", "low"), F.lit(n_parts)) == k).toArrow()
        sent = spark.sparkContext.broadcast(_halves(part))

        @T.task("fingerprints")
        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                prints, n = _halves(batch), batch.column("n").to_numpy()
                names = np.array([x.tobytes().hex() for x in prints], object)
                for query, entry in _near_pairs(own, prints, radius):
                    heads = np.flatnonzero(np.diff(query, prepend=-1))
                    ends = pa.array(np.append(heads, len(query)), pa.int32())
                    found = pa.ListArray.from_arrays(ends, pa.array(names[entry], pa.string()))
                    which = own[query[heads]].view(np.int64)
                    columns = [pa.array(which[:, 0]), pa.array(which[:, 1]), pa.array(np.add.reduceat(n[entry], heads)), found]
                    yield pa.RecordBatch.from_arrays(columns, ["high", "low", "n_found", "found"])

        near = near.unionByName(classes.mapInArrow(search, _FOUND))
    return near.groupBy("high", "low").agg(F.sum("n_found").alias("n_found"), F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
