"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

A document is the set of its distinct 5-word shingles; two are linked if their sets'
Jaccard similarity is 0.75 or more. Equal sets are collapsed first. A SuperMinHash
signature (O. Ertl, 2017) draws for each shingle a random permutation of the slots,
and for the j-th slot of it the rank j + r with r in [0, 1); a slot keeps its least
rank. Ranks are correlated, which lowers the estimate's variance, and step j can be
left out once all slots hold less than j: long documents need two or three steps.

Documents that agree in a band of `ROWS` slots share a bucket. A pair at 0.75 misses
all 32 bands with probability (1 - 0.75^4)^32 = 5e-6. Pairs are confirmed on the full
sets. Not all pairs of a bucket are formed, as a pair that is already in one component
needs no test: each document is held against one of its buckets' smallest members
first, then the members of buckets that still hold several components against one
drawn from them, and at last all members of different components against each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm import text as T
from textlake.llm.components import components
from textlake.workspace import land

SLOTS, ROWS = 128, 4
THRESHOLD = 75
#: Rounds in which each open bucket is held against a member drawn from it.
PIVOT_ROUNDS = 1
_ELEMENTS = 16_384
_LOW = np.uint64(0xFFFFFFFF)
_STEP = 0x9E3779B97F4A7C15


def super_minhash(elements: np.ndarray, owner: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """The (n, slots) signatures; `owner` says whose each element is. Ranks in units of 2**-32."""
    ranks = np.full((n, slots), np.uint64(slots) << np.uint64(32))
    flat = ranks.reshape(-1)
    for first in range(0, len(elements), _ELEMENTS):
        x, of = elements[first : first + _ELEMENTS], owner[first : first + _ELEMENTS]
        places = np.tile(np.arange(slots, dtype=np.uint8), (len(x), 1))
        for j in range(slots):
            open_ = ranks.max(axis=1) >= np.uint64(j) << np.uint64(32) if j else np.ones(n, bool)
            live = open_[of]
            if not live.all():
                x, of, places = x[live], of[live], places[live]
            if not len(x):
                break
            draw = T.mix(x + np.uint64((j + 1) * _STEP & (1 << 64) - 1))
            k = j + (((draw >> np.uint64(32)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.intp)
            row = np.arange(len(x))
            slot = places[row, k]
            places[row, k] = places[:, j]
            np.minimum.at(flat, of * slots + slot, (draw & _LOW) + (np.uint64(j) << np.uint64(32)))
    return ranks


def band_keys(ranks: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One number for each band of `rows` slots, different from band to band."""
    n, slots = ranks.shape
    grouped = ranks[:, : slots // rows * rows].reshape(n, -1, rows)
    keys = np.arange(1, grouped.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(rows):
        keys = T.mix(keys + grouped[:, :, k] * np.uint64(0xA0761D6478BD642F))
    return keys.view(np.int64)


@T.task("near-dedup")
def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.slices(batch, "text"):
            sets = T.shingle_sets(part.column("text"))
            sizes = np.array([len(s) for s in sets])
            ranks = super_minhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array(list(band_keys(ranks)), pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_key", "buckets"],
            )


@T.task("near-dedup")
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.slices(batch, "text"):
            sets = [s.view(np.int64) for s in T.shingle_sets(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])


def _similar(x: str, y: str) -> Column:
    """Are the sets of two columns similar enough?"""
    shared = F.size(F.array_intersect(x, y)).cast("long")
    return 100 * shared >= THRESHOLD * (F.size(x) + F.size(y) - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return both.where(_similar("set_a", "set_b")).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable over links, itself included; kept
    says that it is the row's own. A null, empty or blank text has no shingles and no
    links. Rows with one doc_id are versions of one document: they share its links. A
    row without doc_id links nothing, its component_id is null and it is not kept.
    Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketch = land(docs.mapInArrow(_sketch, "doc_id long, n_shingles long, set_key binary, buckets array<bigint>"), "sketch")
    linkable = sketch.where("n_shingles > 0 and doc_id is not null")
    distinct = land(linkable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets")), "distinct-sets")
    members = distinct.select(F.explode("buckets").alias("bucket"), "rep", "n")
    pivots = members.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last"), F.min_by("n", "rep").alias("pivot_n")).where("pivot < last").drop("last")
    shared = land(members.join(pivots, "bucket"), "shared-buckets")

    ids = shared.select(F.col("rep").alias("doc_id")).distinct()
    sets = land(docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, shingles array<bigint>"), "sets")

    def size_fits(x: str, y: str) -> Column:
        return F.expr(f"100 * least({x}, {y}) >= {THRESHOLD} * greatest({x}, {y})")

    # each document against the smallest member that it shares most buckets with
    star = shared.where((F.col("rep") != F.col("pivot")) & size_fits("n", "pivot_n"))
    star = star.groupBy(F.col("pivot").alias("a"), F.col("rep").alias("b")).agg(F.count("*").alias("weight"))
    best = star.groupBy("b").agg(F.max_by("a", F.struct("weight", -F.col("a"))).alias("a")).select("a", "b")
    links = land(_confirmed(best, sets), "links")

    def open_buckets() -> DataFrame:
        """The buckets that hold several components, each member with its own."""
        found = components(links).withColumnRenamed("node", "rep")
        rows = shared.select("bucket", "rep", "n").join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        several = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
        return land(rows.join(several, "bucket", "left_semi"), "open-buckets")

    for k in range(PIVOT_ROUNDS):
        rows = open_buckets()
        drawn = rows.groupBy("bucket").agg(F.min_by(F.struct("rep", "n", "component"), F.xxhash64("rep", "bucket", F.lit(k))).alias("pivot"))
        pairs = rows.join(drawn, "bucket").where((F.col("component") != F.col("pivot.component")) & size_fits("n", "pivot.n"))
        pairs = pairs.select(F.least("rep", "pivot.rep").alias("a"), F.greatest("rep", "pivot.rep").alias("b")).distinct()
        links = links.unionByName(land(_confirmed(pairs, sets), "links"))

    # what is left: every member outside its bucket's largest component against those of others;
    # the join's condition is the comparison itself, so that only links come out of it
    rows = open_buckets()
    sized = rows.groupBy("bucket", "component").agg(F.count("*").alias("members"))
    largest = sized.groupBy("bucket").agg(F.max_by("component", F.struct("members", "component")).alias("largest"))
    members = rows.join(largest, "bucket").join(sets.toDF("rep", "set"), "rep").join(distinct.select("rep", "buckets"), "rep")
    own = ("rep", "n", "component", "set", "buckets")
    minor = members.where("component <> largest").select("bucket", *[F.col(c).alias(f"a_{c}") for c in own])
    other = members.select(F.col("bucket").alias("b_bucket"), "largest", *[F.col(c).alias(f"b_{c}") for c in own])
    crossing = F.expr("bucket = b_bucket and a_component <> b_component and (b_component = largest or a_rep < b_rep)") & size_fits("a_n", "b_n")
    # in one of the buckets that a pair shares
    crossing = crossing & (F.array_intersect("a_buckets", "b_buckets")[0] == F.col("bucket"))
    pairs = minor.join(other, crossing & _similar("a_set", "b_set"))
    links = links.unionByName(land(pairs.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b")).distinct(), "links"))
    found = components(links)

    rep_of = distinct.select("set_key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    plain = sketch.select("doc_id", "n_shingles", "set_key")
    linked = plain.where("n_shingles > 0 and doc_id is not null").join(rep_of, "set_key").drop("set_key")
    alone = plain.where("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
