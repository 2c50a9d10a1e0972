"""Benchmark items inside documents: MinHash containment search by size class.

A document holds an item if it has 75 % or more of the item's distinct 5-word
shingles. An ordinary signature of a long document says nothing about a short item
(their Jaccard similarity is near 0), so the sketch is taken of the items: the k
smallest of their shingles in a random order (bottom-k MinHash). Items are
partitioned by size; in the class of 2**c to 2**(c + 1) - 1 shingles, u being the
latter, k is floor(u / 4) + 1. A document that holds the item lacks at most
floor(u / 4) of its shingles, so one of the k is in it: the search loses nothing.
Classes too large for a document are left out for it. Each find is confirmed by the
exact share of shingles, in the same task, as the document's shingles are there.

Documents are neither shuffled nor joined: each task holds an index of the items. It
is broadcast in parts of about `INDEX_SHINGLES` shingles (16 bytes each), whose number
is taken from a count; every part is searched in a pass of its own, whatever the size.
Items of equal shingles are one set of the index, however many ids have it; a join
gives a found set its ids afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm import text as T
from textlake.workspace import land

PERCENT = 75
INDEX_SHINGLES = 1_000_000


def sketch_size(n: int) -> int:
    """Shingles in the sketch of an item of n shingles, by the bound of its size class."""
    bound = (1 << n.bit_length()) - 1
    return min(n, bound - -(-bound * PERCENT // 100) + 1)


class Index:
    """Distinct sets of shingles by the hashes of their sketches."""

    def __init__(self, set_ids: list[int], sets: list[np.ndarray]):
        self.set_ids, self.sets = set_ids, sets
        hashes, owners = [], []
        for i, own in enumerate(sets):
            order = np.argsort(T.mix(own ^ np.uint64(0x5851F42D4C957F2D)), kind="stable")
            hashes.append(own[order[: sketch_size(len(own))]])
            owners.append(np.full(len(hashes[-1]), i))
        hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], np.concatenate([np.zeros(0, np.int64), *owners])[order]
        self.least = np.array([1 << (len(s).bit_length() - 1) for s in sets], np.int64)

    def find(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(text, place of the set, shared shingles) of every set that a text holds."""
        if not len(self.hashes):
            return []
        shingles, offsets = T.shingles(texts)
        low = np.searchsorted(self.hashes, shingles)
        hit = np.flatnonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == shingles)
        # one hash may stand for several items
        n = np.searchsorted(self.hashes, shingles[hit], "right") - low[hit]
        text = np.repeat(np.searchsorted(offsets, hit, "right") - 1, n)
        run = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = self.owners[np.repeat(low[hit], n) + run]
        sizes = np.diff(offsets)
        fits = 100 * sizes[text] >= PERCENT * self.least[item]
        out = []
        for t, i in np.unique(np.stack([text[fits], item[fits]], axis=1), axis=0).tolist():
            own = self.sets[i]
            shared = int(np.isin(own, shingles[offsets[t] : offsets[t + 1]]).sum())
            if 100 * shared >= PERCENT * len(own):
                out.append((t, i, shared))
        return out


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in T.slices(batch, "text"):
            sets = T.shingle_sets(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["item_id", "n", "shingles"],
            )


def _item_table(items: DataFrame) -> DataFrame:
    """(item_id, n, shingles) of the distinct items that have shingles."""
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return land(items.mapInArrow(_item_sets, "item_id long, n long, shingles array<bigint>").where("n > 0").distinct(), "items")


def _numbered(items: DataFrame) -> DataFrame:
    """(set_id, n, shingles) of the distinct sets of `_item_table`."""
    return land(items.select("n", "shingles").distinct().withColumn("set_id", F.monotonically_increasing_id()), "item-sets")


def _indexes(sets: DataFrame) -> Iterator:
    """The index of `_numbered` sets, broadcast in parts."""
    spark = sets.sparkSession
    total = sets.agg(F.sum("n")).first()[0] or 0
    n_parts = -(-total // INDEX_SHINGLES)
    for k in range(n_parts):
        part = sets.where(F.pmod(F.xxhash64("set_id"), F.lit(n_parts)) == k).toArrow()
        lists = [np.array(x, np.int64).view(np.uint64) for x in part["shingles"].to_pylist()]
        yield spark.sparkContext.broadcast(Index(part["set_id"].to_pylist(), lists))


FINDS = "doc_id long, set_id long, n_item long, n_shared long"


def find_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of each row of `docs` and distinct item it holds.

    n_item is the item's number of distinct shingles, n_shared those in the document.
    An item of fewer than five words is one shingle, found where it is the whole text.
    Null, empty or blank texts and items match nothing. Rows with equal or null ids are
    reported each with its id; an item row that repeats (id and words) counts once.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = docs.sparkSession.createDataFrame([], FINDS)
    items = _item_table(items)
    sets = _numbered(items)
    for index in _indexes(sets):

        @T.task("decontamination")
        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            own = index.value
            for batch in batches:
                for part in T.slices(batch, "text"):
                    rows = own.find(part.column("text"))
                    ids = part.column("doc_id").take(pa.array([t for t, _, _ in rows], pa.int64()))
                    columns = [[own.set_ids[i] for _, i, _ in rows], [len(own.sets[i]) for _, i, _ in rows], [s for _, _, s in rows]]
                    yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", "set_id", "n_item", "n_shared"])

        found = found.unionByName(docs.mapInArrow(search, FINDS))
    # one row a set against its items, so that a set of many ids can be split
    ids = land(items.join(sets.select("set_id", "shingles"), "shingles").select("set_id", "item_id"), "item-ids")
    return found.join(ids, "set_id").select("doc_id", "item_id", "n_item", "n_shared")


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns."""
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").cast("string").alias("text"))
    schema = T.row_schema(rows, "text string")
    for index in _indexes(_numbered(_item_table(items))):

        @T.task("decontamination")
        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in T.slices(batch, "text"):
                    keep = np.ones(part.num_rows, bool)
                    keep[[t for t, _, _ in index.value.find(part.column("text"))]] = False
                    yield part.filter(pa.array(keep))

        rows = rows.mapInArrow(clean, schema)
    return rows.select(*[F.col(f"row.`{c}`") for c in columns])
