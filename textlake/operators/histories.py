"""The ordered history of each key as arrays.

A history is cut into parts of `max_entries` entries, numbered by `part`, that follow
one another in history order and lose nothing; most histories are part 0 alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.workspace import land

# 100,000 entries are about 5 MB as a stored document, a third of the 16 MB that
# a document store takes.
MAX_ENTRIES = 100_000

ENTRY = ("date", "rank", "views")


def article_histories(df: DataFrame, key: str, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """Columns key, ``part``, and the arrays date, views and rank of each part.

    Entries are sorted by date, rank and views; part p holds the entries from
    p * max_entries on, whatever other keys have. The three arrays of a part always
    have the same length, NULLs included. A job runs at once.

    No key is gathered anywhere. Equal entries are interchangeable, so they are
    counted instead of moved. The distinct ones are range-partitioned in history
    order, which cuts a large key into slices of the size of a partition. The offset
    of an entry is then the sum over the earlier slices of its key, one row each,
    plus the running sum within its slice. The slices are landed, as both sums must
    see the same bounds.
    """
    counted = df.groupBy(key, *ENTRY).agg(F.count(F.lit(1)).alias("copies"))
    slice_ = F.struct(F.col(key).alias("key"), F.spark_partition_id().alias("number"))
    cells = land(
        counted.repartitionByRange(key, *ENTRY).withColumn("slice", slice_).drop(key), "slices")

    before = (Window.unboundedPreceding, -1)
    in_key = Window.partitionBy("slice.key").orderBy("slice.number").rowsBetween(*before)
    in_slice = Window.partitionBy("slice").orderBy(*ENTRY).rowsBetween(*before)
    slices = (
        cells.groupBy("slice").agg(F.sum("copies").alias("entries"))
        .select("slice", F.coalesce(F.sum("entries").over(in_key), F.lit(0)).alias("slice_start"))
    )
    # As structs, two slices of the NULL key are equal.
    start = F.col("slice_start") + F.col("in_slice")
    placed = (
        cells
        .withColumn("in_slice", F.coalesce(F.sum("copies").over(in_slice), F.lit(0)))
        .join(slices, "slice")
        .select(F.col("slice.key").alias(key), *ENTRY,
                start.alias("start"), (start + F.col("copies")).alias("end"))
    )

    # A run of copies may reach over several parts; each takes its share.
    first, last = (F.expr(f"{p} div {max_entries}") for p in ("start", "(end - 1)"))
    low = F.greatest("start", F.col("part") * max_entries)
    high = F.least("end", (F.col("part") + 1) * max_entries)
    shares = (
        placed
        .withColumn("part", F.explode(F.sequence(first, last)))
        .select(key, "part", F.struct(*ENTRY, (high - low).cast("int").alias("copies")).alias("run"))
    )
    return (
        shares.groupBy(key, "part")
        .agg(F.array_sort(F.collect_list("run")).alias("runs"))
        .select(key, "part", F.flatten(F.transform(
            "runs",
            lambda run: F.array_repeat(
                F.struct(*[run[c].alias(c) for c in ENTRY]), run["copies"]),
        )).alias("entries"))
        .select(key, "part", *[F.col(f"entries.{c}").alias(c) for c in ("date", "views", "rank")])
    )
