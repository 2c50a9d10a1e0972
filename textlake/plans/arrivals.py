"""Deduplication of a corpus that arrives in files, one after another.

The first row of a key among all files is the first among the first rows of each file, so
an arrival leaves only its own first rows, one for each key, and these are deduplicated again
when they are read. An arrival costs what its own rows cost, whatever came before; which
files came together, and in which order, makes no difference.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from textlake.operators import deduplicate_df


def add_arrival(
    rows: DataFrame,
    path: str,
    arrival: str,
    subset_columns: Sequence[str],
    order_by_column: str,
    keep: str = "first",
    tie_breakers: Sequence[str] = (),
) -> None:
    """Keep the winners of `rows` below `path`, in a folder named after the `arrival`.

    The same arrival again takes the place of its first one, so it may be repeated.
    """
    winners = deduplicate_df(rows, subset_columns, order_by_column, keep, tie_breakers)
    name = urllib.parse.quote(arrival, safe="")
    winners.write.mode("overwrite").parquet(f"{path.rstrip('/')}/arrival={name}")


def winners_of_arrivals(
    spark: SparkSession,
    path: str,
    subset_columns: Sequence[str],
    order_by_column: str,
    keep: str = "first",
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """One row per key of all arrivals below `path`: what `deduplicate_df` keeps of all their rows.

    Give the columns and order that the arrivals were added with, and an order that
    leaves no ties, or else any of the tied rows stays.
    """
    return deduplicate_df(spark.read.parquet(path).drop("arrival"), subset_columns, order_by_column, keep, tie_breakers)
