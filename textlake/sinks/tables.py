"""Parquet / JSON tables, laid out so that the read queries skip most of them.

Rankings and their roll-up are read by period. Rankings are range-partitioned and sorted by date, so
that row-group statistics skip other days. Range bounds come from a sample and go
on to the rank and the key, so a crowded day spreads over several files. The other
two tables are read by key: each file of a load holds a range of keys, sorted, so that its
statistics rule it out for all other keys, and a bloom filter does so within the range.

A sample reads its input once more, so the input is landed first. Who gives a landed
table, or a projection of one, says so with `landed`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from textlake.schemas import KEY
from textlake.workspace import land, temporary

_KEY_INDEX = {
    f"parquet.bloom.filter.enabled#{KEY}": True,
    "parquet.bloom.filter.adaptive.enabled": True,
}


#: Mode of a table in folders by year: the years of the input take the place of the stored ones.
REPLACE_YEARS = "replace_years"


def _by_year(df: DataFrame, mode: str) -> DataFrameWriter:
    """A writer of one folder per year. With `REPLACE_YEARS` the folders that the input has rows
    for are replaced when the job commits, all others stay as they are."""
    writer = df.write.partitionBy("year")
    if mode != REPLACE_YEARS:
        return writer.mode(mode)
    return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def _ranged(df: DataFrame, order: list[str], landed: bool) -> DataFrame:
    """`df` cut into ranges of `order`; what makes it runs once."""
    return (df if landed else land(df, "unsorted")).repartitionByRange(*order)


def write_rankings(rankings: DataFrame, path: str, mode: str = "append", landed: bool = False) -> None:
    """One folder per year, sorted by day and rank inside it.

    With mode ``replace_years`` the load of a period can be repeated or corrected: give all
    rows of its years. Rows without a date are a folder of their own.
    """
    order = ["date", "rank", KEY]
    with temporary(rankings.sparkSession):
        ranged = _ranged(rankings, order, landed).withColumn("year", F.year("date"))
        _by_year(ranged.sortWithinPartitions("year", *order), mode).parquet(path)


def write_months(months: DataFrame, path: str, mode: str = "append") -> None:
    """The roll-up of `plans.month_totals`, one folder per year, sorted by month and key.

    Appended rows are merged by their readers; ``replace_years`` as in `write_rankings`.
    Adaptive execution makes files of like size, and splits a large year.
    """
    dealt = months.hint("rebalance", "year").sortWithinPartitions("year", "month", KEY)
    _by_year(dealt, mode).options(**_KEY_INDEX).parquet(path)


def write_analytics(analytics: DataFrame, path: str, mode: str = "append", landed: bool = False) -> None:
    """One row per article, in files by ranges of the key."""
    with temporary(analytics.sparkSession):
        ranged = _ranged(analytics, [KEY], landed).sortWithinPartitions(KEY)
        ranged.write.mode(mode).options(**_KEY_INDEX).parquet(path)


def write_documents(
    documents: DataFrame, path: str, mode: str = "append", source: str = "parquet", landed: bool = False
) -> None:
    """One nested record per document; `source` is ``parquet`` or ``json``.

    Parquet files hold ranges of key and part. JSON has no statistics to lay rows out for,
    so its files are sorted each by itself.
    """
    order = [c for c in (KEY, "part") if c in documents.columns]
    if source != "parquet":
        documents.sortWithinPartitions(*order).write.mode(mode).format(source).save(path)
        return
    with temporary(documents.sparkSession):
        ranged = _ranged(documents, order, landed).sortWithinPartitions(*order)
        ranged.write.mode(mode).options(**_KEY_INDEX).parquet(path)
