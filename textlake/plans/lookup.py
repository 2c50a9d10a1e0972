"""Lookups of single articles and small views of a table."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.functions import title_key
from textlake.schemas import KEY


def _article(df: DataFrame, title: str) -> DataFrame:
    # The key of a literal folds to a constant, which is pushed to the scan.
    return df.where(F.col(KEY) == title_key(F.lit(title)))


def lookup_document(documents: DataFrame, title: str) -> DataFrame:
    """The document of an article, given its title or its key: its parts in order.

    Parts that a document store keeps only as blanks are left out.
    """
    return _article(documents, title).where((F.col("part") == 0) | (F.size("date") > 0)).orderBy("part")


def lookup_analytics(analytics: DataFrame, title: str) -> DataFrame:
    """The summary statistics of an article, given its title or its key."""
    return _article(analytics, title).select(
        KEY, "avg_views", "max_views", "best_rank",
        F.col("total_days_ranked").alias("total_days_tracked"),
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first `n` rows in a given order."""
    return df.orderBy(*order).limit(n)


def sample_document(documents: DataFrame, seed: int | None = None) -> DataFrame:
    """One document chosen at random, all its parts in order.

    The draw depends on the seed and the key only: the same seed gives the same
    document however the table is partitioned, and a long history is drawn no more
    often than a short one. A NULL key is drawn as an empty one.
    """
    if seed is None:
        seed = random.getrandbits(63)
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(KEY, F.lit(""))))
    key = documents.where("part = 0").orderBy(draw, KEY).limit(1).select(F.struct(KEY).alias("drawn"))
    # as a struct, so that the NULL key equals itself
    parts = documents.withColumn("drawn", F.struct(KEY)).join(key, "drawn", "left_semi")
    return parts.drop("drawn").orderBy("part")
