"""Row counts and data-quality figures, each from one pass over its input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.functions import counted_views, is_view_count, title_key
from textlake.plans.tables import unreadable
from textlake.schemas import KEY


def _rows(condition=None):
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def pageview_quality(raw: DataFrame) -> DataFrame:
    """One row about a raw pageview table.

    raw_rows, kept_rows, corrupt_rows; overflow_rows: counts too long for a long;
    bad_date_rows and bad_rank_rows: rows, kept ones too, whose date or rank could
    not be read (0 for a table that `read_pageviews` did not flag); empty_key_rows: titles of punctuation only; distinct_titles, distinct_keys:
    their difference is the number of titles that share a key with another one.
    Overflows, empty keys, titles and keys are about the kept rows.
    """
    kept = F.coalesce(is_view_count("views"), F.lit(False))
    bad = {c: F.col(c) if c in raw.columns else F.lit(False) for c in ("bad_date", "bad_rank")}
    per_title = raw.groupBy("article").agg(
        _rows().alias("raw_rows"),
        _rows(kept).alias("kept_rows"),
        _rows(kept & counted_views("views").isNull()).alias("overflow_rows"),
        *[_rows(flag).alias(f"{c}_rows") for c, flag in bad.items()],
    )
    seen = F.col("kept_rows") > 0
    key = F.when(seen, title_key("article"))
    return per_title.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
          for c in ("raw_rows", "kept_rows", "overflow_rows", "bad_date_rows", "bad_rank_rows")],
        F.coalesce(F.sum(F.when(key == "", F.col("kept_rows"))), F.lit(0)).alias("empty_key_rows"),
        F.count(F.when(seen, F.col("article"))).alias("distinct_titles"),
        F.count_distinct(key).alias("distinct_keys"),
    ).select(
        "raw_rows", "kept_rows", (F.col("raw_rows") - F.col("kept_rows")).alias("corrupt_rows"),
        "overflow_rows", "bad_date_rows", "bad_rank_rows", "empty_key_rows", "distinct_titles", "distinct_keys",
    )


def corpus_counts(articles: DataFrame) -> DataFrame:
    """before_rows and after_rows of deduplicating `articles` on the key."""
    per_key = articles.groupBy(KEY).agg(_rows().alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before_rows"), _rows().alias("after_rows"))


def corrupt_records(raw: DataFrame) -> DataFrame:
    """total_rows and corrupt_rows of a corpus read by `read_articles`."""
    return raw.agg(
        _rows().alias("total_rows"),
        _rows(unreadable()).alias("corrupt_rows"),
    )


def pageview_files(raw: DataFrame) -> DataFrame:
    """One row per file of a table that `read_pageviews` read with `file`.

    file, raw_rows, kept_rows, corrupt_rows, and of all rows those flagged: bad_date_rows,
    bad_rank_rows, recovered_rows, lost_rows (0 for flags that the table does not have).
    A file without rows has none here.
    """
    kept = F.coalesce(is_view_count("views"), F.lit(False))
    flags = ("bad_date", "bad_rank", "recovered", "lost")
    return raw.groupBy("file").agg(
        _rows().alias("raw_rows"), _rows(kept).alias("kept_rows"), _rows(~kept).alias("corrupt_rows"),
        *[_rows(F.col(c) if c in raw.columns else F.lit(False)).alias(f"{c}_rows") for c in flags],
    )


def article_files(raw: DataFrame) -> DataFrame:
    """file, total_rows and corrupt_rows per file of a corpus that `read_articles` read with `file`."""
    return raw.groupBy("file").agg(_rows().alias("total_rows"), _rows(unreadable()).alias("corrupt_rows"))
