"""The clean tables and the three data products made of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake import schemas
from textlake.functions import counted_views, popularity_bucket
from textlake.operators import (
    add_column,
    article_histories,
    basic_preprocessing,
    deduplicate_df,
    df_join,
    groupby_expr,
    keep_matching,
)
from textlake.operators.histories import MAX_ENTRIES
from textlake.schemas import KEY
from textlake.workspace import land


def clean_pageviews(raw: DataFrame) -> DataFrame:
    """article, views (long), date, rank and the key, without corrupt rows.

    A count of more digits than a long holds becomes NULL here, once, instead of
    failing each later cast; `pageview_quality` counts these rows.
    """
    columns = ["article", "views", "date", "rank"]
    clean = basic_preprocessing(raw, columns, "article", KEY)
    return clean.withColumn("views", counted_views("views"))


def unreadable() -> Column:
    """True for a record that could not be parsed, and so has no name."""
    return F.col(schemas.CORRUPT).isNotNull() & F.col("name").isNull()


def clean_articles(
    raw: DataFrame, columns: Sequence[str] = ("name", "description", "url", "abstract")
) -> DataFrame:
    """Readable records of the corpus with the key of their name."""
    if schemas.CORRUPT in raw.columns:
        raw = raw.where(~unreadable())
    return basic_preprocessing(raw, list(columns), "name", KEY)


# Behind the first column, so that which article stays never depends on the run.
ARTICLE_ORDER = ("name", "description", "abstract")


def unique_articles(
    articles: DataFrame, order_by: str = "url", tie_breakers: Sequence[str] = ARTICLE_ORDER
) -> DataFrame:
    """One article per key: the one with the smallest url, then name and texts."""
    return deduplicate_df(articles, [KEY], order_by, tie_breakers=tie_breakers)


def rankings(pageviews: DataFrame) -> DataFrame:
    """One row per article and day with its popularity bucket."""
    bucketed = add_column(pageviews, "popularity_bucket", popularity_bucket("views"))
    return bucketed.select(*schemas.RANKINGS.names)


def analytics(pageviews: DataFrame) -> DataFrame:
    """One row per article: mean and peak views, best rank, days ranked."""
    return groupby_expr(pageviews, KEY, [
        "avg(views) AS avg_views",
        "max(views) AS max_views",
        "min(rank) AS best_rank",
        "count(DISTINCT date) AS total_days_ranked",
    ])


def viewed_keys(pageviews: DataFrame) -> DataFrame:
    """The distinct keys, landed, so that Catalyst knows their size."""
    return land(pageviews.select(KEY).distinct(), "viewed-keys")


def article_documents(
    pageviews: DataFrame,
    articles: DataFrame,
    max_entries: int = MAX_ENTRIES,
    order_by: str = "url",
    tie_breakers: Sequence[str] = ARTICLE_ORDER,
    viewed_only: bool = False,
) -> DataFrame:
    """One document per viewed article: ordered history arrays and article text.

    A document is a row for each `max_entries` entries of its history, numbered by
    `part`; the texts are in each. `pageviews` is read twice, so give a stored table.
    The corpus is cut down to the viewed articles before it is shuffled, unless it
    is `viewed_only` already. Histories are joined after they are gathered.
    """
    histories = article_histories(pageviews, KEY, max_entries)
    if not viewed_only:
        articles = keep_matching(articles, viewed_keys(pageviews), [KEY])
    # The parts of a hot key meet in this join. They can be spread over tasks only
    # if the other side has a shuffle of its own.
    texts = land(unique_articles(articles, order_by, tie_breakers).select(KEY, "description", "url", "abstract"), "texts")
    return df_join(histories, texts, [KEY]).select(*schemas.DOCUMENTS.names)
