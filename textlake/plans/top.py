"""Top article of a period, for one period or for all of them.

A period is a range of dates, not a condition on its year and month, so that it
reaches the Parquet scan. On a rankings table with a `year` folder column the
same period also prunes folders. Ties go to the smaller article name; a period
without data gives no row. Totals are decimals of 38 digits.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.operators import deduplicate_df
from textlake.schemas import KEY


def _within(rankings: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    rows = rankings.where(F.col("date").between(F.lit(first), F.lit(last)))
    if "year" in rankings.columns:
        rows = rows.where(F.col("year").between(first.year, last.year))
    return rows


def _totals(rankings: DataFrame, *period: str) -> DataFrame:
    # a sum of longs may not fit one; 38 digits hold any number of rows there can be
    total = F.sum(F.col("views").cast("decimal(28,0)")).alias("total_views")
    return rankings.groupBy(*period, KEY).agg(total).where(F.col("total_views").isNotNull())


def _top_total(rankings: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    totals = _totals(_within(rankings, first, last))
    return totals.orderBy(F.desc("total_views"), KEY).limit(1)


def top_article_of_day(rankings: DataFrame, date: dt.date | str) -> DataFrame:
    """article_name, views, rank of the article ranked first on `date`.

    If the first-ranked row of that day was corrupt there is no row, rather than
    the article ranked second.
    """
    day = dt.date.fromisoformat(date) if isinstance(date, str) else date
    first = _within(rankings, day, day).where(F.col("rank") == 1)
    return first.select(KEY, "views", "rank").orderBy(KEY).limit(1)


def top_article_of_month(rankings: DataFrame, year: int, month: int) -> DataFrame:
    """year, month, article_name, total_views of the most viewed article."""
    valid = dt.MINYEAR <= year <= dt.MAXYEAR and 1 <= month <= 12
    if valid:
        last = calendar.monthrange(year, month)[1]
        top = _top_total(rankings, dt.date(year, month, 1), dt.date(year, month, last))
    else:
        top = _totals(rankings.where(F.lit(False)))
    return top.select(
        F.lit(year).alias("year"), F.lit(month).alias("month"), KEY, "total_views")


def top_article_of_year(rankings: DataFrame, year: int) -> DataFrame:
    """year, article_name, total_views of the most viewed article."""
    if dt.MINYEAR <= year <= dt.MAXYEAR:
        top = _top_total(rankings, dt.date(year, 1, 1), dt.date(year, 12, 31))
    else:
        top = _totals(rankings.where(F.lit(False)))
    return top.select(F.lit(year).alias("year"), KEY, "total_views")


def top_articles_by_day(rankings: DataFrame) -> DataFrame:
    """The first-ranked article of every day that has one."""
    first = rankings.where(F.col("rank") == 1).select("date", KEY, "views", "rank")
    return deduplicate_df(first, ["date"], KEY)


def _top_by(rankings: DataFrame, **period) -> DataFrame:
    names = list(period)
    totals = _totals(rankings.withColumns(period), *names)
    top = deduplicate_df(totals, names, "total_views", keep="last", tie_breakers=[KEY])
    return top.select(*names, KEY, "total_views")


def top_articles_by_month(rankings: DataFrame) -> DataFrame:
    """The most viewed article of every month."""
    return _top_by(rankings, year=F.year("date"), month=F.month("date"))


def top_articles_by_year(rankings: DataFrame) -> DataFrame:
    """The most viewed article of every year."""
    return _top_by(rankings, year=F.year("date"))
