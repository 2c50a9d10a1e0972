"""A roll-up of the pageviews by article and month, from which totals and statistics follow.

A row is a state that can be merged: counts and sums add up, extremes stay extremes, and
the days of the month that an article was ranked on are the bits of a number, so that
COUNT DISTINCT needs neither the days nor another shuffle. New days are added as further rows
(`sinks.write_months` appends them); nothing that is stored is read again for that.
Readers merge the rows they need, so several rows of a month mean their sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.operators import deduplicate_df
from textlake.schemas import ANALYTICS, KEY, MONTHS

_PERIOD = ("year", "month")


def month_totals(pageviews: DataFrame) -> DataFrame:
    """One row per article and month in the layout of `schemas.MONTHS`.

    Rows without a date make a row without year and month. Combined before the
    shuffle, so an article of any size is safe.
    """
    day = F.expr("shiftleft(1, day(date) - 1)")
    return pageviews.groupBy(KEY, F.year("date").alias("year"), F.month("date").alias("month")).agg(
        # a sum of longs may not fit one; 38 digits hold any number of rows there can be
        F.sum(F.col("views").cast("decimal(28,0)")).alias("total_views"),
        F.count("views").alias("n_views"),
        F.max("views").alias("max_views"),
        F.min("rank").alias("best_rank"),
        F.coalesce(F.bit_or(day), F.lit(0)).alias("days"),
    ).select(*MONTHS.names)


def _merged() -> list[Column]:
    return [F.sum("total_views").alias("total_views"), F.sum("n_views").alias("n_views"), F.max("max_views").alias("max_views"),
            F.min("best_rank").alias("best_rank"), F.bit_or("days").alias("days")]


def merge_months(months: DataFrame) -> DataFrame:
    """One row per article and month of a table that may have several."""
    return months.groupBy(KEY, *_PERIOD).agg(*_merged()).select(*MONTHS.names)


def analytics_of_months(months: DataFrame) -> DataFrame:
    """The statistics of `plans.analytics`, from the roll-up.

    One shuffle, by article: a row per month and load is all that an article has, and
    the months are merged where they meet.
    """
    merged = months.repartition(KEY).groupBy(KEY, *_PERIOD).agg(*_merged())
    mean = F.sum("total_views").cast("double") / F.nullif(F.sum("n_views"), F.lit(0))
    return merged.groupBy(KEY).agg(
        mean.alias("avg_views"), F.max("max_views").alias("max_views"), F.min("best_rank").alias("best_rank"),
        F.sum(F.bit_count("days")).cast("long").alias("total_days_ranked"),
    ).select(*ANALYTICS.names)


def _top(months: DataFrame, *period: str) -> DataFrame:
    totals = months.groupBy(*period, KEY).agg(F.sum("total_views").alias("total_views")).where("total_views is not null")
    return deduplicate_df(totals, list(period), "total_views", keep="last", tie_breakers=[KEY]).select(*period, KEY, "total_views")


def top_of_month(months: DataFrame, year: int, month: int) -> DataFrame:
    """year, month, article_name, total_views of the most viewed article, from one year's folder."""
    return _top(months.where((F.col("year") == year) & (F.col("month") == month)), *_PERIOD)


def top_of_year(months: DataFrame, year: int) -> DataFrame:
    """year, article_name, total_views of the most viewed article, from one year's folder."""
    return _top(months.where(F.col("year") == year), "year")


def top_of_months(months: DataFrame) -> DataFrame:
    """The most viewed article of every month; as in `top_articles_by_month`, ties go to the smaller name."""
    return _top(months, *_PERIOD)


def top_of_years(months: DataFrame) -> DataFrame:
    """The most viewed article of every year."""
    return _top(months, "year")
