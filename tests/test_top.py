"""Top articles of a period: ties, gaps, bounds, and agreement of both forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from textlake.plans import (
    analytics,
    clean_pageviews,
    lookup_analytics,
    preview,
    rankings,
    top_article_of_day,
    top_article_of_month,
    top_article_of_year,
    top_articles_by_day,
    top_articles_by_month,
    top_articles_by_year,
)
from textlake.plans.top import _totals


@pytest.fixture(scope="module")
def ranked(spark):
    rnd = random.Random(5)
    rows = []
    for offset in range(0, 800, 3):
        day = dt.date(2015, 12, 1) + dt.timedelta(offset)
        for rank in range(1, 6):
            bad = rank == 1 and offset % 2
            rows.append((rnd.choice("ABCDE"), day, "n/a" if bad else str(rnd.randint(1, 9)), rank))
    raw = spark.createDataFrame(rows, "article string, date date, views string, rank int")
    return rankings(clean_pageviews(raw)).cache()


def one(df):
    rows = df.collect()
    assert len(rows) <= 1
    return rows[0] if rows else None


def test_day(ranked):
    by_day = {r.date: r for r in top_articles_by_day(ranked).collect()}
    for offset in range(0, 30, 3):
        day = dt.date(2015, 12, 1) + dt.timedelta(offset)
        got, batch = one(top_article_of_day(ranked, day.isoformat())), by_day.get(day)
        assert (got is None) == bool(offset % 2) == (batch is None)
        if got:
            assert tuple(got) == (batch.article_name, batch.views, batch["rank"])


def test_months_and_years_agree_with_the_batch_form(ranked):
    months = top_articles_by_month(ranked).collect()
    assert len(months) == len({(r.year, r.month) for r in months}) == 27
    for r in months[::6]:
        assert one(top_article_of_month(ranked, r.year, r.month)) == r
    years = top_articles_by_year(ranked).collect()
    assert sorted(r.year for r in years) == [2015, 2016, 2017, 2018]
    for r in years:
        assert one(top_article_of_year(ranked, r.year)) == r


def test_totals_of_months_and_years_are_the_same(ranked):
    dated = ranked.withColumns({"year": F.year("date"), "month": F.month("date")})
    months = _totals(dated, "year", "month")
    years = months.groupBy("year", "article_name").agg(F.sum("total_views").alias("total_views"))
    assert sorted(years.collect()) == sorted(_totals(dated, "year").collect())


@pytest.mark.parametrize("year, month", [(2031, 1), (2016, 13), (2016, 0), (0, 1), (99999, 1)])
def test_no_data_is_no_row(ranked, year, month):
    assert one(top_article_of_month(ranked, year, month)) is None
    if month == 1:
        assert one(top_article_of_year(ranked, year)) is None


def test_last_day_of_the_calendar(spark):
    df = spark.createDataFrame(
        [("a", 1, "low", dt.date(9999, 12, 31), 1)],
        "article_name string, views long, popularity_bucket string, date date, rank int")
    assert one(top_article_of_month(df, 9999, 12)).total_views == 1
    assert one(top_article_of_year(df, 9999)).total_views == 1


def test_ties_go_to_the_smaller_name_and_null_totals_never_win(spark):
    day = dt.date(2020, 2, 29)
    df = spark.createDataFrame(
        [("b", 5, "low", day, 1), ("a", 5, "low", day, 2), ("0", None, "high", day, 3)],
        "article_name string, views long, popularity_bucket string, date date, rank int")
    assert one(top_article_of_month(df, 2020, 2)).article_name == "a"
    assert one(top_articles_by_year(df)).article_name == "a"
    only_null = df.where("views IS NULL")
    assert one(top_article_of_year(only_null, 2020)) is None
    assert one(top_articles_by_month(only_null)) is None


def test_totals_beyond_a_long(spark):
    day, most = dt.date(2020, 1, 1), 2**63 - 1
    df = spark.createDataFrame(
        [("a", most, "high", day, 1), ("a", most, "high", day, 2), ("b", most, "high", day, 1)],
        "article_name string, views long, popularity_bucket string, date date, rank int")
    for top in (top_article_of_month(df, 2020, 1), top_article_of_year(df, 2020), top_articles_by_month(df), top_articles_by_year(df)):
        assert (one(top).article_name, int(one(top).total_views)) == ("a", 2 * most)


def test_two_first_ranks_on_a_day(spark):
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame(
        [("b", 5, "low", day, 1), ("a", 4, "low", day, 1)],
        "article_name string, views long, popularity_bucket string, date date, rank int")
    assert one(top_article_of_day(df, day)) == ("a", 4, 1)
    assert one(top_articles_by_day(df)) == (day, "a", 4, 1)


def test_analytics_lookup_takes_title_or_key(ranked):
    stats = analytics(ranked)
    assert one(lookup_analytics(stats, " (A)_")) == one(lookup_analytics(stats, "a"))
    assert lookup_analytics(stats, "a").columns[-1] == "total_days_tracked"
    assert one(lookup_analytics(stats, "absent")) is None
    assert stats.where("best_rank < 1").isEmpty()


def test_preview(ranked):
    assert preview(ranked, ["date", "rank"], 3).count() == 3
