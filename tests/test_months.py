"""The roll-up by month, and loads that are repeated."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from textlake import plans, sinks, sources
from textlake.schemas import MONTHS, RANKINGS

VIEWS = "article string, article_name string, views long, date date, rank int"


def made(seed, n=400):
    rnd = random.Random(seed)
    start = dt.date(2019, 11, 20)
    return [
        (k, k, rnd.choice([None, rnd.randint(0, 10**6), 9_223_372_036_854_775_807 if rnd.random() < 0.05 else 3]),
         rnd.choice([None, *[start + dt.timedelta(rnd.randint(0, 80)) for _ in range(9)]]), rnd.choice([None, 1, 2, 30]))
        for k in rnd.choices(["a", "b", "", None, "c"], k=n)
    ]


def expected(rows):
    out = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        views, ranks = [r[2] for r in own if r[2] is not None], [r[4] for r in own if r[4] is not None]
        out[key] = (sum(views) / len(views) if views else None, max(views, default=None), min(ranks, default=None), len({r[3] for r in own if r[3]}))
    return out


@pytest.mark.parametrize("loads", [1, 2, 7])
def test_any_split_into_loads(spark, tmp_path, loads):
    rows = made(loads)
    for k in range(loads):
        load = spark.createDataFrame(rows[k::loads], VIEWS).repartition(3)
        sinks.write_months(plans.month_totals(load), str(tmp_path / "months"))
    months = sources.read_table(spark, str(tmp_path / "months"), MONTHS)
    got = {r.article_name: (r.avg_views, r.max_views, r.best_rank, r.total_days_ranked) for r in plans.analytics_of_months(months).collect()}
    want = expected(rows)
    assert set(got) == set(want)
    assert all(got[k][1:] == want[k][1:] and got[k][0] == pytest.approx(want[k][0], rel=1e-15) for k in want)
    once = plans.month_totals(spark.createDataFrame(rows, VIEWS))
    assert sorted(map(str, plans.merge_months(months).collect())) == sorted(map(str, once.collect()))
    assert plans.merge_months(months).schema.names == MONTHS.names and once.schema.names == MONTHS.names


def test_no_rows_and_no_views(spark):
    empty = plans.month_totals(spark.createDataFrame([], VIEWS))
    assert plans.analytics_of_months(empty).count() == 0 and plans.top_of_month(empty, 2020, 1).count() == 0
    blank = plans.month_totals(spark.createDataFrame([("a", "a", None, dt.date(2020, 1, 1), None)], VIEWS))
    assert [tuple(r) for r in plans.analytics_of_months(blank).collect()] == [("a", None, None, None, 1)]
    assert plans.top_of_years(blank).count() == 0


def test_ties_go_to_the_smaller_name(spark):
    day = dt.date(2020, 1, 31)
    months = plans.month_totals(spark.createDataFrame([("b", "b", 5, day, 1), ("a", "a", 5, day, 2)], VIEWS))
    assert plans.top_of_month(months, 2020, 1).collect() == [(2020, 1, "a", 5)]
    assert plans.top_of_years(months).collect() == [(2020, "a", 5)]


def test_totals_read_one_folder(spark, tmp_path):
    path = str(tmp_path / "months")
    sinks.write_months(plans.month_totals(spark.createDataFrame(made(3), VIEWS)), path)
    months = sources.read_table(spark, path, MONTHS)
    for top in (plans.top_of_month(months, 2020, 1), plans.top_of_year(months, 2020)):
        text = plan(top)
        assert "PartitionFilters: [isnotnull(year" in text and "= 2020)]" in text
        assert "views" not in text.split("ReadSchema")[1].split("\n")[0].replace("total_views", "")
    # a statistic of many rows a month takes one shuffle
    assert plan(plans.analytics_of_months(months)).count("Exchange hashpartitioning") == 1


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_other_years_are_not_touched(spark, tmp_path):
    path = str(tmp_path / "rankings")
    rows = [(f"t{i}", i, "low", dt.date(2018 + i % 3, 5, 1 + i % 20), 1) for i in range(90)] + [("none", 1, "low", None, 1)]
    ranked = spark.createDataFrame(rows, RANKINGS)
    sinks.write_rankings(ranked, path)
    before = files(path)
    corrected = ranked.where(F.year("date") == 2019).withColumn("views", F.col("views") + 1)
    for _ in range(2):
        sinks.write_rankings(corrected, path, sinks.REPLACE_YEARS)
        stored = sources.read_table(spark, path).select(*RANKINGS.names)
        want = ranked.where("date is null or year(date) <> 2019").unionByName(corrected)
        assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect()))
    after = files(path)
    assert {f: t for f, t in before.items() if "year=2019" not in f} == {f: t for f, t in after.items() if "year=2019" not in f}
    assert not {f for f in before if "year=2019" in f} & set(after)
    # nothing to load replaces nothing
    sinks.write_rankings(ranked.where("false"), path, sinks.REPLACE_YEARS)
    assert files(path) == after
