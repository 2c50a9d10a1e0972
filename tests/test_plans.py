"""Physical plans: what is pushed, pruned, pre-aggregated and split."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from checks.queries import QUERIES
from textlake import schemas, sinks, sources
from textlake.operators import article_histories, deduplicate_df, df_join, keep_matching
from textlake.plans import (
    article_documents,
    lookup_document,
    top_article_of_month,
    top_articles_by_month,
    viewed_keys,
)
from textlake.workspace import land

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): str(v) for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextlib.contextmanager
def written(monkeypatch):
    """The plans of everything that is written inside the block."""
    plans = []
    for how in ("parquet", "json", "csv", "text", "save"):
        def write(self, *args, original=getattr(DataFrameWriter, how), **kwargs):
            plans.append(plan(self._df))
            return original(self, *args, **kwargs)
        monkeypatch.setattr(DataFrameWriter, how, write)
    yield plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name, monkeypatch):
    """In the returned plan and in those of all that is written on the way."""
    with written(monkeypatch) as plans:
        plans.append(plan(QUERIES[name](spark, SF)))
    for text in plans:
        # the one row of each of two reports, side by side
        nodes = ["Python", "Pandas"] + ["CartesianProduct", "BroadcastNestedLoopJoin"] * (name != "corpus_quality")
        assert not [node for node in nodes if node in text]


@pytest.mark.parametrize("how", ["right", "full"])
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_joins_have_unmatched_rows_on_both_sides(spark, how, sf):
    rows = QUERIES[f"orders_join_{how}"](spark, f"/root/testdata/{sf}")
    assert rows.where("views IS NULL AND name IS NOT NULL").count() > 10
    assert rows.where("article_name IS NULL").count() > 2
    if how == "full":
        assert rows.where("views IS NOT NULL AND url IS NULL").count() > 10
    copies = rows.where("views IS NOT NULL AND url IS NOT NULL").groupBy("article_name").agg(
        F.count_distinct("url").alias("urls"), F.count_distinct("date").alias("days"))
    assert copies.where("urls > 1 AND days > 1").count() > 5


@pytest.mark.parametrize("name", ["stored_top_day", "stored_top_month", "stored_top_year", "top_year_sql"])
def test_stored_periods_skip_folders_and_row_groups(spark, name):
    text = plan(QUERIES[name](spark, SF))
    partition = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "year#" in partition and "1997" in partition
    assert "GreaterThanOrEqual(date,1997-" in text and "LessThanOrEqual(date,1997" in text


def test_stored_lookup_is_pushed(spark):
    assert "EqualTo(article_name,smallring)" in plan(QUERIES["stored_lookup_analytics"](spark, SF))


@pytest.fixture(scope="module")
def rankings(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "rankings")
    days = [dt.date(2015, 1, 1) + dt.timedelta(17 * i) for i in range(200)]
    rows = [(f"t{i % 9}", i, "low", d, 1) for i, d in enumerate(days)]
    sinks.write_rankings(spark.createDataFrame(rows, schemas.RANKINGS), path)
    return sources.read_table(spark, path)


def test_a_period_prunes_folders_and_reaches_the_scan(rankings):
    text = plan(top_article_of_month(rankings, 2017, 9))
    assert "TakeOrderedAndProject" in text
    assert "GreaterThanOrEqual(date,2017-09-01), LessThanOrEqual(date,2017-09-30)" in text
    partition = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "(year#" in partition and ">= 2017)" in partition and "<= 2017)" in partition
    assert "ReadSchema: struct<article_name:string,views:bigint,date:date>" in text


def test_lookup_is_pushed_as_an_equality(spark, tmp_path):
    path = str(tmp_path / "documents")
    rows = [(f"t{i}", 0, [], [], [], None, None, None) for i in range(50)]
    sinks.write_documents(spark.createDataFrame(rows, schemas.DOCUMENTS), path)
    found = lookup_document(sources.read_table(spark, path), "T-7")
    assert "EqualTo(article_name,t7)" in plan(found)
    assert found.count() == 1


def test_ordered_dedup_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(deduplicate_df(df, ["k"], "id"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_batch_top_limits_before_the_shuffle(rankings):
    text = plan(top_articles_by_month(rankings))
    assert text.count("WindowGroupLimit") == 2


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; the other side has one row per key."""
    id_ = F.col("id")
    left = land(
        spark.range(300_000).select(
            F.when(id_ % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), id_ % 5000)).alias("k"),
            id_.alias("x"), F.sha2(id_.cast("string"), 256).alias("payload")), "left")
    right = land(
        spark.range(5100).select(
            F.when(id_ == 0, "hot").otherwise(F.concat(F.lit("k"), id_)).alias("k"),
            (id_ * 2).alias("y")), "right")
    return left, right


SKEW = dict(
    spark__sql__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="512KB",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
    spark__sql__adaptive__advisoryPartitionSizeInBytes="512KB",
    spark__sql__shuffle__partitions=16,
)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_a_hot_key_is_split(spark, skewed, how):
    left, right = skewed
    with settings(spark, **SKEW):
        joined = df_join(left, right, ["k"], how)
        rows = joined.collect()
        assert "skew=true" in plan(joined)
        expected = left.join(right, ["k"], how).collect()
    assert sorted(map(str, rows)) == sorted(map(str, expected))


def test_the_parts_of_a_hot_history_are_spread(spark):
    id_ = F.col("id")
    pageviews = land(spark.range(200_000).select(
        F.when(id_ % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), id_ % 5000)).alias("article_name"),
        F.date_add(F.lit("2000-01-01").cast("date"), (id_ % 7000).cast("int")).alias("date"),
        id_.alias("views"), F.lit(1).alias("rank")), "views")
    articles = land(spark.range(3000).select(
        *[F.concat(F.lit("k"), id_).alias(c)
          for c in ("article_name", "name", "description", "url", "abstract")]), "articles")
    with settings(spark, **{**SKEW, "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64KB",
                            "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB"}):
        documents = article_documents(pageviews, articles, max_entries=500)
        sizes = [(r.article_name, len(r.date)) for r in documents.collect()]
        assert "skew=true" in plan(documents)
    assert sum(n for _, n in sizes) == 200_000
    assert max(n for _, n in sizes) == 500
    assert len([k for k, _ in sizes if k == "hot"]) == -(-66_667 // 500)


def test_catalyst_decides_on_the_broadcast_of_keys(spark, skewed):
    left = skewed[0].withColumnRenamed("k", "article_name")
    keys = viewed_keys(left)
    assert "BroadcastHashJoin" in plan(keep_matching(left, keys, ["article_name"]))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1,
                  spark__sql__adaptive__autoBroadcastJoinThreshold=-1):
        assert "SortMergeJoin" in plan(keep_matching(left, keys, ["article_name"]))


def test_split_histories_cut_a_key_into_slices(spark):
    """Also a key whose entries are all of one day, here without a date."""
    id_ = F.col("id")
    df = land(spark.range(120_000).select(
        F.lit("hot").alias("article_name"), F.lit(None).cast("date").alias("date"),
        (id_ % 40_000).alias("views"), F.lit(None).cast("int").alias("rank")), "views")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false",
                  spark__sql__shuffle__partitions=16):
        parts = article_histories(df, "article_name", 1000).collect()
    assert sorted((r.part, len(r.views)) for r in parts) == [(i, 1000) for i in range(120)]
    views = [v for r in sorted(parts, key=lambda r: r.part) for v in r.views]
    assert views == sorted(list(range(40_000)) * 3)
