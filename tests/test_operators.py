"""Hand-made rows for every behaviour that is easy to get wrong."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.functions import popularity_bucket, title_key
from textlake.operators import (
    add_column,
    basic_preprocessing,
    deduplicate_df,
    df_join,
    groupby_expr,
    keep_matching,
)
from textlake.plans import clean_pageviews, pageview_quality

DAY = dt.date(2016, 12, 2)


def column(df, name):
    return [r[name] for r in df.collect()]


# Normaliser

TITLES = {
    "AC/DC_(band)": "acdcband",
    "  Hi - There_x ": "hitherex",
    "Ünï–code—_É": "ünï–code—é",
    "a\tb_c": "a\tbc",
    "“Heroes”": "“heroes”",
    "___": "",
    "": "",
    None: None,
}


def test_title_key(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "t string")
    rows = df.select("t", title_key("t").alias("k"), title_key(title_key("t")).alias("kk")).collect()
    assert {r.t: r.k for r in rows} == TITLES
    assert all(r.k == r.kk for r in rows)


def test_title_key_equals_the_stepwise_form(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    steps = F.translate(F.lower("text"), "_", " ")
    steps = F.trim(F.translate(steps, ":,.!?\"'()[]{}\\/ -", ""))
    assert documents.where(~steps.eqNullSafe(title_key("text"))).isEmpty()


# Corrupt-row filter

def test_filter_applies_to_selected_views_only(spark):
    df = spark.createDataFrame(
        [("A b", "12", 1), ("C", "n/a", 2), ("D", None, 3), ("E", "", 4), ("F", "-1", 5)],
        "article string, views string, rank int")
    kept = basic_preprocessing(df, ["article", "views"], "article", "k")
    assert kept.columns == ["article", "views", "k"]
    assert kept.collect() == [("A b", "12", "ab")]
    assert basic_preprocessing(df, ["article", "rank"], "article", "k").count() == 5


def test_filter_on_integer_views(spark):
    df = spark.createDataFrame([("A", 12), ("B", None)], "article string, views int")
    assert column(basic_preprocessing(df, ["article", "views"], "article", "k"), "k") == ["a"]


def test_standardised_column_must_be_selected(spark):
    df = spark.createDataFrame([("A", "1")], "article string, views string")
    with pytest.raises(AnalysisException):
        basic_preprocessing(df, ["views"], "article", "k")


def raw(spark, rows):
    return spark.createDataFrame(rows, "article string, date date, views string, rank int")


def test_too_long_counts_become_null_and_are_counted(spark):
    df = raw(spark, [("A", DAY, "9" * 20, 1), ("B", DAY, "7", 2), ("C", DAY, "x", 3),
                     ("__", DAY, "5", 4), ("b", DAY, "5", 5), ("D", DAY, None, 6)])
    assert sorted(column(clean_pageviews(df), "views"), key=str) == [5, 5, 7, None]
    assert pageview_quality(df).first().asDict() == {
        "raw_rows": 6, "kept_rows": 4, "corrupt_rows": 2, "overflow_rows": 1,
        "bad_date_rows": 0, "bad_rank_rows": 0,
        "empty_key_rows": 1, "distinct_titles": 4, "distinct_keys": 3,
    }


def test_quality_of_an_empty_table(spark):
    assert set(pageview_quality(raw(spark, [])).first()) == {0}


# Buckets

def test_bucket_edges(spark):
    views = [0, 9_999, 10_000, 99_999, 100_000, None]
    df = spark.createDataFrame([(v,) for v in views], "views long")
    assert column(df.select(popularity_bucket("views").alias("b")), "b") == [
        "low", "low", "medium", "medium", "high", "high"]


# add_column

def test_add_column_precedence(spark):
    df = spark.createDataFrame([(1,)], "a int")
    df = add_column(df, "sql", "a + 1", default_value=9)
    df = add_column(df, "col", F.col("a") + 2, default_value=9)
    df = add_column(df, "zero", default_value=0)
    df = add_column(df, "blank", default_value="")
    df = add_column(df, "none")
    df = add_column(df, "typed", data_type="date")
    assert df.first() == (1, 2, 3, 0, "", None, None)
    assert isinstance(df.schema["none"].dataType, T.NullType)
    assert isinstance(df.schema["typed"].dataType, T.DateType)
    assert add_column(df, "a", default_value=5).first().a == 5


# Deduplication

def numbered(spark):
    return spark.createDataFrame(
        [("k", None, "n"), ("k", 5, "f"), ("k", 7, "s"), ("j", 1, "b"), ("j", 1, "a"),
         (None, 2, "x"), (None, 3, "y")],
        "k string, o int, v string")


def test_dedup_first_last(spark):
    first = deduplicate_df(numbered(spark), ["k"], "o", tie_breakers=["v"])
    assert first.columns == ["k", "o", "v"]
    assert {r.k: r.v for r in first.collect()} == {"k": "n", "j": "a", None: "x"}
    last = deduplicate_df(numbered(spark), ["k"], "o", "last", tie_breakers=["v"])
    assert {r.k: r.v for r in last.collect()} == {"k": "s", "j": "a", None: "y"}


def test_dedup_unordered_and_by_several_columns(spark):
    kept = column(deduplicate_df(numbered(spark), ["k"]), "k")
    assert sorted(map(str, kept)) == ["None", "j", "k"]
    assert deduplicate_df(numbered(spark), ["k", "o"], "v").count() == 6


def test_dedup_rejects_unknown_keep(spark):
    with pytest.raises(ValueError):
        deduplicate_df(numbered(spark), ["k"], "o", keep="any")


# Joins

def sides(spark):
    left = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, x int")
    right = spark.createDataFrame([("a", 10), ("c", 11), (None, 12)], "k string, y int")
    return left, right


@pytest.mark.parametrize("how", [
    "inner", "left", "left_outer", "right", "RIGHT_OUTER", "rightouter", "full", "outer",
    "full_outer", "left_semi", "left_anti", "cross"])
def test_joins_equal_the_plain_join(spark, how):
    left, right = sides(spark)
    ours, plain = df_join(left, right, ["k"], how), left.join(right, ["k"], how)
    assert ours.columns == plain.columns
    assert sorted(ours.collect(), key=str) == sorted(plain.collect(), key=str)


@pytest.mark.parametrize("how", ["right", "full"])
def test_joins_on_two_columns_with_equal_names(spark, how):
    left = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "k string, j int, v int")
    right = spark.createDataFrame([("a", 1, 7), ("a", 2, 8)], "k string, j int, v int")
    ours, plain = df_join(left, right, ["k", "j"], how), left.join(right, ["k", "j"], how)
    assert ours.columns == plain.columns == ["k", "j", "v", "v"]
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_left_is_the_default(spark):
    left, right = sides(spark)
    assert df_join(left, right, ["k"]).count() == left.count()


def test_join_arguments(spark):
    left, right = sides(spark)
    with pytest.raises(ValueError, match="'x' in the right"):
        df_join(left, right, ["x"])
    with pytest.raises(ValueError, match="'y' in the left"):
        df_join(left, right, ["y"])
    with pytest.raises(ValueError):
        df_join(left, right, [])
    with pytest.raises(Exception, match="UNSUPPORTED_JOIN_TYPE"):
        df_join(left, right, ["k"], "sideways")


def test_semi_and_anti_partition_the_left(spark):
    left, right = sides(spark)
    semi = df_join(left, right, ["k"], "left_semi").count()
    assert semi + df_join(left, right, ["k"], "left_anti").count() == left.count()
    assert keep_matching(left, right, ["k"]).count() == semi


# Aggregation

def test_groupby_expr(spark):
    df = spark.createDataFrame(
        [("a", 1, "10"), ("a", 3, "9"), ("b", None, "1")], "k string, v int, r string")
    got = groupby_expr(df, "k", ["avg(v) AS m", "min(r) AS text_min", "min(int(r)) AS int_min"])
    assert {r.k: (r.m, r.text_min, r.int_min) for r in got.collect()} == {
        "a": (2.0, "10", 9), "b": (None, "1", 1)}
    assert groupby_expr(df, ["k", "r"], ["count(*) AS n"]).count() == 3
