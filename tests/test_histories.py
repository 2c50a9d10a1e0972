"""Histories against brute force, whole and split."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from textlake.operators import article_histories
from textlake.plans import article_documents, lookup_document, sample_document, viewed_keys

SCHEMA = "article_name string, date date, views long, rank int"


def null_first(entry):
    return [(v is not None, v) for v in entry]


def brute_force(rows, size):
    groups = defaultdict(list)
    for key, date, views, rank in rows:
        groups[key].append((date, rank, views))
    out = {}
    for key, entries in groups.items():
        entries.sort(key=null_first)
        for part, at in enumerate(range(0, len(entries), size)):
            out[key, part] = entries[at:at + size]
    return out


def entries(df):
    return {(r.article_name, r.part): list(zip(r.date, r["rank"], r.views, strict=True))
            for r in df.collect()}


def rows_with_copies(seed):
    rnd = random.Random(seed)
    days = [dt.date(2020, 1, 1) + dt.timedelta(d) for d in range(6)] + [None]
    keys = ["hot"] * 8 + ["a", "b", "", None]
    rows = [(rnd.choice(keys), rnd.choice(days), rnd.choice([1, 2, None]), rnd.choice([1, 2, None]))
            for _ in range(400)]
    return rows + [("hot", days[2], 7, 7)] * 150


@pytest.mark.parametrize("size", [1, 7, 40, 1000, 100_000])
def test_histories_equal_brute_force(spark, size):
    rows = rows_with_copies(size)
    df = spark.createDataFrame(rows, SCHEMA)
    got = article_histories(df, "article_name", size)
    assert entries(got) == brute_force(rows, size)


def test_nulls_keep_the_arrays_aligned(spark):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    df = spark.createDataFrame([("a", d2, 5, 1), ("a", d1, None, 1)], SCHEMA)
    row = article_histories(df, "article_name").first()
    assert (row.date, row.views) == ([d1, d2], [None, 5])


def test_viewed_keys(spark):
    df = spark.createDataFrame([("é",), ("é",), ("b",), (None,)], "article_name string")
    assert {r[0] for r in viewed_keys(df).collect()} == {"é", "b", None}
    assert viewed_keys(df.where("false")).count() == 0


def corpus(spark):
    return spark.createDataFrame(
        [("hot", "Hot", "d2", "u2", "x"), ("hot", "HOT", "d1", "u1", "y"), ("zz", "ZZ", "d", "u", "z")],
        "article_name string, name string, description string, url string, abstract string")


@pytest.mark.parametrize("size", [50, 100_000])
def test_documents_in_parts(spark, size):
    rows = rows_with_copies(3)
    pageviews = spark.createDataFrame(rows, SCHEMA)
    documents = article_documents(pageviews, corpus(spark), max_entries=size)
    assert entries(documents) == brute_force(rows, size)
    assert {r.url for r in documents.where("article_name = 'hot'").collect()} == {"u1"}
    assert {r.url for r in documents.where("article_name <> 'hot'").collect()} == {None}
    hot = lookup_document(documents, "H-o_t").collect()
    assert [r.part for r in hot] == list(range(len(hot)))
    assert sum(len(r.date) for r in hot) == sum(r[0] == "hot" for r in rows)
    assert lookup_document(documents, "absent").isEmpty()


def test_a_hot_title_changes_nothing_for_the_others(spark):
    rows = rows_with_copies(5)
    def others(more):
        pageviews = spark.createDataFrame(rows + more, SCHEMA)
        documents = article_documents(pageviews, corpus(spark), max_entries=50)
        tree = documents._jdf.queryExecution().optimizedPlan().toString()
        shape = [line.strip(" :+-").split(" ")[0] for line in tree.splitlines()]
        return {k: v for k, v in entries(documents).items() if k[0] != "hot"}, shape
    hot = [("hot", dt.date(2021, 1, 1), n, 1) for n in range(2000)]
    assert others([]) == others(hot)


def test_blank_parts_are_left_out(spark):
    documents = article_documents(spark.createDataFrame(rows_with_copies(3), SCHEMA), corpus(spark), max_entries=50)
    blank = documents.where("part = 1").withColumns({"part": F.lit(99).cast("long"), **{c: F.array().cast(documents.schema[c].dataType) for c in ("date", "views", "rank")}})
    found = lookup_document(documents.unionByName(blank), "hot").collect()
    assert found == lookup_document(documents, "hot").collect()


def test_sample_is_all_parts_of_one_document(spark):
    documents = spark.createDataFrame(
        [(f"t{i}", part) for i in range(20) for part in range(i % 3 + 1)] + [(None, 0), (None, 1)],
        "article_name string, part long")
    seen = [sample_document(documents, seed).collect() for seed in range(30)]
    keys = {rows[0].article_name for rows in seen}
    assert len(keys) > 5 and keys <= {f"t{i}" for i in range(20)} | {None}
    for rows in seen:
        key = rows[0].article_name
        assert {r.article_name for r in rows} == {key}
        assert [r.part for r in rows] == list(range(2 if key is None else int(key[1:]) % 3 + 1))
    assert seen[3] == sample_document(documents.repartition(7), 3).collect()
