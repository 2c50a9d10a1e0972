"""Documents that grow by loads, and a corpus that arrives in files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_months import files
from test_plans import plan

from textlake import plans
from textlake.plans.growing import _places, _stored, first_changed_parts
from textlake.schemas import DOCUMENTS
from textlake.workspace import folders

VIEWS = "article_name string, date date, views long, rank int"
TEXTS = "article_name string, name string, description string, url string, abstract string"
START = dt.date(2020, 1, 1)


def made(seed, n):
    rnd = random.Random(seed)
    days = [None, *[START + dt.timedelta(k) for k in range(12)]]
    return [(rnd.choice(["a", "a", "b", None, ""]), rnd.choice(days), rnd.choice([None, 1, 2]), rnd.choice([None, 1, 5])) for _ in range(n)]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([("a", "A", "A", "u", None), ("b", "b", None, "v", "B"), ("zzz", "z", "never", "w", "")], TEXTS)


def said(documents):
    return sorted(map(str, documents.select(*DOCUMENTS.names).collect()))


@pytest.mark.parametrize("seed,max_entries", [(1, 3), (2, 7), (3, 1), (4, 100_000)])
def test_any_loads_equal_one_build(spark, tmp_path, texts, seed, max_entries):
    rnd = random.Random(seed)
    rows, path = made(seed, 70), str(tmp_path / "documents")
    cuts = sorted(rnd.sample(range(70), 3))
    for a, b in zip([0, *cuts], [*cuts, 70]):
        plans.append_documents(spark, path, spark.createDataFrame(rows[a:b], VIEWS), texts, max_entries)
    whole = plans.article_documents(spark.createDataFrame(rows, VIEWS), texts, max_entries)
    grown = plans.current_documents(spark, path)
    assert said(grown) == said(whole) and grown.schema.names == DOCUMENTS.names
    assert all(r.part == 0 or len(r.date) <= max_entries for r in grown.collect())
    plans.compact_documents(spark, path, str(tmp_path / "compacted"), max_entries)
    assert said(plans.current_documents(spark, str(tmp_path / "compacted"))) == said(whole)
    assert folders(spark, str(tmp_path / "compacted")).count("version=0") == 1


def day(k, key, views=1):
    return (key, START + dt.timedelta(k), views, 1)


def test_only_changed_parts_are_written(spark, tmp_path, texts):
    path = str(tmp_path / "documents")
    rows = [day(k, key) for k in range(0, 20, 2) for key in "ab"]
    plans.append_documents(spark, path, spark.createDataFrame(rows, VIEWS), texts, 4)
    before = files(path)
    loads = [
        ([day(30, "a")], {("a", 2)}),  # room in the last part
        ([day(31, "a"), day(32, "a")], {("a", 2), ("a", 3)}),  # beyond it
        ([day(5, "b")], {("b", 0), ("b", 1), ("b", 2)}),  # late: from the first part on
        ([day(7, "b")], {("b", 1), ("b", 2)}),
        ([day(9, "b")], {("b", 1), ("b", 2), ("b", 3)}),
        ([day(1, "c")], {("c", 0)}),
    ]
    for k, (load, changed) in enumerate(loads):
        plans.append_documents(spark, path, spark.createDataFrame(load, VIEWS), texts, 4)
        rows += load
        new = spark.read.parquet(f"{path}/version={k + 1}")
        assert {(r.article_name, r.part) for r in new.collect()} == changed, load
        after = files(path)
        assert before.items() <= after.items()
        before = after
        assert said(plans.current_documents(spark, path)) == said(plans.article_documents(spark.createDataFrame(rows, VIEWS), texts, 4))


def test_nothing_to_add(spark, tmp_path, texts):
    path = str(tmp_path / "documents")
    none = spark.createDataFrame([], VIEWS)
    plans.append_documents(spark, path, none, texts)
    assert folders(spark, path) == [] and plans.current_documents(spark, path).count() == 0
    plans.append_documents(spark, path, spark.createDataFrame([day(1, "a")], VIEWS), texts)
    plans.append_documents(spark, path, none, texts)
    assert folders(spark, path).count("version=0") == 1 and "version=1" not in folders(spark, path)


def test_places_read_small_columns(spark, tmp_path, texts):
    path = str(tmp_path / "documents")
    plans.append_documents(spark, path, spark.createDataFrame([day(k, "a") for k in range(9)], VIEWS), texts, 4)
    text = plan(_places(_stored(spark, path)))
    assert "array" not in text.split("ReadSchema")[1].split("\n")[0]
    later = first_changed_parts(spark.createDataFrame([day(30, "a")], VIEWS), _stored(spark, path), 4).collect()
    assert [(r.key.name, r.start, r.full) for r in later] == [("a", 2, False)]
    late = first_changed_parts(spark.createDataFrame([day(5, "a")], VIEWS), _stored(spark, path), 4).collect()
    assert [(r.start, r.full) for r in late] == [(1, True)]
    # an append of later days leaves the full parts unread
    assert "PartitionFilters" in plan(_stored(spark, path).where("open")) and "open" in plan(_stored(spark, path).where("open")).split("PartitionFilters")[1]


def test_lookup_reaches_the_scan(spark, tmp_path, texts):
    path = str(tmp_path / "documents")
    plans.append_documents(spark, path, spark.createDataFrame([day(1, "a"), day(2, "b")], VIEWS), texts)
    found = plans.lookup_document(plans.current_documents(spark, path), "A")
    assert [r.article_name for r in found.collect()] == ["a"] and "EqualTo(article_name,a)" in plan(found)


ROWS = "id long, k string, o int, t string"


@pytest.mark.parametrize("keep", ["first", "last"])
def test_any_arrivals_equal_one_dedup(spark, tmp_path, keep):
    rnd = random.Random(keep)
    rows = [(i, rnd.choice(["x", "y", None, "z"]), rnd.choice([None, 1, 2, 3]), rnd.choice([None, "p", "q"])) for i in range(60)]
    rule = (["k"], "o", keep, ["t", "id"])
    frame, path = spark.createDataFrame(rows, ROWS), str(tmp_path / "arrivals")
    for k in (2, 0, 1, 1):
        plans.add_arrival(frame.where(F.col("id") % 3 == k), path, f"part {k}/of=3 %", *rule)
    got = plans.winners_of_arrivals(spark, path, *rule)
    want = plans.tables.deduplicate_df(frame, *rule)
    assert got.columns == frame.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # no more than a row per key and arrival is kept
    assert spark.read.parquet(path).count() <= 12


def test_an_arrival_takes_the_place_of_its_first_one(spark, tmp_path):
    path, rule = str(tmp_path / "arrivals"), (["k"], "o")
    plans.add_arrival(spark.createDataFrame([(1, "x", 1, "")], ROWS), path, "2020", *rule)
    plans.add_arrival(spark.createDataFrame([(2, "x", 2, "")], ROWS), path, "a", *rule)
    plans.add_arrival(spark.createDataFrame([], ROWS), path, "2020", *rule)
    assert [r.id for r in plans.winners_of_arrivals(spark, path, *rule).collect()] == [2]
