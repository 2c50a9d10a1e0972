"""Tables kept up to date by corpus files and loads of pageviews."""

import datetime as dt
import json

import pytest

from textlake import plans
from textlake.plans import analytics, article_documents, clean_articles, clean_pageviews, rankings, unique_articles
from textlake.schemas import ANALYTICS, DOCUMENTS, RANKINGS
from textlake.sources import read_articles, read_pageviews

LOADS = {
    "a": "article,date,views,rank\nMain_Page,2019-12-31,5,1\nB!,2019-12-31,n/a,2\n",
    "b": "rank,article,views,date\n2,main page,7,2020-01-02\n1,C,9,2020-01-02\n",
    "c": "article,date,views,rank\nMain_Page,2020-01-01,1,1\nB,2020-01-01,3,2\n,2020-01-01,3,3\n",
}
CORPUS = {
    "x": [{"name": "Main Page", "url": "2", "description": "second"}, {"name": "never"}],
    "y": [{"name": "MAIN_PAGE", "url": "1", "description": "first"}, {"name": "c", "url": "3"}],
}


@pytest.fixture
def paths(tmp_path):
    for name, text in LOADS.items():
        (tmp_path / f"{name}.csv").write_text(text)
    for name, rows in CORPUS.items():
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows) + "{broken\n")
    return tmp_path


def said(table, columns):
    return sorted(map(str, table.select(*columns).collect()))


def test_loads_and_files_equal_one_build(spark, paths):
    target = str(paths / "tables")
    for name in ("x", "y", "x"):
        plans.add_corpus_file(spark, str(paths / f"{name}.jsonl"), target, name)
    for name in "abc":
        plans.add_pageviews(spark, str(paths / f"{name}.csv"), target, max_entries=2)
    views = [clean_pageviews(read_pageviews(spark, str(paths / f"{name}.csv"))) for name in "abc"]
    pageviews = views[0].unionByName(views[1]).unionByName(views[2])
    corpus = clean_articles(read_articles(spark, [str(paths / f"{name}.jsonl") for name in "xy"]))
    tables = plans.open_updated(spark, target)
    assert said(tables["article_rankings"], RANKINGS.names) == said(rankings(pageviews), RANKINGS.names)
    assert said(tables["article_analytics"], ANALYTICS.names) == said(analytics(pageviews), ANALYTICS.names)
    assert said(tables["article_documents"], DOCUMENTS.names) == said(article_documents(pageviews, corpus, 2), DOCUMENTS.names)
    assert sorted(r.name for r in plans.known_articles(spark, target).collect()) == sorted(r.name for r in unique_articles(corpus).collect())
    assert [tuple(r) for r in plans.top_of_month(tables["article_months"], 2020, 1).collect()] == [(2020, 1, "c", 9)]
    assert spark.sql("SELECT total_days_ranked FROM article_analytics WHERE article_name = 'mainpage'").collect() == [(3,)]


def test_a_year_is_corrected(spark, paths):
    target = str(paths / "tables")
    for name in "ab":
        plans.add_pageviews(spark, str(paths / f"{name}.csv"), target)
    for _ in range(2):
        plans.replace_years(spark, str(paths / "c.csv"), target)
        tables = plans.open_updated(spark, target)
        rows = {(r.article_name, r.date, r.views) for r in tables["article_rankings"].collect()}
        new = dt.date(2020, 1, 1)
        assert rows == {("mainpage", dt.date(2019, 12, 31), 5), ("mainpage", new, 1), ("b", new, 3), (None, new, 3)}
        assert {(r.article_name, r.avg_views) for r in tables["article_analytics"].collect()} == {("mainpage", 3.0), ("b", 3.0), (None, 3.0)}


def test_without_a_corpus(spark, paths):
    target = str(paths / "tables")
    plans.add_pageviews(spark, str(paths / "a.csv"), target)
    documents = plans.open_updated(spark, target)["article_documents"].collect()
    assert [(r.article_name, r.views, r.url) for r in documents] == [("mainpage", [5], None)]
