"""The three products against a plain Python model, on random titles."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from checks import fixture
from textlake.operators import df_join
from textlake.plans import (
    analytics,
    article_documents,
    clean_articles,
    clean_pageviews,
    rankings,
    unique_articles,
)
from textlake.schemas import KEY

DROPPED = set(":,.!?\"'()[]{}\\/ -_")
PIECES = ["Ab", "aB", "_", " ", "-", "(x)", "É", "–", "'", "\\", "\t", ".", "12"]


def model_key(title):
    return None if title is None else "".join(c for c in title.lower() if c not in DROPPED)


def title(rnd):
    if rnd.random() < 0.03:
        return None
    return "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 4)))


def model_clean(rows):
    return [
        (a, int(v), d, r, model_key(a)) for a, d, v, r in rows
        if v is not None and v != "" and all(c in "0123456789" for c in v)
    ]


def none_first(*values):
    return [(v is not None, v) for v in values]


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rnd = random.Random(request.param)
    days = [dt.date(2016, 1, 1) + dt.timedelta(i) for i in range(25)]
    views = ["7", "9999", "10000", "250000", "n/a", "", None, "1 2", "-5", "٣"]
    raw = [(title(rnd), rnd.choice(days), rnd.choice(views), rnd.randint(1, 100))
           for _ in range(1500)]
    corpus = [(title(rnd), f"d{i}", f"u{rnd.randint(0, 400)}", f"a{i}") for i in range(300)]
    return (
        spark.createDataFrame(raw, "article string, date date, views string, rank int"), raw,
        spark.createDataFrame(
            corpus, "name string, description string, url string, abstract string"), corpus,
    )


def test_rankings(case):
    df, raw, _, _ = case
    def bucket(v):
        return "low" if v < 10_000 else "medium" if v < 100_000 else "high"
    expected = [(k, v, bucket(v), d, r) for _, v, d, r, k in model_clean(raw)]
    got = rankings(clean_pageviews(df)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_analytics(case):
    df, raw, _, _ = case
    groups = defaultdict(list)
    for _, v, d, r, k in model_clean(raw):
        groups[k].append((v, d, r))
    expected = {
        k: (sum(v for v, _, _ in g) / len(g), max(v for v, _, _ in g),
            min(r for _, _, r in g), len({d for _, d, _ in g}))
        for k, g in groups.items()
    }
    got = analytics(clean_pageviews(df)).collect()
    assert len(got) == len(expected)
    assert {r[0]: tuple(r)[1:] for r in got} == expected


@pytest.mark.parametrize("max_entries", [10, 100_000])
def test_documents(case, max_entries):
    df, raw, articles, corpus = case
    best = {}
    for name, description, url, abstract in sorted(corpus, key=lambda r: none_first(r[2], r[0])):
        best.setdefault(model_key(name), (description, url, abstract))
    groups = defaultdict(list)
    for _, v, d, r, k in model_clean(raw):
        groups[k].append((d, r, v))
    expected = {}
    for k, g in groups.items():
        g.sort()
        texts = best.get(k) if k is not None else None
        for part in range(-(-len(g) // max_entries)):
            piece = g[part * max_entries:(part + 1) * max_entries]
            expected[k, part] = tuple(map(list, zip(*piece, strict=True))) + (
                texts or (None, None, None))
    got = article_documents(
        clean_pageviews(df), clean_articles(articles), max_entries=max_entries).collect()
    assert len(got) == len(expected)
    assert {(r[KEY], r.part): (r.date, r["rank"], r.views, r.description, r.url, r.abstract)
            for r in got} == expected


def test_left_join_to_unique_articles_keeps_the_rows(case):
    df, _, articles, _ = case
    pageviews = clean_pageviews(df)
    joined = df_join(pageviews, unique_articles(clean_articles(articles)), [KEY])
    assert joined.count() == pageviews.count()
    assert joined.columns == [
        KEY, "article", "views", "date", "rank", "name", "description", "url", "abstract"]


def test_buckets_partition_the_rows(spark):
    pageviews = fixture.pageviews(spark, "/root/testdata/sf0.001")
    buckets = {r.popularity_bucket: r["count"]
               for r in rankings(pageviews).groupBy("popularity_bucket").count().collect()}
    assert set(buckets) == {"low", "medium", "high"}
    assert sum(buckets.values()) == pageviews.count()
