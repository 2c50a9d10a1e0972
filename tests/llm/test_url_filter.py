import random

import pytest
from pyspark.sql import functions as F

from textlake.llm import url_filter as U

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def expected(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
        path = rest[:cut]
    fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "block" if host in listed else "allow"))
    return host, path, rule, verdict


URLS = [None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?y#z", "http://example.org/en/12", "http://example.org", "http://example.org?/es/", "https://x.com/fr/", "https://com/de/1",
        "https://xcom/de/1", "ftp://ads.com/x", "http://bad.net:80/p", "http://bad.net/p#q", "http://bad.net#/p", "http://ÄB.net/ü", "a://b://c/d", "http://x.net/\n/y?z"]


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, None), (None, "http://bad.net/p")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("clash"), "listed": F.lit(True)})
    listed = spark.createDataFrame([("bad.net",), ("bad.net",), ("ads.com",), ("never.seen",), (None,)], "host string")
    got = [tuple(r) for r in U.judge_urls(pages, listed).collect()]
    assert sorted(got, key=str) == sorted([(i, *expected(u, {"bad.net", "ads.com"})) for i, u in rows], key=str)
    assert U.judge_urls(pages.where("false"), listed).count() == 0
    nobody = U.judge_urls(pages, listed.where("false")).collect()
    assert sorted(map(str, map(tuple, nobody))) == sorted(str((i, *expected(u, set()))) for i, u in rows)


@pytest.mark.parametrize("max_bytes", [1 << 20, 800])
@pytest.mark.parametrize("share", [0.0, 0.02, 0.5, 1.0])
def test_membership_is_exact(spark, share, max_bytes):
    """For all keys of the universe, in one shard and in many."""
    rnd = random.Random(int(share * 100))
    keys = [f"host{i}.net" for i in range(6000)]
    listed = {k for k in keys if rnd.random() < share}
    rows = spark.createDataFrame([(k,) for k in keys * 2] + [(None,)], "key string")
    frame = spark.createDataFrame([(k,) for k in listed], "k string")
    out = U.member_of_list(rows, "key", frame, "hit", max_bytes).collect()
    assert len(out) == 12_001 and all(r.hit == (r.key in listed) for r in out)


def test_levels_alternate(spark):
    universe = spark.range(20_000).select(F.xxhash64("id").alias("h"), (F.col("id") % 4 == 0).alias("listed"))
    cascade = U.build_cascade(universe)
    assert len(cascade.levels) >= 3
    sizes = [bits for bits, _, _ in cascade.levels]
    assert sizes[0] > sum(sizes[1:])


def bytes_of(cascade):
    return sum(words.nbytes for _, _, words in cascade.levels)


@pytest.mark.parametrize(("n", "step"), [(100_000, 10_000), (100_000, 100), (20_000, 2)])
def test_all_levels_grow_with_the_list(spark, n, step):
    """Few listed keys in a large universe too: the later levels stay below the first one."""
    universe = spark.range(n).select(F.xxhash64("id").alias("h"), (F.col("id") % step == 0).alias("listed"))
    cascade = U.build_cascade(universe)
    n_listed = n // step
    per_key, _ = U.first_level(n_listed, n - n_listed)
    assert 8 * bytes_of(cascade) <= n_listed * (per_key + U.LATER_LEVELS[0]) + 64 * len(cascade.levels) + 400
    h = universe.toPandas()
    assert (cascade.listed(h.h.to_numpy().view("uint64")) == h.listed.to_numpy()).all()


def test_a_cascade_keeps_to_its_bytes(spark, monkeypatch):
    universe = spark.range(3000).select(F.xxhash64("id").alias("h"), (F.col("id") % 3 == 0).alias("listed"))
    with pytest.raises(U.TooLarge):
        U.build_cascade(universe, 100)
    # half of the keys are dealt into one of the shards that were guessed: it is split
    monkeypatch.setattr(U, "_shard", lambda h: F.when(h % 2 == 0, F.xxhash64(h)).otherwise(F.pmod(F.xxhash64(h), F.lit(7)) * 13))
    shards = list(U._cascades(universe, 100))
    assert all(bytes_of(c) <= 100 or len(c.levels[0][2]) == 1 for _, _, c in shards) and len({n for n, _, _ in shards}) > 1
    assert sum(1 / n for n, _, _ in shards) == pytest.approx(1)


def test_keys_with_equal_hashes(spark, monkeypatch):
    """Listed and unlisted keys of one hash are told apart."""
    monkeypatch.setattr(U, "_hashed", lambda key: F.xxhash64(F.substring(key, 1, 5)))
    keys = [f"host{i}.net" for i in range(300)]
    listed = set(keys[::7])
    rows = spark.createDataFrame([(k,) for k in [*keys, *keys, None]], "key string")
    out = U.member_of_list(rows, "key", spark.createDataFrame([(k,) for k in listed], "k string"), "hit").collect()
    assert len(out) == 601 and all(r.hit == (r.key in listed) for r in out)


def test_hosts_are_listed_by_what_their_pages_say(spark):
    said, hidden, clean = "<p>Play CASINO!</p>", '<script>track("casino")</script><a href="/casino">ok</a>', "<p>casinos bets4</p>"
    rows = [("http://a.net/1", said), ("http://A.net/2", clean), ("http://b.net/", said), ("http://b.net/", clean), ("http://b.net/", None),
            ("http://c.net/", hidden), ("http://casino.net/", clean), ("http://d.net", "<script>x\n</script>spam"), (None, said), ("nohost", said)]
    pages = spark.createDataFrame(rows, "url string, html string").withColumns({"host": F.lit("clash"), "said": F.lit(1)})
    assert sorted(r.host for r in U.hosts_by_evidence(pages).collect()) == ["a.net", "d.net"]
    assert U.hosts_by_evidence(pages.where("false")).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_blocks_hosts_by_their_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    listed = {r.host for r in U.hosts_by_evidence(pages).collect()}
    rows = {r.page_id: r.url for r in pages.collect()}
    got = U.judge_urls(pages, U.hosts_by_evidence(pages)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, *expected(u, listed)) for i, u in rows.items()], key=str)
