"""Against all pairs that share a shingle."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from textlake.llm import near_dedup as N
from textlake.llm.components import components


def got(docs):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(docs).collect()}


def expected(docs):
    return {i: (n, c, i == c) for i, (n, c) in brute.near_duplicates(dict(docs)).items()}


def test_estimates_are_unbiased_and_tight():
    rng, errors = np.random.default_rng(1), []
    for _ in range(300):
        n = int(rng.integers(20, 300))
        base = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        k = n * 3 // 4
        x, y = base[:n], base[n - k : 2 * n - k]
        ranks = N.super_minhash(np.concatenate([x, y]), np.repeat([0, 1], n), 2)
        errors.append((ranks[0] == ranks[1]).mean() - k / (2 * n - k))
    assert abs(np.mean(errors)) < 0.006 and np.std(errors) < 0.0435


def test_signature_of_a_set_does_not_depend_on_its_batch():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 3, 40, 20_000)]
    sizes = [len(s) for s in sets]
    together = N.super_minhash(np.concatenate(sets), np.repeat(np.arange(4), sizes), 4)
    for k, own in enumerate(sets):
        assert (N.super_minhash(own[::-1], np.zeros(len(own), int), 1)[0] == together[k]).all()


def test_small_tables(small):
    docs = [(r.doc_id, r.text) for r in small.collect()]
    assert got(small) == expected(docs)


def test_a_large_group_of_near_copies(documents):
    """Links run through it in chains; a third of all rows are exact copies."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(120)]
    docs = []
    for i in range(150):
        own = list(base)
        for _ in range(rnd.randint(0, 6)):
            own[rnd.randrange(len(own))] = rnd.choice(words)
        docs.append((1000 + i, " ".join(own)))
    docs += [(i, " ".join(base)) for i in range(3, 140)]
    docs += [(5000 + i, " ".join(rnd.choice(words) for _ in range(60))) for i in range(60)]
    rnd.shuffle(docs)
    assert got(documents(*docs)) == expected(docs)


def test_edges(documents):
    a = "the quick brown fox jumps over the lazy dog again and again"
    docs = documents((5, a), (3, a.upper()), (9, None), (8, ""), (7, " \t\n"), (6, "two words"), (4, "Two  words"), (2, "É two"), (1, "é two"))
    assert got(docs) == {
        5: (8, 3, False), 3: (8, 3, True), 9: (0, 9, True), 8: (0, 8, True), 7: (0, 7, True),
        6: (1, 4, False), 4: (1, 4, True), 2: (1, 2, True), 1: (1, 1, True)}
    extra = docs.withColumns({"rep": F.lit(1), "bucket": F.lit("x")})
    assert got(extra) == got(docs)
    assert N.near_duplicates(docs.where("false")).count() == 0
    rows = N.near_duplicates(documents((None, a), (3, a), (3, a), (3, "other text that is long enough"))).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [(0, 0, False), (3, 3, True), (3, 3, True), (3, 3, True)]


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)]
    rows = components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()
    links = [x for x in links if x[0] != x[1]]
    assert {r.node: r.component for r in rows} == brute.smallest_reachable({x for p in links for x in p}, links)
    assert len({r.node for r in rows}) == len(rows)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
