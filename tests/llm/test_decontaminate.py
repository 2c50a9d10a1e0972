import random

import pytest

import brute
from textlake.llm import decontaminate as D


def expected(docs, items):
    out = set()
    for d, text in docs:
        own = brute.shingle_set(text)
        for i, item in items:
            s = brute.shingle_set(item)
            if s and 100 * len(s & own) >= 75 * len(s):
                out.add((d, i, len(s), len(s & own)))
    return out


def found(docs, items):
    return sorted(tuple(r) for r in D.find_items(docs, items).collect())


def test_small_tables(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = expected([(r.doc_id, r.text) for r in small.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and set(found(small, items)) == want
    clean = D.without_items(small, items)
    assert clean.columns == small.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in small.collect()} - {d for d, *_ in want}


@pytest.mark.parametrize("shingles", [40, 1_000_000])
def test_parts_of_items_inside_long_texts(spark, documents, monkeypatch, shingles):
    """Items of all sizes, some words changed; the index in one part or in many."""
    monkeypatch.setattr(D, "INDEX_SHINGLES", shingles)
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(n))) for i, n in enumerate([1, 4, 5, 6, 8, 9, 12, 20, 33, 60, 150])]
    docs = []
    for k in range(120):
        own = [rnd.choice(words) for _ in range(rnd.choice([0, 3, 200, 4000]))]
        _, item = rnd.choice(items)
        piece = item.split(" ")
        for _ in range(rnd.choice([0, 0, 1, 2])):
            piece[rnd.randrange(len(piece))] = "changed"
        at = rnd.randint(0, len(own))
        docs.append((k, " ".join(own[:at] + piece + own[at:])))
    frame = spark.createDataFrame(items, "item_id long, text string")
    want = expected(docs, items)
    assert len(want) > 40
    assert set(found(documents(*docs), frame)) == want


def test_an_item_under_many_ids_is_indexed_once(spark, documents):
    text = "one item that very many ids of the list have in common"
    items = [(i, text) for i in range(2000)] + [(5000, "quite another item of seven words here")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    sets = D._numbered(D._item_table(frame))
    assert [len(index.value.sets) for index in D._indexes(sets)] == [2]
    docs = [(1, f"before {text} after"), (2, "nothing"), (3, "quite another item of seven words here")]
    assert set(found(documents(*docs), frame)) == expected(docs, items) and len(expected(docs, items)) == 2001
    assert [r.doc_id for r in D.without_items(documents(*docs), frame).collect()] == [2]


def test_a_sketch_meets_every_document_that_holds_the_item():
    for n in range(1, 400):
        missing = n - -(-75 * n // 100)
        assert min(n, D.sketch_size(n)) > missing


def test_edges(spark, documents):
    items = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, " "), (None, "a b c d e f")], "item_id long, text string")
    docs = documents((7, "x A B c d e f y"), (7, "x A B c d e f y"), (None, "a b c d e f"), (8, None), (9, ""))
    hits = [(7, i, 2, 2) for i in (1, 2, None)] * 2 + [(None, i, 2, 2) for i in (1, 2, None)]
    assert sorted(found_rows(docs, items), key=str) == sorted(hits, key=str)
    kept = D.without_items(docs, items).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [(8, None), (9, "")] and len(kept) == 2
    assert found_rows(docs, items.where("false")) == [] == found_rows(docs.where("false"), items)
    assert D.without_items(docs, items.where("false")).count() == 5


def found_rows(docs, items):
    return [tuple(r) for r in D.find_items(docs, items).collect()]
