import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlake.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, entries=256, rounds=4):
    """{(vec_id, vector): (code, error, label_error)} and the codebooks' digest, by plain Python."""
    kept = [(i, e, lab) for i, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    ints = [[math.floor(1024 * x) for x in e] for _, e, _ in kept]
    w = len(ints[0]) // 4
    order = sorted((i, e, k) for k, (i, e, _) in enumerate(kept) if i is not None)[:entries]
    books = [[ints[k][p * w : (p + 1) * w] for _, _, k in order] for p in range(4)]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, x)), k) for k, x in enumerate(book))

    for _ in range(rounds):
        new = []
        for p in range(4):
            own = [[] for _ in books[p]]
            for v in ints:
                part = v[p * w : (p + 1) * w]
                own[nearest(books[p], part)[1]].append(part)
            new.append([[sum(c) // len(o) for c in zip(*o)] if o else x for o, x in zip(own, books[p])])
        books = new
    found = [[nearest(books[p], v[p * w : (p + 1) * w]) for p in range(4)] for v in ints]
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for (_, _, lab), e in zip(kept, errors):
        labels[lab] = labels.get(lab, 0) + e
    digest = hashlib.sha256(",".join(str(c) for book in books for x in book for c in x).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in f), e, labels[lab]) for (i, _, lab), f, e in zip(kept, found, errors)), digest


def got(frame):
    rows = V.vector_codes(frame).collect()
    return sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in rows), {r.codebooks_sha256 for r in rows}


def test_against_plain(spark):
    rnd = random.Random(5)
    centres = [[rnd.uniform(-1, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [float(np.float32(x + rnd.gauss(0, 0.05))) for x in rnd.choice(centres)], rnd.choice([1, 2, None])) for i in range(700)]
    rows += [rows[3], rows[600], (3, rows[9][1], 5), (None, rows[11][1], 2)]
    rows += [(9000, None, 1), (9001, [1.0] * 7 + [float("nan")], 1), (9002, [1.0] * 7 + [float("inf")], 1), (9003, [1.0] * 7 + [None], 1)]
    rnd.shuffle(rows)
    want, digest = brute(rows)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == (want, {digest})


def test_ties_and_few_rows(spark):
    rows = [(i, [float(i // 4 % 2)] * 4 + [0.0] * 4, 0) for i in range(30)]
    want, digest = brute(rows)
    assert got(spark.createDataFrame(rows, SCHEMA)) == (want, {digest})
    assert {w[1] for w in want} <= {"00000000", "04040000"}


def test_candidates_are_exactly_the_box():
    rng = np.random.default_rng(1)
    entries, x = rng.integers(-20, 20, (100, 5)), rng.integers(-25, 25, (300, 5))
    finder = V.Nearest(entries)
    radius = rng.integers(0, 12, 300)
    held = np.unpackbits(finder.candidates(x, radius).astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :100]
    assert np.array_equal(held.astype(bool), np.abs(x[:, None] - entries[None]).max(axis=2) <= radius[:, None])
    far = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    index, distance = finder.find(x)
    assert np.array_equal(index, far.argmin(axis=1)) and np.array_equal(distance, far.min(axis=1))


@pytest.mark.parametrize("width", [1, 16, 300])
def test_large_components(width):
    most = V.largest_component(width)
    entries = np.array([[-most] * width, [most] * width, [most - 1] * width])
    index, distance = V.Nearest(entries).find(np.array([[most] * width, [-most] * width, [most - 1] * width]))
    assert index.tolist() == [1, 0, 2] and distance.tolist() == [0, 0, 0]
    assert (2 * most) ** 2 * width < 2**63


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert V.vector_codes(empty).count() == 0
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1), (2, [], 1)], SCHEMA)
    assert [(r.code, r.error) for r in V.vector_codes(odd).collect()] == [(None, None)] * 2
    mixed = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], 1), (2, [1e30, 0.0, 0.0, 0.0], None), (3, [0.5], 1)], SCHEMA)
    clashing = mixed.withColumns({"code": F.lit("x"), "error": F.lit(7), "vector": F.lit(0), "id": F.lit(0), "a.b": F.lit(1)})
    rows = {r.vec_id: r for r in V.vector_codes(clashing).collect()}
    assert rows[1].code == "00000000" and rows[2].code == "01010101" and rows[3].code is None
    assert rows[1].error == rows[2].error == 0 and rows[2].label_error == 0


def test_codes_round_trip(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    coded, books = V.compress(rows)
    found = coded.select("row.embedding", "code", "error").collect()
    near = V.decode([r.code for r in found], books)
    ints = np.floor(np.array([r.embedding for r in found], np.float64) * 1024)
    assert np.array_equal(((ints - near * 1024) ** 2).sum(axis=1), [r.error for r in found])
