import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import LOWER
from pyspark.sql import functions as F

from textlake.llm import collocations as C


def brute(rows, support=30, top=2000):
    """{lang: [(phrase, a, l, r, n, score)]} in order, by counting every phrase."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = {}
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= support}
        kept = []
        for p, a in found.items():
            if any(100 * f >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, f in found.items() if len(q) > len(p)):
                continue
            score, _, left, right = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out[lang] = [(p.decode(), -a, left, right, totals[lang], -score) for score, a, p, left, right in sorted(kept)[:top]]
    return {lang: found for lang, found in out.items() if found}


def got(frame, **options):
    out = {}
    for r in sorted(C.collocations(frame, **options).collect(), key=lambda r: (r.lang, r.rank)):
        out.setdefault(r.lang, []).append((r.phrase, r.a, r.l, r.r, r.n, r.score))
        assert r.rank == len(out[r.lang])
    return out


def made(seed, n):
    rnd = random.Random(seed)
    words = ["the", "Of", "ice", "cream", "New", "york", "ÉCOLE", "école", "ça", "x", "y"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 25)):
            parts.append(rnd.choice(["new york city hall", "ice cream", rnd.choice(words), rnd.choice(words)]))
            parts.append(rnd.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "\x0b", " !"]))
        rows.append((rnd.choice(["en", "en", "fr", None, "und"]), "".join(parts)))
    return rows


@pytest.mark.parametrize("shards,held_words,bits", [(8, 1 << 23, 1 << 25), (3, 60, 32768), (16, 400, 65536)])
def test_against_plain(spark, shards, held_words, bits):
    """With shards of any size, and bitmaps so small that phrases share bits."""
    rows = made(1, 400) + [("en", None), ("en", ""), (None, None), ("es", " .,;")]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(12)
    want = brute(rows, support=12)
    assert len(want) == 3 and any(len(p.split()) == 4 for found in want.values() for p, *_ in found)
    assert got(frame, support=12, shards=shards, held_words=held_words, bits=bits) == want
    assert got(frame, support=12, top=3) == brute(rows, support=12, top=3)


def test_long_text_in_chunks():
    import pyarrow as pa

    text = " ".join(f"w{i % 7} w{i % 11}{'.' if i % 13 == 0 else ''}" for i in range(4000))
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "text": ["a b", text]})
    whole = [x for _, w in C.chunks(batch, 1 << 20) for x in w.phrases(np.flatnonzero(w.inside(3)), 3).to_pylist()]
    parts = list(C.chunks(batch, 200))
    assert len(parts) > 50
    assert [x for _, w in parts for x in w.phrases(np.flatnonzero(w.inside(3)), 3).to_pylist()] == whole


def test_phrases_of_one_hash_are_told_apart():
    import pyarrow as pa

    [(_, words)] = C.chunks(pa.RecordBatch.from_pydict({"lang": ["a", "b"], "text": ["x y x y z y", "x y"]}))
    at = np.flatnonzero(words.inside(2))
    lang = words.row
    first, counts = C._equal(np.zeros(len(at), np.uint64), at, words, 2, lang)
    found = sorted(zip(lang[first].tolist(), words.phrases(first, 2).to_pylist(), counts.tolist()))
    assert found == [(0, "x y", 2), (0, "y x", 1), (0, "y z", 1), (0, "z y", 1), (1, "x y", 1)]


def test_local_support_is_a_bound(spark):
    """A phrase that no shard but one has often is in the union, as are those spread thin."""
    rows = [("en", "a b")] * 12 + [("en", f"q{i} z") for i in range(200)] + [("en", f"c d u{i}") for i in range(12)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    found = got(frame.repartitionByRange(9, "text"), support=12)["en"]
    assert {(p, a) for p, a, *_ in found} == {("a b", 12), ("c d", 12)}


def test_counts_beyond_a_row(spark):
    """A phrase that one task has more often than a packed row can say."""
    rows = [("en", "ha " * 5000), ("en", "ho hum." * 9001)] * 2
    frame = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    assert got(frame, support=18002) == brute(rows, support=18002) and got(frame, support=18003) == {}


def test_local_supports():
    for n_words in ([5, 5, 20], [0, 7], [1] * 40, [0, 0], [10**15, 1]):
        least = C.local_supports(n_words, 30)
        assert min(least) >= 1 and sum(x - 1 for x in least) < 30


def test_edges(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and C.collocations(empty).count() == 0
    rows = [("en", "red car red car red")] * 30
    clashing = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("x") for c in ("n", "phrase", "n_lang", "hash", "a.b")})
    assert got(clashing) == brute(rows)
