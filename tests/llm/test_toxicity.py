import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textlake.llm import toxicity as X
from textlake.llm.queries import QUERIES


def made(seed=0, n=30):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(["alpha", "beta,", "Gamma", "dé", "x1", "idiot!"]) for _ in range(rnd.randint(0, 90))) for _ in range(n)]


def test_words_and_windows():
    texts = X.Texts(pa.array(["Idiot, idiot! a-b", None, "", " ..", "é1 É1"]))
    assert np.diff(texts.offsets).tolist() == [4, 0, 0, 0, 2]
    assert texts.ids[0] == texts.ids[1] and len(set(texts.ids.tolist())) == 5
    for n in (1, 16, 32, 33, 48, 49, 200):
        starts, ends, bounds = X.Texts(pa.array([" ".join("w" * n)])).windows()
        assert starts[0] == 0 and ends[-1] == n and (ends - starts <= X.STEPS).all()
        assert (starts[1:] == starts[:-1] + X.STRIDE).all() and (starts[1:] < ends[:-1]).all()
        assert len(starts) == max(0, -(-(n - X.STEPS) // X.STRIDE)) + 1


def test_trigrams_are_of_the_word():
    one, many = X.Texts(pa.array(["abc"])), X.Texts(pa.array(["zz abc q", "yy"]))
    k = int(np.flatnonzero(many.hashes == one.hashes[0])[0])
    assert many.trigrams[many.spans[k] : many.spans[k + 1]].tolist() == one.trigrams.tolist() and len(one.trigrams) == 3


def test_gradient():
    """Against differences, in 64 bits."""
    texts = X.Texts(pa.array(made()))
    weights = {k: v.astype(np.float64) for k, v in X.initial(np.sort(texts.hashes)[1:4]).items()}
    vocabulary = np.sort(texts.hashes)[1:4]
    starts, ends, _ = texts.windows()
    rng = np.random.default_rng(1)
    own = rng.choice(len(starts), 40)
    labels, weight = rng.integers(0, 2, 40).astype(float), rng.random(40)

    def loss():
        return X.gradient(weights, X.table_rows(vocabulary, texts), texts, starts[own], ends[own], labels, weight)

    slope = loss()[1]
    for name, v in weights.items():
        flat = v.reshape(-1)
        places = np.argsort(-np.abs(slope[name].reshape(-1)))[:4]
        for at in places:
            if name == "words" and at < X.WORD:
                continue
            before = flat[at]
            flat[at] = before + 1e-2
            high = loss()[0]
            flat[at] = before - 1e-2
            low = loss()[0]
            flat[at] = before
            assert slope[name].reshape(-1)[at] == pytest.approx((high - low) / 2e-2, rel=0.05, abs=2e-5), name


def test_padding_and_batch_do_not_matter():
    texts = made(3, 40)
    weights, vocabulary = X.learn(texts, [i % 2 for i in range(40)], [1.0] * 40, passes=2)
    together = X.scores(weights, vocabulary, pa.array(texts))
    alone = [X.scores(weights, vocabulary, pa.array([t]))[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-5)
    logits = [X.window_logits(weights, vocabulary, X.Texts(pa.array([t])))[0] for t in texts]
    bias = 1 / (1 + np.exp(-weights["bias"][0]))
    assert alone == pytest.approx([1 / (1 + np.exp(-x.max())) if len(x) else bias for x in logits], abs=1e-6)


def test_window_by_plain_loops():
    """One window, by scalar formulas."""
    texts = X.Texts(pa.array(["alpha beta gamma idiot beta"]))
    weights = X.initial(np.sort(texts.hashes)[:2])
    vocabulary = np.sort(texts.hashes)[:2]
    x = X.inputs(weights, X.table_rows(vocabulary, texts), texts, np.arange(len(texts.hashes)))
    states = []
    sig = lambda v: 1 / (1 + np.exp(-v))
    for way, order in (("f", range(5)), ("b", range(4, -1, -1))):
        h, out, n = np.zeros(X.HIDDEN), {}, X.HIDDEN
        for t in order:
            g, u = x[texts.ids[t]] @ weights[f"W{way}"] + weights[f"c{way}"], h @ weights[f"U{way}"]
            z, r = sig(g[:n] + u[:n]), sig(g[n : 2 * n] + u[n : 2 * n])
            h = (1 - z) * np.tanh(g[2 * n :] + r * u[2 * n :]) + z * h
            out[t] = h
        states.append(out)
    both = np.array([np.concatenate([states[0][t], states[1][t]]) for t in range(5)])
    heat = np.exp(both @ weights["attend"])
    want = (heat / heat.sum()) @ both @ weights["out"] + weights["bias"][0]
    assert X.window_logits(weights, vocabulary, texts)[0] == pytest.approx([want], abs=1e-4)


def test_held_out_accuracy(spark):
    """By labels that the model has not seen, over the texts whose label their words explain."""
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op13_toxicity"](spark, sf).collect()}
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == len(docs)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    rude = {"moron", "pathetic", "disgusting", "worthless", "loser", "idiot", "trash", "stupid", "clown", "scum"}
    asked = [i for i in rows if rows[i].held_out and i in truth]
    insulting = [i for i in asked if truth[i] and rude & set(docs[i].lower().replace(".", " ").replace(",", " ").split())]
    clean = [i for i in asked if not truth[i]]
    assert len(insulting) > 60 and len(clean) > 900
    assert np.mean([rows[i].predicted for i in insulting]) >= 0.95
    assert np.mean([rows[i].predicted for i in clean]) <= 0.02


def test_edges(spark, documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    docs = documents((1, "you idiot " * 9), (2, "fine day " * 9), (2, "fine day " * 9), (None, "x"), (3, None), (4, ""), (5, "long words " * 90_000))
    model = X.train(docs, labels)
    clashing = docs.withColumns({"row": F.lit(1), "score": F.lit("old"), "a.b": F.lit(2)})
    rows = X.score_texts(clashing, model)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "a.b", "score", "predicted"] and rows.count() == 7
    by_id = {r.doc_id: r.score for r in rows.collect()}
    assert by_id[3] == by_id[4] and by_id[1] > by_id[2]
    none = X.train(docs.where("false"), labels.where("false"))
    assert {r.predicted for r in X.score_texts(docs, none).collect()} == {0} and X.score_texts(docs.where("false"), none).count() == 0
