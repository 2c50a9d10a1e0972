import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from textlake.llm import language as L

GREEK, CYRILLIC = "αβγδεζηθικλ", "абвгдежзийк"


@pytest.fixture(scope="module")
def model(spark):
    """From two languages in Latin and one each in Greek and Cyrillic."""
    rnd = random.Random(1)
    alphabets = {"aa": "abcde", "bb": "vwxyz", "el": GREEK, "ru": CYRILLIC}
    rows = [(k * 10 + j, " ".join("".join(rnd.choice(a) for _ in range(rnd.randint(2, 7))) for _ in range(60)), lang) for k, (lang, a) in enumerate(alphabets.items()) for j in range(8)]
    return L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def labelled(model, texts):
    return list(zip(*L._label(model, pa.record_batch([pa.array(texts, pa.string())], ["text"])), strict=True))


def test_spans_of_mixed_text(model):
    text = "Abc dab cad, ead. ΑΒΓ γδε ζηθ αβγ! вгд еже зий (бав) vwx zyx wvv yzz"
    lang, score, spans = labelled(model, ["", text, None])[1]
    assert [s["lang"] for s in spans] == ["aa", "el", "ru", "bb"]
    assert [text[s["start"] : s["end"]] for s in spans] == ["Abc dab cad, ead", "ΑΒΓ γδε ζηθ αβγ", "вгд еже зий (бав", "vwx zyx wvv yzz"]
    assert 0 < score < 1


def test_script_ranges_narrow_the_candidates(model):
    scores = L.word_scores(model, *L._words(pa.array(["abc αβγ вгд"]))[:4])
    assert (scores[1][[0, 1, 3]] < -1000).all() and scores[1][2] == 0
    assert (scores[2][[0, 1, 2]] < -1000).all() and scores[2][3] == 0


def test_no_letter_is_unknown(model):
    got = labelled(model, [None, "", "123 !! ?", "…—«»", "日本", "½ ²", "a"])
    assert [g[0] for g in got] == ["und", "und", "und", "und", got[4][0], "und", got[6][0]]
    assert got[4][0] in model.langs and got[6][0] in model.langs
    assert all(0 <= g[1] <= 1 for g in got) and [g[1] for g in got[:4]] == [0] * 4


def test_letters_are_those_of_unicode(model):
    """Digits, marks and signs beyond Latin are no letters, alone or beside other texts."""
    none = ["١٢٣ ٤٥٦", "१२३", "！？", "\ufffd \ufffd", "\u0301\u0302", "٪", "12 ٤٥٦ ..", "😀 \U0001d7ce"]
    some = ["مرحبا", "Ω", "ª", "ñ", "٤٥٦ a", "Ж!", "𐐀"]
    for texts in (none, some, [x for pair in zip(none, some) for x in pair]):
        for text, (lang, score, spans) in zip(texts, labelled(model, texts)):
            assert (lang == "und") == (text in none), text
            assert text in some or (score == 0 and not spans)


@pytest.mark.parametrize("seed", range(8))
def test_viterbi_is_the_best_path(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 7, 6)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=(offsets[-1], 3)) * 3
    prior = np.log([0.5, 0.3, 0.2])
    labels = L.viterbi(scores, np.unique(offsets), prior, penalty=2.0)

    def value(path, s):
        return prior[path[0]] + sum(s[t, k] for t, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:], strict=False))

    for a, b in zip(offsets, offsets[1:], strict=False):
        if b > a:
            every = np.stack(np.meshgrid(*[range(3)] * int(b - a), indexing="ij"), -1).reshape(-1, b - a)
            best = max(value(p, scores[a:b]) for p in every)
            assert value(labels[a:b], scores[a:b]) == pytest.approx(best)


def plain_viterbi(scores, prior, penalty):
    """One sequence, label by label; ties as documented."""
    value, back = prior + scores[0], []
    for row in scores[1:]:
        top = int(np.argmax(value))
        back.append([k if value[k] >= value[top] - penalty else top for k in range(len(row))])
        value = np.maximum(value, value[top] - penalty) + row
    path = [int(np.argmax(value))]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1]


@pytest.mark.parametrize("block", [1, 2, 7, 4096])
@pytest.mark.parametrize("seed", range(6))
def test_blocks_do_not_change_labels(monkeypatch, block, seed):
    """Also where many paths are equal in value, and at any place of a border."""
    monkeypatch.setattr(L, "BLOCK_WORDS", block)
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 60, 9)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    scores = -(rng.integers(0, 3, (offsets[-1], 4)) if seed % 2 else rng.random((offsets[-1], 4)) * 3).astype(np.float32)
    scores[::5] = -1e4 * rng.integers(0, 2, (len(scores[::5]), 4))
    scores, prior = np.rint(scores * 65536.0) / 65536, np.array([-1.0, -0.5, -0.5, -2.0])
    labels = L.viterbi(scores, offsets, prior, penalty=2.0)
    for a, b in zip(offsets, offsets[1:], strict=False):
        if b > a:
            assert labels[a:b].tolist() == plain_viterbi(scores[a:b], prior, 2.0)


def test_long_text_in_blocks(model, monkeypatch):
    rnd = random.Random(5)
    text = " ".join("".join(rnd.choice("abcdevwxyz") for _ in range(rnd.randint(1, 6))) for _ in range(20_000))
    whole = labelled(model, ["", text, "abc"])
    monkeypatch.setattr(L, "BLOCK_WORDS", 1 << 20)
    assert whole == labelled(model, ["", text, "abc"]) and len(whole[1][2]) > 10
    monkeypatch.setattr(L, "BLOCK_WORDS", 50)
    assert labelled(model, ["αβγ δεζ " * 500])[0][:2] == ("el", 1.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    held = {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    model = L.train(docs.where(~docs.doc_id.isin(list(held))))
    out = {r.doc_id: r for r in L.identify(docs, model).collect()}
    right = [out[r.doc_id].lang_pred == r.lang for r in rows if r.doc_id in held]
    assert len(right) > 200 and np.mean(right) > 0.97


def test_edges(spark, documents, model):
    docs = documents((1, "abc dea"), (1, "abc dea"), (None, "αβγ"), (2, None)).withColumnRenamed("source", "score")
    out = L.identify(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score", "spans"]
    assert sorted((r.doc_id or 0, r.lang_pred) for r in out.collect()) == [(0, "el"), (1, "aa"), (1, "aa"), (2, "und")]
    assert L.identify(docs.where("false"), model).count() == 0
    nothing = L.train(documents((1, None, "x"), (2, "abc", None)))
    assert nothing.langs == []
    assert {(r.lang_pred, r.score) for r in L.identify(docs, nothing).collect()} == {("und", 0.0)}
