"""Against a set of all earlier strings."""

import hashlib
import random

import pytest

from textlake.llm import repeats as R


def expected(docs):
    """(doc_id, n_bytes, n_removed, n_spans, kept) with the rows of one id seen together."""
    out, seen = [], set()
    by_id = {}
    for i, t in docs:
        by_id.setdefault(2**63 if i is None else i, []).append((i, (t or "").encode()))
    for key in sorted(by_id):
        new = set()
        for i, b in by_id[key]:
            mask = bytearray(len(b))
            for k in range(len(b) - R.LENGTH + 1):
                s = b[k : k + R.LENGTH]
                new.add(s)
                if s in seen:
                    mask[k : k + R.LENGTH] = b"\1" * R.LENGTH
            spans = sum(m and (k == 0 or not mask[k - 1]) for k, m in enumerate(mask))
            out.append((i, len(b), sum(mask), spans, bytes(c for c, m in zip(b, mask, strict=True) if not m)))
        seen |= new
    return sorted(out, key=str)


def got(docs):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in R.remove_repeats(docs).collect()), key=str)


def test_small_tables(small):
    assert got(small) == expected([(r.doc_id, r.text) for r in small.collect()])


@pytest.mark.parametrize("chunk, piece", [(600, 300), (4 << 20, 1 << 18)])
def test_overlapping_copies(documents, monkeypatch, chunk, piece):
    """Many chunks and ranges, pieces that cut texts and strings."""
    monkeypatch.setattr(R, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(R, "RANGE_BYTES", 2 * chunk)
    monkeypatch.setattr(R, "_PIECE", piece)
    rnd = random.Random(7)
    passages = ["".join(rnd.choice("abc é") for _ in range(rnd.randint(30, 260))) for _ in range(8)]
    docs = []
    for i in range(90):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            parts.append(rnd.choice([p, p[a:], p[:a], "".join(rnd.choice("abcd ") for _ in range(30))]))
        docs.append((i * 7 % 90, "".join(parts)))
    docs += [(100 + i, "ab" * 200) for i in range(5)] + [(200, "a" * 1000), (201, "a" * 49), (202, "a" * 50)]
    assert got(documents(*docs)) == expected(docs)


def test_a_hot_passage(documents):
    passage = "".join(random.Random(1).choice("abcdefgh ") for _ in range(120))
    docs = [(i, f"{i} " + (passage if i % 3 == 0 else "") + f" tail of {i}" * 5) for i in range(300)]
    assert got(documents(*docs)) == expected(docs)


def test_edges(documents):
    t = "x" * 20 + "".join(chr(97 + k % 26) for k in range(60))
    docs = [(4, t), (4, t), (2, None), (3, ""), (None, t), (None, t), (9, t), (1, "short")]
    frame = documents(*docs).withColumnRenamed("lang", "chunk")
    assert got(frame) == expected(docs)
    assert got(documents((1, t), (None, t))) == expected([(1, t), (None, t)])
    assert R.remove_repeats(frame.where("false")).count() == 0
    assert got(documents((1, None))) == [(1, 0, 0, 0, b"")]
    digest = R.remove_repeats(documents((1, "abc")), digest=True).first().kept
    assert bytes(digest) == hashlib.sha256(b"abc").digest()
