import random

import pytest

from textlake.llm import quotes as Q
from textlake.llm.queries import QUERIES, quoting


def test_parse():
    text = "Hi,\nOn Monday X wrote:\n> > deep line\n> >more\n> top\n\n> again\nanswer > not a quote\n\n\nbye"
    own, passages = Q.parse(text)
    assert own == "Hi,\nanswer > not a quote\n\n\nbye"
    assert passages == [(2, "deep line\nmore"), (1, "top"), (1, "again")]
    assert Q.parse(None) == (None, []) and Q.parse("a > b") == ("a > b", [])
    assert Q.parse("> only") == ("", [(1, "only")])


def test_sentences_are_normalised():
    assert Q.sentences("Hello,  WORLD! How\nare you?") == Q.sentences("hello world. how are -- you")
    assert Q.sentences(" ...!? ") == [] and len(Q.sentences("a. A! a?")) == 1


def expected(rows):
    """By looking through all earlier messages."""
    parsed = [(c, t, *Q.parse(x)) for c, t, _, x in rows]
    own = {}
    for c, t, text, _ in parsed:
        if c is not None and t is not None:
            own.setdefault(c, {}).setdefault(t, set()).update(Q.sentences(text or ""))
    replies = {}
    for c, t, _, passages in parsed:
        best = None
        for level, p in passages:
            units = set(Q.sentences(p))
            votes = {s: len(units & said) for s, said in own.get(c, {}).items() if t is not None and s < t and units & said}
            if votes:
                n, source = max((n, s) for s, n in votes.items())
                if 2 * n >= len(units):
                    best = max([best, (-level, n, source)] if best else [(-level, n, source)])
        if best:
            replies[c, t] = best[2]
    out = []
    for c, t, text, _ in parsed:
        thread, depth = t, 0
        while (c, thread) in replies:
            thread, depth = replies[c, thread], depth + 1
        out.append((c, t, text, replies.get((c, t)), thread, depth))
    return out


def test_random_conversations(spark, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK_TURNS", 4)
    rnd = random.Random(3)
    pool = [f"Sentence number {i} here." for i in range(25)]
    rows = []
    for c in range(12):
        said = []
        for t in range(rnd.randint(1, 30)):
            lines = [rnd.choice(pool) for _ in range(rnd.randint(1, 3))]
            quoted = []
            if said and rnd.random() < 0.7:
                source = rnd.choice(said[-3:])
                quoted = ["> " + x.upper() for x in source.split("\n")[: rnd.randint(1, 4)]]
                if rnd.random() < 0.2:
                    quoted.append("> Nobody said this.")
            text = "\n".join(quoted + lines)
            said.append(text)
            rows.append((c, t * 3, "user", text))
    rnd.shuffle(rows)
    got = Q.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = expected(rows)
    assert sum(w[3] is not None for w in want) > 60 and max(w[5] for w in want) > 3
    assert sorted((r.conv_id, r.turn, r.text, r.reply_to, r.thread, r.depth) for r in got) == sorted(want)
    place = {(r.conv_id, r.turn): k for k, r in enumerate(got)}
    assert all(place[r.conv_id, r.reply_to] < place[r.conv_id, r.turn] for r in got if r.reply_to is not None)


def test_a_long_chain(spark):
    rows = [(1, t, "user", (f"> Remark {t - 1}.\n" if t else "") + f"Remark {t}.") for t in range(300)]
    got = Q.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r.turn, r.thread, r.depth) for r in got] == [(t, 0, t) for t in range(300)]


def test_edges(spark):
    rows = [(1, 0, None, "Fine day."), (1, 0, "user", "Other words."), (1, 1, "user", "> Other words.\nyes"), (1, 1, "user", "> Other words.\nyes"),
            (None, 1, "user", "> Fine day.\nx"), (2, None, "user", "> Fine day.\nx"), (3, 0, "user", None), (3, 1, "user", ""), (4, 5, "user", "> Later.\na"), (4, 6, "user", "Later.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = Q.link_quotations(frame.withColumnRenamed("role", "unit").selectExpr("*", "unit AS role", "1 AS passage"))
    got = {(r.conv_id, r.turn, r.text): (r.n_quoted, r.n_linked, r.reply_to, r.thread, r.depth) for r in out.collect()}
    assert out.count() == 10
    assert got[1, 1, "yes"] == (1, 1, 0, 0, 1) and got[None, 1, "x"] == (1, 0, None, 1, 0) and got[2, None, "x"] == (1, 0, None, None, 0)
    assert got[3, 0, None] == (0, 0, None, 0, 0) and got[3, 1, ""] == (0, 0, None, 1, 0) and got[4, 5, "a"] == (1, 0, None, 5, 0)
    assert Q.link_quotations(frame.where("false")).count() == 0


def best_of_all(rows):
    """reply_to of (conv_id, turn), counting each passage's sentences in every earlier message."""
    own, passages = {}, {}
    for c, t, _, x in rows:
        text, quoted = Q.parse(x)
        own.setdefault(c, {})[t] = set(Q.sentences(text or ""))
        passages[c, t] = quoted
    replies = {}
    for (c, t), quoted in passages.items():
        found = []
        for level, p in quoted:
            units = set(Q.sentences(p))
            n, source = max(((len(units & own[c][s]), s) for s in own[c] if s < t), default=(0, None))
            if n and 2 * n >= len(units):
                found.append((-level, n, source))
        if found:
            replies[c, t] = max(found)[2]
    return replies


def replies_of(spark, rows):
    got = Q.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    return {(r.conv_id, r.turn): r.reply_to for r in got if r.reply_to is not None}


def test_recurring_sentences_count_for_every_earlier_message(spark):
    passage = ["One.", "Two.", "Three.", "Four.", "Five."]
    rows = [(1, 0, "user", "I fixed the parser. Thanks."), (1, 2, "user", "Thanks."), (1, 3, "user", "> I fixed the parser. Thanks.\nok")]
    rows += [(2, 0, "user", " ".join(passage)), *((2, t, "user", f"{x} Said again.") for t, x in enumerate(passage, 1)), (2, 9, "user", "> " + " ".join(passage))]
    assert replies_of(spark, rows) == {(1, 3): 0, (2, 9): 0}


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_most_sentences_of_all_earlier_messages(spark, monkeypatch, hot):
    monkeypatch.setattr(Q, "BLOCK_TURNS", 4)
    monkeypatch.setattr(Q, "HOT", hot)
    rnd = random.Random(hot)
    pool = [f"Sentence number {i} here." for i in range(12)]
    rows = []
    for c in range(8):
        for t in range(25):
            quoted = ["> " + " ".join(rnd.choices(pool, k=rnd.randint(1, 6)))] if rnd.random() < 0.6 else []
            quoted += [">> " + " ".join(rnd.choices(pool, k=3))] if rnd.random() < 0.3 else []
            said = rnd.choices(pool[:6] if c % 2 else pool, k=rnd.randint(0, 5)) + [f"Only in {t}."] * (t % 2)
            rows.append((c, t * 3, "user", "\n".join([*quoted, " ".join(said)])))
    want = best_of_all(rows)
    assert len(want) > 80 and replies_of(spark, rows) == want


def test_linking_of_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in quoting(spark.read.parquet(f"{folder}/conversations.parquet")).collect()]
    assert sum(x.startswith(">") for *_, x in rows) > len(rows) // 3
    got = QUERIES["op2_quoted_replies"](spark, folder).collect()
    want = best_of_all(rows)
    assert len(got) == len(rows) and {(r.conv_id, r.turn): r.reply_to for r in got if r.reply_to is not None} == want and want
