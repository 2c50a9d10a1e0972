"""Conversations in reply order, without their quotations.

A line's quote level is the number of `>` before it; a passage is a run of lines of
one level. A passage and the own (level 0) text of a message are cut into sentences;
a sentence is normalised (letters and digits in lower case, single spaces) and hashed.
Hashes of quoted sentences are joined to those of earlier messages of the same
conversation. A passage is linked to the message that has most of its sentences, at
least half, the latest one of equals. A message replies to the source of its shallowest
linked passage; threads and depths follow by pointer doubling along these links.

All earlier messages are counted. A sentence that more than `HOT` messages of its
conversation have makes no pairs: the passages and the messages are reduced to their
distinct sets of such sentences, sets are compared with sets, and the latest earlier
message of each number of shared sentences is found by a running maximum, in blocks of
`BLOCK_TURNS` turns and then over blocks. A message that also has a rarer sentence of
the passage is met by that one and counted in full.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.workspace import land

BLOCK_TURNS = 1024
HOT = 64
_PASSAGE = ["conv_id", "turn", "passage", "level"]

_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
_SENTENCE = re.compile(r"[^.!?]+[.!?]*")
_WORDS = re.compile(r"[^\W_]+")
#: The line that mail programs put before a quotation.
_ATTRIBUTION = re.compile(r".*\b(?:wrote|writes|said|schrieb|escribió|a écrit)\b.*:\s*$")


def sentences(text: str) -> list[int]:
    """The distinct hashes of a text's normalised sentences, in order."""
    out = {}
    for s in _SENTENCE.findall(text):
        words = " ".join(_WORDS.findall(s.lower()))
        if words:
            out[int.from_bytes(hashlib.blake2b(words.encode(), digest_size=8).digest(), "little", signed=True)] = None
    return list(out)


def parse(text: str | None) -> tuple[str | None, list[tuple[int, str]]]:
    """The own text without quotations, and the passages as (level, text).

    A line that names the author of the quotation right below it goes with that; empty
    lines around removed passages are closed up.
    """
    if text is None or ">" not in text:
        return text, []
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    before, run = 0, 0  # the levels of the last line that counts, and of the line above
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks.group(1).count(">") if marks else 0
        if level == 0:
            if before == 0 or line.strip():
                own.append(line)
                before = 0
            run = 0
            continue
        if before == 0:
            while own and not own[-1].strip():
                own.pop()
            if own and _ATTRIBUTION.match(own[-1]):
                own.pop()
        if level != run:
            passages.append((level, []))
        passages[-1][1].append(line[marks.end() :])
        before = run = level
    if not passages:
        return text, []
    return "\n".join(own).strip("\n"), [(level, "\n".join(lines)) for level, lines in passages]


PARSED = "conv_id long, turn long, role string, text string, own array<bigint>, passages array<struct<level:int,units:array<bigint>>>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    units = pa.list_(pa.int64())
    passage = pa.list_(pa.struct([("level", pa.int32()), ("units", units)]))
    for batch in batches:
        texts, own, quoted = [], [], []
        for raw in batch.column("text").to_pylist():
            text, passages = parse(raw)
            texts.append(text)
            own.append(sentences(text or ""))
            quoted.append([{"level": level, "units": sentences(p)} for level, p in passages])
        arrays = [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(texts, pa.string()), pa.array(own, units), pa.array(quoted, passage)]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "turn", "role", "text", "own", "passages"])


def _latest_source(own: DataFrame, quoted: DataFrame) -> DataFrame:
    """`quoted` (conv_id, unit, turn, ...) with the latest smaller turn of `own` that has the unit."""
    key = ["conv_id", "unit"]
    block = F.floor(F.col("turn") / BLOCK_TURNS).alias("block")
    own = own.join(quoted.select(*key).distinct(), key, "left_semi")
    per_block = own.groupBy(*key, block).agg(F.max("turn").alias("last"))
    # what the blocks before have, for each block that asks or has
    asked = quoted.select(*key, block).distinct().join(per_block, [*key, "block"], "full")
    earlier = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = asked.select(*key, "block", F.max("last").over(earlier).alias("carried"))
    inside = Window.partitionBy(*key, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    rows = own.select(*key, "turn", F.col("turn").alias("source"), F.lit(None).cast("int").alias("passage"), F.lit(None).cast("int").alias("level"), block)
    rows = rows.unionByName(quoted.select(*key, "turn", F.lit(None).cast("long").alias("source"), "passage", "level", block))
    rows = rows.withColumn("near", F.max("source").over(inside)).where("passage is not null")
    return rows.join(carried, [*key, "block"]).withColumn("source", F.greatest("near", "carried")).where("source is not null").select(*key, "turn", "passage", "level", "source")


def _votes(own: DataFrame, quoted: DataFrame) -> DataFrame:
    """(conv_id, turn, passage, level, n_units, votes, source): earlier messages that have at
    least half of a passage's sentences; the best of them is among the rows.

    `own` (conv_id, turn, unit) and `quoted` (conv_id, turn, passage, level, unit) are distinct.
    """
    key = ["conv_id", "unit"]
    own = land(own.join(quoted.select(*key).distinct(), key, "left_semi"), "sources")
    counts = land(own.groupBy(*key).agg(F.count("*").alias("df")), "source-counts")
    hot = counts.where(F.col("df") > HOT)
    hot_sets = own.join(hot, key).groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list("unit")).alias("theirs"))
    hot_sets = land(hot_sets, "hot-sources")
    ranked = F.when(F.col("df") > HOT, F.struct("df", "unit"))
    asked = quoted.join(counts, key, "left").groupBy(*_PASSAGE).agg(F.count("*").alias("n_units"), F.sort_array(F.collect_list(ranked)).alias("hot"))
    asked = land(asked, "passages")

    # by a rare sentence: at most HOT messages for each
    rare = counts.where(F.col("df") <= HOT).select(*key)
    sources = own.join(rare, key).withColumnRenamed("turn", "source")
    met = quoted.join(sources, key).where("source < turn").groupBy(*_PASSAGE, "source").agg(F.count("*").alias("votes"))
    met = met.join(asked, _PASSAGE).where("2 * (votes + size(hot)) >= n_units")
    met = met.join(hot_sets.withColumnRenamed("turn", "source"), ["conv_id", "source"], "left")
    met = met.withColumn("votes", F.expr("votes + coalesce(size(array_intersect(hot.unit, theirs)), 0)"))

    # by hot sentences alone
    asked = asked.where("size(hot) > 0 and 2 * size(hot) >= n_units")
    sets = asked.groupBy("conv_id", "hot").agg(F.min("n_units").alias("least"))
    # a set with at least half of the sentences has one of the rarest that leave fewer than half
    first = F.expr("slice(hot.unit, 1, size(hot) - int((least + 1) div 2) + 1)")
    sets = sets.select("conv_id", "hot", "least", F.explode(first).alias("unit"))
    kinds = hot_sets.select("conv_id", "theirs").distinct().select("conv_id", "theirs", F.explode("theirs").alias("unit"))
    shared = F.expr("size(array_intersect(hot.unit, theirs))")
    alike = sets.join(kinds, key).where(2 * shared >= F.col("least")).select("conv_id", "hot", "theirs", shared.cast("long").alias("votes")).distinct()
    alike = land(alike.select("conv_id", "theirs", F.struct("hot", "votes").alias("unit")), "hot-pairs")
    having = hot_sets.join(alike, ["conv_id", "theirs"]).select("conv_id", "turn", "unit").distinct()
    asking = asked.join(alike.select("conv_id", "unit").distinct().withColumn("hot", F.col("unit.hot")), ["conv_id", "hot"])
    latest = _latest_source(having, asking.select(*_PASSAGE, "unit")).select(*_PASSAGE, F.col("unit.votes").alias("votes"), "source")
    latest = latest.join(asked.select(*_PASSAGE, "n_units"), _PASSAGE)
    columns = [*_PASSAGE, "n_units", "votes", "source"]
    return met.select(*columns).unionByName(latest.select(*columns)).where("2 * votes >= n_units")


def _threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth) of messages that reply, by pointer doubling.

    A message whose pointer has reached the opening of its thread is settled. Later rounds
    move the others only, and read the settled ones of their conversations alone.
    """
    node = ["conv_id", "turn"]
    start = replies.select(*node, F.col("reply_to").alias("up"), F.lit(1).cast("long").alias("depth"))
    answers = replies.select("conv_id", F.col("turn").alias("up"))
    settled = [land(start.join(answers, ["conv_id", "up"], "left_anti").select(*node, "up", "depth"), "settled-replies")]
    moving = land(start.join(answers, ["conv_id", "up"], "left_semi").select(*node, "up", "depth"), "moving-replies")
    while not moving.isEmpty():
        still = moving.select("conv_id").distinct()
        reached = functools.reduce(DataFrame.unionByName, settled).join(still, "conv_id", "left_semi").withColumn("done", F.lit(True))
        above = reached.unionByName(moving.withColumn("done", F.lit(False)))
        above = above.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"), "done")
        hops = moving.join(above, ["conv_id", "up"]).select(*node, F.col("further").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), "done")
        hops = land(hops, "hops")
        settled.append(hops.where("done").drop("done"))
        moving = hops.where("not done").drop("done")
    return functools.reduce(DataFrame.unionByName, settled).withColumnRenamed("up", "thread")


def link_quotations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n_quoted, n_linked, reply_to, thread, depth), in reply order.

    `text` is without quotations; n_quoted passages were cut out, n_linked of them have
    a source. reply_to is a turn, null for a message that opens a thread; thread is the
    turn that opened it, depth the number of replies since. Rows are sorted by
    conv_id, thread, depth and turn, so that all stand after what they reply to.

    Every row is kept. Rows of one conv_id and turn are versions of a message and share
    their links; a row without conv_id or turn has none and is its own thread (its
    turn). A null text stays null. Columns other than the four are not read.
    """
    columns = [F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")]
    parsed = land(messages.select(*columns).mapInArrow(_parsed, PARSED), "messages")
    placed = parsed.where("conv_id is not null and turn is not null")
    own = placed.select("conv_id", "turn", F.explode("own").alias("unit")).distinct()
    passages = placed.where("size(passages) > 0").select("conv_id", "turn", F.posexplode("passages").alias("passage", "p"))
    # versions of a message count their passages together, by place
    quoted = land(passages.select("conv_id", "turn", "passage", "p.level", F.explode("p.units").alias("unit")).distinct(), "quoted")
    linked = _votes(own, quoted).groupBy(*_PASSAGE).agg(F.max(F.struct("votes", "source")).alias("best"))
    replies = linked.groupBy("conv_id", "turn").agg(
        F.max_by("best.source", F.struct(-F.col("level"), "best.votes", "best.source")).alias("reply_to"), F.count("*").alias("n_linked")
    )
    replies = land(replies, "reply-links")
    found = replies.join(_threads(replies), ["conv_id", "turn"])
    out = parsed.join(found, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "text", F.size("passages").cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
        "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
    ).orderBy("conv_id", "thread", "depth", "turn")
