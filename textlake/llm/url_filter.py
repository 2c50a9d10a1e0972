"""URL verdicts by host and path rules and by a cascade of Bloom filters.

The cascade answers exactly for every key of a known universe, without a join: level 1
encodes the listed keys, level 2 the keys of the universe that level 1 takes for listed
by mistake, level 3 the listed keys that level 2 takes for those, and so on until a
level is mistaken about none. A key is listed if the first level that rejects it is an
even one (counted from 1), or if there is none and the number of levels is odd.

The universe is the table's own distinct keys, so all its rows are judged exactly. Only
bits are gathered: positions are hashed in the tasks and words of bits are combined by
Spark. The first level has so many bits a key that it mistakes about half as many keys as
are listed, whatever the universe has, so all levels grow with the list. `MAX_BYTES` bounds
the levels of a cascade, and is checked before a level is gathered. Beyond it the keys are
cut into shards with cascades of their own, applied one after the other.

Keys are seen as 64-bit hashes. Where a listed and an unlisted key have the same one (by
chance some n * n / 2**65 of n keys) the listed one is found by a join with the few such keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm import text as T
from textlake.workspace import land

#: Rules as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: What the visible text of a page of a host to be listed says, lower-cased, as whole words.
EVIDENCE = r"(^|[^a-z0-9])(ads|track|tracker|tracking|spam|casino|adult|pills|bets|porn|malware|phishing)([^a-z0-9]|$)"
#: A host is listed if so many percent of its pages say it.
LEAST_PERCENT = 50
#: Bits per key and hashes of the levels after the first; at least that many of the first.
LATER_LEVELS = (5, 3)
MAX_BYTES = 32 << 20


def first_level(n_listed: int, n_unlisted: int) -> tuple[int, int]:
    """Bits per key and hashes, so that about n_listed / 2 of the unlisted keys are mistaken."""
    per_key = max(LATER_LEVELS[0], ceil(log2(max(2 * n_unlisted / max(n_listed, 1), 1)) / 0.6931))
    return per_key, max(LATER_LEVELS[1], round(per_key * 0.6931))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url; both empty without `://` or url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null without one; block goes first of equals."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1:]))
    rule = verdict = F.lit(None).cast("string")
    for said, own, start in reversed(order):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule, verdict = F.when(fits, own + start).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _positions(h: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """(keys, hashes) bit numbers, independent of each other: few keys have few bits, of which
    a start and a step would give too few patterns."""
    salts = T.mix(np.arange(hashes, dtype=np.uint64) + np.uint64(level << 32))
    return T.mix(h[:, None] ^ salts) % np.uint64(bits)


@dataclass
class Cascade:
    """Levels as (bits, hashes, words)."""

    levels: list[tuple[int, int, np.ndarray]]

    def listed(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), len(self.levels) % 2 == 1)
        open_ = np.arange(len(h))
        for k, (bits, hashes, words) in enumerate(self.levels):
            at = _positions(h[open_], k + 1, bits, hashes)
            hit = ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)
            out[open_[~hit]] = k % 2 == 1
            open_ = open_[hit]
        return out


def _hashes(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


class TooLarge(Exception):
    """A cascade would have more bytes than it may."""


def _level(keys: DataFrame, number: int, bits: int, hashes: int) -> tuple[int, int, np.ndarray]:
    """One filter over the `h` of `keys`."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _positions(_hashes(batch.column(0)), number, bits, hashes).reshape(-1)
            word, which = np.unique(at >> np.uint64(6), return_inverse=True)
            mask = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(mask, which, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))], ["word", "mask"])

    found = keys.select("h").mapInArrow(place, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return bits, hashes, words


def build_cascade(universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """The cascade of (h, listed): a 64-bit hash of each distinct key and whether it is listed.

    `TooLarge` is raised before the levels come to more than `max_bytes`, unless each has a
    single word.
    """
    n = {listed: k for listed, k in universe.groupBy("listed").count().collect()}
    sides = [universe.where("not listed"), universe.where("listed")]  # even, odd levels encode these
    levels: list = []
    per_key, hashes = first_level(n.get(True, 0), n.get(False, 0))
    while True:
        number = len(levels) + 1
        k = sides[number % 2].count()
        if number > 1 and k == 0:
            return Cascade(levels)
        bits = max(64, -(-k * per_key // 64) * 64)
        if sum(b for b, _, _ in levels) + bits > 8 * max_bytes and bits > 64:
            raise TooLarge
        levels.append(_level(sides[number % 2], number, bits, hashes))
        level = levels[-1]
        per_key, hashes = LATER_LEVELS

        def mistaken(batches: Iterator[pa.RecordBatch], number=number, level=level) -> Iterator[pa.RecordBatch]:
            bits, hashes, words = level
            for batch in batches:
                at = _positions(_hashes(batch.column(0)), number, bits, hashes)
                hit = ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)
                yield batch.filter(pa.array(hit))

        other = (number + 1) % 2
        sides[other] = land(sides[other].select("h").mapInArrow(mistaken, "h long"), "bloom-level")


def _hashed(key: Column) -> Column:
    return F.xxhash64(key)


def _shard(h: Column) -> Column:
    return F.xxhash64(h, F.lit(1))


def _cascades(universe: DataFrame, max_bytes: int) -> Iterator[tuple[int, int, Cascade]]:
    """(n, k, cascade) of the keys whose shard number is k modulo n, all together every key."""
    n_listed, n_keys = universe.agg(F.count_if("listed"), F.count("*")).first()
    expected = n_listed * (first_level(n_listed, n_keys - n_listed)[0] + LATER_LEVELS[0]) // 8
    n = expected // max_bytes + 1
    open_ = [(n, k) for k in range(n)]
    while open_:
        n, k = open_.pop()
        try:
            yield n, k, build_cascade(universe.where(F.pmod(_shard(F.col("h")), F.lit(n)) == k), max_bytes)
        except TooLarge:
            open_ += [(2 * n, k), (2 * n, k + n)]


def member_of_list(rows: DataFrame, key: str, listed_keys: DataFrame, new: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """`rows` with a boolean column `new`: is the string in `key` one of `listed_keys`?

    Exact for all rows: the universe is the distinct keys of `rows` and of the list. A null
    key is not listed, and a null on the list has no effect. A column named `new` is replaced.
    """
    listed = listed_keys.select(F.col(listed_keys.columns[0]).cast("string").alias("key"), F.lit(True).alias("listed"))
    every = rows.select(F.col(f"`{key}`").cast("string").alias("key"), F.lit(False).alias("listed")).unionByName(listed).dropna()
    every = land(every.groupBy("key").agg(F.max("listed").alias("listed")).withColumn("h", _hashed(F.col("key"))), "url-keys")
    # a hash of both kinds is encoded as unlisted, its listed keys are joined
    universe = land(every.groupBy("h").agg(F.every("listed").alias("listed"), F.some("listed").alias("some")), "url-hashes")
    mixed = land(every.where("listed").join(universe.where("some and not listed").select("h"), "h", "left_semi").select("key"), "mixed-keys")

    columns = [c for c in rows.columns if c != new]
    h = _hashed(F.col(f"`{key}`").cast("string"))
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), h.alias("h"), _shard(h).alias("shard"), F.lit(False).alias("listed"))
    schema = T.row_schema(rows, "h long, shard long, listed boolean")
    for n, k, cascade in _cascades(universe.select("h", "listed"), max_bytes):
        sent = rows.sparkSession.sparkContext.broadcast(cascade)

        def judge(batches: Iterator[pa.RecordBatch], n=n, k=k, sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column("shard").to_numpy(zero_copy_only=False) % n == k
                out = batch.column("listed").to_numpy(zero_copy_only=False).copy()
                out[own] = sent.value.listed(_hashes(batch.column("h"))[own])
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("h"), batch.column("shard"), pa.array(out, pa.bool_())], batch.schema.names)

        rows = rows.mapInArrow(judge, schema)
    own_key, hit = F.col(f"row.`{key}`"), F.col("listed")
    if not mixed.isEmpty():
        rows = rows.join(mixed.withColumnRenamed("key", "mixed_key"), own_key.cast("string") == F.col("mixed_key"), "left")
        hit = hit | F.col("mixed_key").isNotNull()
    return rows.select(*[F.col(f"row.`{c}`") for c in columns], (hit & own_key.isNotNull()).alias(new))


def judge_urls(pages: DataFrame, listed_hosts: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages` (page_id, url).

    The verdict is that of the longest rule that fits; without one it is block for a
    listed host and allow for all others. A null url or one without `://` has an empty
    host and path. Other columns are not read.
    """
    host, path = split_url(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    rows = member_of_list(rows, "host", listed_hosts, "listed")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    otherwise = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, otherwise).alias("verdict"))


def hosts_by_evidence(pages: DataFrame, evidence: str = EVIDENCE, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """(host): the hosts of `pages` (url, html) of whose pages `least_percent` or more say `evidence`.

    Only text outside of tags and scripts counts, with A-Z lower-cased. Pages are counted per
    host by Spark, combined before the shuffle, so a host may have any share of the rows. A
    page without html says nothing; pages without host are not judged.
    """
    host, _ = split_url(F.col("url").cast("string"))
    text = F.regexp_replace(F.translate(F.col("html").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"(?s)<script.*?</script>|<[^>]*>", " ")
    said = pages.select(host.alias("host"), F.coalesce(text.rlike(evidence), F.lit(False)).alias("said")).where("host <> ''")
    counts = said.groupBy("host").agg(F.count("*").alias("n"), F.count_if("said").alias("n_said"))
    return counts.where(100 * F.col("n_said") >= least_percent * F.col("n")).select("host")
