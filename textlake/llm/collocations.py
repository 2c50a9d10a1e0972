"""Collocations of each language: phrases of words that occur together unusually often.

Phrases are mined by partitioning (Savasere, Omiecinski and Navathe, 1995). The corpus is
dealt to a few shards, each of many tasks. A phrase with `support` occurrences has, in at
least one shard with n of the corpus's N words, as many as support * n / N: so each shard
is mined completely at that local support, the locally frequent phrases of all shards
are united, and all tasks count the united ones exactly. As the number of shards is
fixed, so is the local support, whatever the size of the corpus.

A locally frequent phrase joins the union only if the most that all shards together can
have of it, one less than its local support in each shard that did not name it, reaches the
support. The union is sent to the shards as a bitmap of hashes of fixed size (`BITS`), as
it grows with the corpus: a phrase that shares its bit with another is counted too, by its
words, and dropped by its exact count. So the size of the bitmap changes no row. Longer
phrases need frequent parts: two words are mined among frequent words, then three and four
words among frequent pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm import text as T
from textlake.workspace import land

SUPPORT, LONGEST, TOP, COVERED = 30, 4, 2000, 80
#: Shards of the corpus, words whose phrases a task holds, bits of a bitmap, bytes of text cut into words at once.
SHARDS, HELD_WORDS, BITS, CHUNK_BYTES = 8, 1 << 22, 1 << 25, 2 << 20
_BLOCK = 32_768
_MOST = 4095

_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Words:
    """The words of a run of bytes that holds whole texts or whole pieces of one.

    codes: a number for each word; spelled: the numbered words; hashes: 64 bits of
    language and word; pieces: changes from one piece of a text to the next; row: the text
    that each is from; starts, ends: places in `joined`, all words with a space after each.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        ends_piece = _ENDS[data]
        solid = ~(ends_piece | _GAP[data])
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets[:-1]] = True
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= ~solid[:-1] | edge[1:-1]
        closes[:-1] &= ~solid[1:] | edge[1:-1]
        first = np.flatnonzero(opens)
        lengths = np.flatnonzero(closes) + 1 - first
        self.row = np.searchsorted(offsets, first, "right") - 1
        self.pieces = np.cumsum(ends_piece, dtype=np.int32)[first] + self.row
        letters = _LOWER[data[solid]]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        word = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode()
        self.codes, self.spelled = word.indices.to_numpy(), word.dictionary
        own = T.words(*T.text_bytes(self.spelled), lower=False)[0]
        self.hashes = T.mix(own[self.codes] + seeds[self.row])
        self.starts = bounds[:-1] + np.arange(len(first))
        self.ends = self.starts + lengths
        self.joined = np.full(len(letters) + len(first), 0x20, np.uint8)
        self.joined[np.arange(len(letters)) + np.repeat(np.arange(len(first)), lengths)] = letters

    def phrase_hashes(self, size: int) -> np.ndarray:
        """The hash of the `size` words from each word on, whether or not they are in one piece."""
        out = self.hashes[: max(len(self.hashes) - size + 1, 0)].copy()
        for k in range(1, size):
            out = T.mix(out * T.U64(0x9E3779B97F4A7C15) + self.hashes[k : k + len(out)])
        return out

    def inside(self, size: int) -> np.ndarray:
        """Is it one piece, for the `size` words from each word on?"""
        n = max(len(self.codes) - size + 1, 0)
        return self.pieces[:n] == self.pieces[size - 1 : size - 1 + n]

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The `size` words from each of the words `at` on, with a space between."""
        lengths = self.ends[at + size - 1] - self.starts[at]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(bounds[-1]) + np.repeat(self.starts[at] - bounds[:-1], lengths)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(self.joined[take])).cast(pa.string())


def _seeds(langs: list[str]) -> np.ndarray:
    own = {lang: int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little") for lang in set(langs)}
    return np.array([own[lang] for lang in langs], T.U64)


def chunks(batch: pa.RecordBatch, limit: int | None = None) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Rows and their words, some `limit` bytes at once; a longer text is cut where a piece ends."""
    limit = limit or CHUNK_BYTES
    for rows in T.slices(batch, "text", limit):
        data, offsets = T.text_bytes(rows.column("text"))
        seeds = _seeds(rows.column("lang").to_pylist())
        if rows.num_rows > 1 or len(data) <= limit:
            yield rows, Words(data, offsets, seeds)
            continue
        cuts = np.flatnonzero(_ENDS[data])
        start = 0
        while start < len(data):
            k = np.searchsorted(cuts, start + limit)
            stop = int(cuts[k]) + 1 if k < len(cuts) and start + limit < len(data) else len(data)
            yield rows, Words(data[start:stop], np.array([0, stop - start]), seeds)
            start = stop


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % T.U64(len(bits) * 8)
    return (bits[at >> T.U64(3)] >> (at & T.U64(7)).astype(np.uint8)) & 1 == 1


@T.task("collocations")
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, size, n): single words; and for each language all the task's words, with
    phrase null and the task's number as size."""
    task = TaskContext.get().partitionId()
    for batch in batches:
        for rows, words in chunks(batch):
            langs = rows.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy()[words.row].astype(np.int64)
            keys, counts = np.unique(lang * max(len(words.spelled), 1) + words.codes, return_counts=True)
            totals = np.bincount(lang, minlength=len(langs.dictionary))
            spelled = words.spelled.take(pa.array(keys % max(len(words.spelled), 1))).cast(pa.large_string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([langs.dictionary.take(pa.array(keys // max(len(words.spelled), 1))), langs.dictionary]),
                    pa.concat_arrays([spelled.cast(pa.string()), pa.nulls(len(totals), pa.string())]),
                    pa.array(np.repeat([1, task], [len(keys), len(totals)]), pa.int32()),
                    pa.array(np.concatenate([counts, totals]), pa.int64()),
                ],
                ["lang", "phrase", "size", "n"],
            )


def _mine(sizes: list[int], frequent, shards: int, held_words: int):
    """(packed) of the phrases whose parts are frequent, added up over some `held_words` words of
    a task; the task's rows are of the shard that its number says.

    `frequent` is the broadcast bitmap of the parts that a phrase is made of, and their
    size. A number packs 48 bits of a hash, 4 of the shard and 12 of the count; a larger
    count takes several.
    """
    bits, part = frequent

    @T.task("collocations")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        held: list[np.ndarray] = []
        total = 0

        def mined() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate([np.zeros(0, T.U64), *held]), return_counts=True)
            held.clear()
            times = -(-counts // _MOST)
            n = np.full(times.sum(), _MOST)
            n[np.cumsum(times) - 1] = counts - _MOST * (times - 1)
            packed = np.repeat(hashes << T.U64(16), times) | T.U64(shard << 12) | n.astype(T.U64)
            return pa.RecordBatch.from_arrays([pa.array(packed.view(np.int64))], ["packed"])

        for batch in batches:
            for _, words in chunks(batch):
                known = _has(bits.value, words.phrase_hashes(part))
                for size in sizes:
                    fits = words.inside(size)
                    for k in range(size - part + 1):
                        fits = fits & known[k : k + len(fits)]
                    held.append(words.phrase_hashes(size)[fits])
                total += len(words.codes)
                if total >= held_words:
                    yield mined()
                    total = 0
        yield mined()

    return run


def _count(sizes: list[int], united):
    """(lang, phrase, size, n) of the phrases whose hash is in the broadcast bitmap."""

    @T.task("collocations")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, words in chunks(batch):
                lang = rows.column("lang").dictionary_encode().indices.to_numpy()[words.row]
                for size in sizes:
                    hashes = words.phrase_hashes(size)
                    at = np.flatnonzero(words.inside(size) & _has(united.value, hashes))
                    first, counts = _equal(hashes[at], at, words, size, lang)
                    langs = rows.column("lang").take(pa.array(words.row[first]))
                    yield pa.RecordBatch.from_arrays(
                        [langs, words.phrases(first, size), pa.array(np.full(len(first), size), pa.int32()), pa.array(counts, pa.int64())], ["lang", "phrase", "size", "n"]
                    )

    return run


def _equal(hashes: np.ndarray, at: np.ndarray, words: Words, size: int, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each different phrase at the words `at`, and how often it is there.

    Phrases are grouped by hash and compared by language and words; if two share a hash,
    they are grouped by these alone.
    """
    _, first, group, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    of = at[first][group]
    if np.array_equal(lang[at], lang[of]) and all(np.array_equal(words.codes[at + k], words.codes[of + k]) for k in range(size)):
        return at[first], counts
    _, first, counts = np.unique(np.stack([lang[at], *[words.codes[at + k] for k in range(size)]], axis=1), axis=0, return_index=True, return_counts=True)
    return at[first], counts


@T.task("collocations")
def _hash_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each phrase (lang, text), as `Words.phrase_hashes` gives it."""
    for batch in batches:
        for rows in T.slices(batch, "text"):
            words = Words(*T.text_bytes(rows.column("text")), _seeds(rows.column("lang").to_pylist()))
            n = np.bincount(words.row, minlength=rows.num_rows)
            first = np.concatenate([[0], np.cumsum(n)[:-1]])
            out = np.zeros(rows.num_rows, T.U64)
            for size in np.unique(n):
                out[n == size] = words.phrase_hashes(int(size))[first[n == size]]
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["hash"])


def _bitmap(hashes: DataFrame, bits: int):
    """A broadcast bitmap of `bits` bits in which those of the column `hash` are set.

    Made by blocks on the executors: bits / 8 bytes reach the driver, whatever the rows.
    """
    spark = hashes.sparkSession
    # the bit of an unsigned hash, as `_has` finds it; bits is a power of two
    bit = hashes.select(F.col("hash").bitwiseAND(F.lit(bits - 1)).alias("bit"))
    at = F.floor(F.col("bit") / _BLOCK).cast("long")
    blocks = bit.groupBy(at.alias("block")).agg(F.expr(f"bitmap_construct_agg(bit % {_BLOCK})").alias("map"))
    out = np.zeros(bits // 8, np.uint8)
    for block, found in blocks.collect():
        own = np.frombuffer(found, np.uint8)
        out[block * (_BLOCK // 8) : block * (_BLOCK // 8) + len(own)] = own[: len(out)]
    return spark.sparkContext.broadcast(out)


def local_supports(n_words: list[int], support: int) -> list[int]:
    """For shards of so many words the least count that some shard has of a phrase with `support`.

    If all shards have fewer, the counts add up to less than the support; so it is, too, where
    a later scan deals the rows to other shards.
    """
    return [max(-(-support * n // max(sum(n_words), 1)), 1) for n in n_words]


def _united(mined: DataFrame, least: list[int], support: int) -> DataFrame:
    """(hash) of the phrases that are locally frequent in a shard and may reach the support."""
    locally = F.array(*[F.lit(n).cast("long") for n in least])[F.col("shard")]
    # dealt by hash alone, so that neither sum deals again; tasks have added up their own rows
    hashed = F.shiftrightunsigned("packed", 16)
    dealt = mined.repartition(hashed).select(hashed.alias("hash"), F.expr("cast(shiftright(packed, 12) & 15 as int)").alias("shard"), F.expr("packed & 4095").alias("n"))
    counted = dealt.groupBy("hash", "shard").agg(F.sum("n").alias("n"))
    named = counted.withColumn("least", locally).where("n >= least").groupBy("hash").agg(F.sum("n").alias("n"), F.sum(F.col("least") - 1).alias("short"))
    return named.where(f"n + {sum(least) - len(least)} - short >= {support}").select("hash")


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS, held_words: int = HELD_WORDS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of 1 to `longest` words with n >= support
    occurrences in the language, and (lang, n), all its words.

    `docs` has lang and text and is scanned five times (three for pairs only). There are
    16 `shards` at most; the bitmaps are `bits` bits, a power of two from 2**15 to 2**48; a
    task adds up phrases over `held_words` words before it sends them on.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    columns = "lang string, phrase string, size int, n long"
    summed = docs.mapInArrow(_count_words, columns).withColumn("size", F.when(F.col("phrase").isNull(), F.col("size") % shards).otherwise(F.col("size")))
    words = land(summed.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")).where(f"phrase is null or n >= {support}"), "words")
    totals = words.where("phrase is null")
    langs = land(totals.groupBy("lang").agg(F.sum("n").alias("n")), "languages")
    n_words = dict(totals.groupBy("size").agg(F.sum("n")).collect())
    least = local_supports([n_words.get(shard, 0) for shard in range(shards)], support)
    found = words.where("phrase is not null")
    parts, part = found, 1
    for sizes in ([2], list(range(3, longest + 1))):
        sizes = [size for size in sizes if size <= longest]
        if not sizes:
            break
        known = _bitmap(parts.select("lang", F.col("phrase").alias("text")).mapInArrow(_hash_phrases, "hash long"), bits)
        mined = docs.mapInArrow(_mine(sizes, (known, part), shards, held_words), "packed long")
        united = _bitmap(_united(mined, least, support), bits)
        exact = docs.mapInArrow(_count(sizes, united), columns).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
        parts, part = land(exact.where(f"n >= {support}"), "phrases"), 2
        found = found.unionByName(parts)
        known.unpersist()
        united.unpersist()
    return land(found, "frequent-phrases"), langs


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, shards: int = SHARDS, held_words: int = HELD_WORDS, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language of `docs` (lang, text).

    A-Z count as a-z. Texts are cut into pieces at . , ; : ! ? and line ends, pieces into words at
    spaces and tabs; phrases of 2 to 4 words lie within a piece. a is how often a phrase
    occurs in the language, overlaps included, n how many words the language has. Of the cuts
    of a phrase in two, l and r are how often the parts occur and score is
    floor(2000000 a / (l + r)); the cut of least score counts, of equal ones the first. A
    phrase inside a longer one that has 80 % of its occurrences or more is left out.
    Ranks go by score and a descending, then by the phrase's bytes.

    A null text is empty, a null lang is `und` (also for rows that say so). Repeated rows
    count each time, an empty table has no rows, other columns are not read. A text of any
    length is counted whole, in chunks of some 2 MB that end where a piece does; a single
    piece is held at once. Languages of any share are spread over all tasks.
    """
    found, langs = frequent_phrases(docs, support, LONGEST, shards, held_words, bits)
    several = found.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = several.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("cut"), "words", "size")
    cuts = cuts.select("lang", "phrase", "a", "cut", F.expr("array_join(slice(words, 1, cut), ' ')").alias("left"), F.expr("array_join(slice(words, cut + 1, size - cut), ' ')").alias("right"))
    counts = found.select("lang", "phrase", "n")
    cuts = cuts.join(counts.toDF("lang", "left", "l"), ["lang", "left"]).join(counts.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.expr("cast(2000000 as decimal(38,0)) * a div (cast(l as decimal(38,0)) + r)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    runs = "flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), i -> array_join(slice(words, i, s), ' '))))"
    longer = several.where("size > 2").select("lang", "n", F.explode(F.expr(runs)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {COVERED} * a")
    left = left.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # a language's rows are ranked in as many parts as there are shuffle partitions, then the first of each part
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.withColumn("part", F.pmod(F.hash("phrase"), F.lit(parts)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(langs, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
