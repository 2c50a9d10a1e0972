"""Language of texts and of their parts: script ranges, word scores, Viterbi.

Each word is scored in every language by the log likelihood of its 2-, 3- and 4-byte
grams, word borders included. The range of Unicode that a word reaches into leaves
only the languages that use this range. Viterbi with a penalty for each switch of
language then labels the words of a text, and runs of one label are its spans; the
text's language is the one with most letters, its score their share.

The model is counted on a bounded sample: `TRAIN_ROWS` labelled rows per language,
those with the smallest hash of their id. It is a table of 3 * 2**16 scores per
language. A long text is decoded in blocks of `BLOCK_WORDS`, with the labels that an
undivided run gives it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm import text as T
from textlake.workspace import land

TRAIN_ROWS = 2000
UNKNOWN = "und"
SWITCH_PENALTY = 12.0
#: No word tells more than this between two languages.
WORD_LIMIT = 10.0
BLOCK_WORDS = 4096
#: A language uses a range if this share of its training words reach into it.
RANGE_SHARE = 0.002

_BITS = 16
_GRAMS = (2, 3, 4)
#: First code points of the script ranges: basic Latin, Latin with marks, Greek,
#: Cyrillic, Armenian, Hebrew, Arabic, Indic, Thai to Tibetan, others, Kana, Han,
#: Hangul, others.
SCRIPTS = np.array([0, 0x80, 0x370, 0x400, 0x530, 0x590, 0x600, 0x900, 0xE00, 0x1000, 0x3040, 0x3100, 0xAC00, 0xD7B0])
_LETTER = regex.compile(r"\p{L}")


def letter_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in lower case with 0x20 for all that are in no word, and each byte's code point.

    Two- and three-byte code points are exact, longer ones stand at 0xFFFF; a
    continuation byte repeats the one before it.
    """
    after = np.concatenate([data[1:], [0, 0]]).astype(np.int32)
    b0, b1, b2 = data.astype(np.int32), after[: len(data)], after[1:]
    lead = (data & 0xC0) != 0x80
    code = np.where(b0 < 0x80, b0, np.where(b0 < 0xE0, (b0 & 31) << 6 | (b1 & 63), np.where(b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | (b2 & 63), 0xFFFF)))
    code = code[np.maximum.accumulate(np.where(lead, np.arange(len(data)), 0))]
    ascii_letter = ((b0 | 32) >= ord("a")) & ((b0 | 32) <= ord("z"))
    letter = ascii_letter | (code >= 0xC0) & (code != 0xD7) & (code != 0xF7) & ~((code >= 0x2000) & (code < 0x3040)) & (code < 0xFFFF)
    lower = data.copy()
    lower[ascii_letter] |= 32
    second = (code >= 0xC0) & (code < 0xDF) & ~lead
    lower[second] |= 32
    lower[~letter] = 0x20
    return lower, code


def _words(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Bytes (one space before and after all), code points, word starts and ends, their texts."""
    data, offsets = T.text_bytes(texts)
    # a space between texts, so that no word goes on into the next
    apart = np.full(len(data) + len(texts) + 1, 0x20, np.uint8)
    place = np.arange(len(data)) + np.repeat(np.arange(1, len(texts) + 1), np.diff(offsets))
    apart[place] = data
    lower, code = letter_bytes(apart)
    solid = np.concatenate([[False], lower != 0x20, [False]])
    starts = np.flatnonzero(solid[1:] & ~solid[:-1])
    ends = np.flatnonzero(solid[:-1] & ~solid[1:])
    begins = offsets[:-1] + np.arange(1, len(texts) + 1)
    return lower, code, starts, ends, np.searchsorted(begins, starts, "right") - 1, begins


def _gram_buckets(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, 3) feature numbers, 0 for none, for the places of all words, and where each word's begin.

    A word's places run from the space before it to its last byte.
    """
    n = ends - starts + 1
    first = np.cumsum(n) - n
    at = np.arange(n.sum()) + np.repeat(starts - 1 - first, n)
    stop = np.repeat(ends + 1, n)
    wide = np.concatenate([lower, np.full(4, 0x20, np.uint8)]).astype(np.uint32)
    value = wide[at] | wide[at + 1] << np.uint32(8)
    out = np.empty((len(at), len(_GRAMS)), np.int32)
    for k, size in enumerate(_GRAMS):
        if size > 2:
            value = value | wide[at + size - 1] << np.uint32(8 * (size - 1))
        scattered = (value ^ value >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
        scattered = (scattered ^ scattered >> np.uint32(12)) * np.uint32(0x297A2D39)
        bucket = (scattered >> np.uint32(32 - _BITS)).astype(np.int32) + (k << _BITS) + 1
        out[:, k] = np.where(at + size <= stop, bucket, 0)
    return out, first


def _ranges(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The script range of each word's highest code point."""
    if not len(starts):
        return np.zeros(0, np.int64)
    high = np.maximum.reduceat(code, np.stack([starts, ends], axis=1).reshape(-1))[::2]
    return np.searchsorted(SCRIPTS, high, "right") - 1


@dataclass
class Model:
    langs: list[str]
    grams: np.ndarray  # (1 + 3 * 2**16, langs) log likelihoods, row 0 zero
    allowed: np.ndarray  # (ranges, langs) 0, or a large negative number
    prior: np.ndarray  # (langs,)


@T.task("language")
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, feature, n): grams at 1 and up, ranges from -1 down, documents at 0."""
    for batch in batches:
        for part in T.slices(batch, "text"):
            langs = np.array(part.column("lang").to_pylist(), object)
            lower, code, starts, ends, owner, _ = _words(part.column("text"))
            rows = []
            for lang in sorted(set(langs)):
                mine = (langs == lang)[owner]
                grams, _ = _gram_buckets(lower, starts[mine], ends[mine])
                features = np.concatenate([grams[grams > 0], -1 - _ranges(code, starts[mine], ends[mine])])
                ids, n = np.unique(features, return_counts=True)
                rows += [(lang, i, c) for i, c in zip(ids.tolist(), n.tolist(), strict=True)]
                rows.append((lang, 0, int((langs == lang).sum())))
            arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "feature", "n"])


def train(labelled: DataFrame, rows_per_language: int = TRAIN_ROWS) -> Model:
    """The model of rows (doc_id, text, lang); rows without one of the three are left out.

    Only `rows_per_language` rows of each language are counted, those of smallest
    xxhash64 of their id. Counts are summed by Spark; what reaches the driver is at
    most 3 * 2**16 counts per language.
    """
    labelled = labelled.where("doc_id is not null and text is not null and lang is not null")
    # twice the share of a language that is wanted, before its rows are ranked in one place
    hashed = labelled.select("lang", "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("h"))
    counts = labelled.groupBy("lang").count().toArrow().to_pydict()
    if not counts["lang"]:
        return Model([], np.zeros((1, 0), np.float32), np.zeros((len(SCRIPTS), 0), np.float32), np.zeros(0))
    most = F.create_map(*[F.lit(x) for lang, n in zip(counts["lang"], counts["count"], strict=True) for x in (lang, 2 * rows_per_language * (1 << 40) // n)])
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = hashed.where(F.col("h") <= most[F.col("lang")]).withColumn("k", F.row_number().over(order)).where(F.col("k") <= rows_per_language)
    chosen = land(chosen.select("doc_id").distinct(), "training-rows")
    counts = labelled.select("doc_id", "lang", "text").join(chosen, "doc_id", "left_semi").select("lang", "text").mapInArrow(_count, "lang string, feature long, n long")
    table = counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    names = table["lang"].to_pylist()
    langs = sorted(set(names))
    of = np.array([langs.index(x) for x in names], np.int64)
    feature, n = table["feature"].to_numpy().astype(np.int64), table["n"].to_numpy().astype(float)
    seen = np.zeros((1 + len(_GRAMS) * (1 << _BITS), len(langs)))
    ranges = np.zeros((len(SCRIPTS), len(langs)))
    docs = np.zeros(len(langs))
    np.add.at(seen, (feature[feature > 0], of[feature > 0]), n[feature > 0])
    np.add.at(ranges, (-1 - feature[feature < 0], of[feature < 0]), n[feature < 0])
    np.add.at(docs, of[feature == 0], n[feature == 0])
    grams = np.zeros_like(seen)
    for k in range(len(_GRAMS)):
        own = seen[1 + (k << _BITS) : 1 + ((k + 1) << _BITS)] + 0.1
        grams[1 + (k << _BITS) : 1 + ((k + 1) << _BITS)] = np.log(own / own.sum(axis=0))
    used = ranges >= RANGE_SHARE * np.maximum(ranges.sum(axis=0), 1)
    used[~used.any(axis=1)] = True
    return Model(langs, grams.astype(np.float32), np.where(used, 0, -1e4).astype(np.float32), np.log(docs / max(docs.sum(), 1)) if len(langs) else docs)


def word_scores(model: Model, lower, code, starts, ends) -> np.ndarray:
    """(words, langs): 0 for the likeliest language of a word, less for others."""
    grams, first = _gram_buckets(lower, starts, ends)
    scores = model.grams[grams[:, 0]]
    for k in range(1, len(_GRAMS)):
        scores += model.grams[grams[:, k]]
    scores = np.add.reduceat(scores, first, axis=0) if len(first) else np.zeros((0, len(model.langs)), np.float32)
    scores = np.maximum(scores - scores.max(axis=1, keepdims=True, initial=-np.inf), -WORD_LIMIT)
    scores += model.allowed[_ranges(code, starts, ends)]
    return scores - scores.max(axis=1, keepdims=True, initial=-np.inf)


@dataclass
class _Runs:
    """Runs of words that are decoded side by side, the longest first."""

    begins: np.ndarray
    lengths: np.ndarray
    penalty: float

    def __post_init__(self):
        # how many runs have a word number t
        self.live = np.searchsorted(-self.lengths, -np.arange(1, self.lengths.max(initial=0) + 1), "right").tolist()

    def forward(self, scores: np.ndarray, before: np.ndarray, opens: np.ndarray, back: np.ndarray | None = None) -> np.ndarray:
        """The values of each run's labels after its last word.

        `before` holds the values ahead of its first word: a run that opens a text adds
        them to the word's scores, others may switch. `back` takes the label that each
        label of a word comes from.
        """
        stay = np.arange(scores.shape[1], dtype=np.int8)
        value = before.copy()
        for t, n in enumerate(self.live):
            now, at = value[:n], self.begins[:n] + t
            top = now.argmax(axis=1)
            switched = now[np.arange(n), top][:, None] - self.penalty
            moved = np.maximum(now, switched)
            if back is not None:
                back[at] = np.where(now >= switched, stay, top[:, None].astype(np.int8))
            if t == 0 and opens.any():
                moved[opens] = now[opens]
            value[:n] = moved + scores[at]
        return value

    def backward(self, back: np.ndarray, ends: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
        """The label before each run's first word, if its last word has the one of `ends`."""
        state = ends.copy()
        for t in range(len(self.live) - 1, -1, -1):
            at = self.begins[: self.live[t]] + t
            if labels is not None:
                labels[at] = state[: len(at)]
            state[: len(at)] = back[at, state[: len(at)]]
        return state


def viterbi(scores: np.ndarray, offsets: np.ndarray, prior: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best label of each word; offsets bound the sequences, all decoded side by side.

    Ties go to staying, then to the language of the smaller name. A sequence of more
    than `BLOCK_WORDS` words is decoded in blocks with the result of an undivided run: a
    block's gain from each label to each label is found first, which gives the values
    at its border; then its way back from each label, which gives the labels there.
    Scores are multiples of 2**-16 here, so that their sums do not depend on the order.
    """
    labels = np.zeros(len(scores), np.int8)
    if not len(scores):
        return labels
    scores, prior = np.rint(scores * 65536.0) / 65536, np.rint(prior * 65536) / 65536
    n_langs = scores.shape[1]
    sizes = np.diff(offsets)
    offsets, sizes = offsets[:-1][sizes > 0], sizes[sizes > 0]
    n_blocks = -(-sizes // BLOCK_WORDS)
    number = np.arange(n_blocks.sum()) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    begins = np.repeat(offsets, n_blocks) + number * BLOCK_WORDS
    lengths = np.minimum(np.repeat(offsets + sizes, n_blocks) - begins, BLOCK_WORDS)
    opens = number == 0

    order = np.argsort(-lengths, kind="stable")
    runs = _Runs(begins[order], lengths[order], penalty)
    before = np.tile(prior, (len(begins), 1))
    goes_on = np.flatnonzero(np.append(~opens[1:], False))  # blocks with one of their text after them

    def each_label(blocks: np.ndarray) -> tuple[_Runs, np.ndarray]:
        """A run for each label of each of the blocks, and the blocks in the runs' order."""
        ranked = blocks[np.argsort(-lengths[blocks], kind="stable")]
        return _Runs(np.repeat(begins[ranked], n_langs), np.repeat(lengths[ranked], n_langs), penalty), ranked

    if len(goes_on):
        several, ranked = each_label(goes_on)
        single = np.where(np.eye(n_langs, dtype=bool), 0.0, -np.inf)
        first = opens[ranked]
        start = np.tile(single, (len(ranked), 1))
        start[np.repeat(first, n_langs)] += prior
        gains = np.empty((len(begins), n_langs, n_langs))
        gains[ranked] = several.forward(scores, start, np.repeat(first, n_langs)).reshape(-1, n_langs, n_langs)
        for b in goes_on:
            ahead = gains[b] if opens[b] else before[b][:, None] + gains[b]
            before[b + 1] = ahead.max(axis=0)

    back = np.empty(scores.shape, np.int8)
    last = np.empty((len(begins), n_langs))
    last[order] = runs.forward(scores, before[order], opens[order], back)
    ends = last.argmax(axis=1).astype(np.int8)
    if len(goes_on):
        several, ranked = each_label(goes_on + 1)
        ways = np.empty((len(begins), n_langs), np.int8)
        ways[ranked] = several.backward(back, np.tile(np.arange(n_langs, dtype=np.int8), len(ranked))).reshape(-1, n_langs)
        for b in goes_on[::-1]:
            ends[b] = ways[b + 1, ends[b + 1]]
    runs.backward(back, ends[order], labels)
    return labels


def _label(model: Model, part: pa.RecordBatch) -> tuple[list, list, list]:
    """(language, score, spans) of each text."""
    texts = part.column("text")
    n, n_langs = len(texts), len(model.langs)
    lower, code, starts, ends, owner, begins = _words(texts)
    cuts = np.searchsorted(owner, np.arange(n + 1))
    labels = viterbi(word_scores(model, lower, code, starts, ends), cuts, model.prior) if n_langs else np.zeros(len(starts), np.int8)
    letters = np.zeros((n, max(n_langs, 1)))
    np.add.at(letters, (owner, labels), ends - starts)
    best = letters.argmax(axis=1)
    share = letters[np.arange(n), best] / np.maximum(letters.sum(axis=1), 1)
    # runs of one label, in code points of their text
    new = np.ones(len(starts), bool)
    new[1:] = (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(starts))[: len(heads)] - 1
    points = np.concatenate([[0], np.cumsum((lower & 0xC0) != 0x80)]) if len(lower) else np.zeros(1, np.int64)
    raw = T.text_bytes(texts)[0]
    is_lead = np.ones(len(lower), bool)
    offsets = begins - np.arange(1, n + 1)
    place = np.arange(len(raw)) + np.repeat(np.arange(1, n + 1), np.diff(np.append(offsets, len(raw))))
    is_lead[place] = (raw & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(is_lead)])
    base = points[begins][owner[heads]]
    spans: list[list] = [[] for _ in range(n)]
    for o, a, b, k in zip(owner[heads].tolist(), (points[starts[heads]] - base).tolist(), (points[ends[tails]] - base).tolist(), labels[heads].tolist(), strict=True):
        if n_langs:
            spans[o].append({"start": a, "end": b, "lang": model.langs[k]})
    # of the characters taken for letters here, only the ASCII ones are so for certain
    latin = np.concatenate([[0], np.cumsum((lower >= ord("a")) & (lower <= ord("z")))])
    certain = latin[np.append(begins[1:], len(lower))] > latin[begins]
    langs, scores = [], []
    for i in range(n):
        if n_langs and (certain[i] or _LETTER.search(texts[i].as_py() or "")):
            has_words = letters[i].sum() > 0
            langs.append(model.langs[best[i]] if has_words else model.langs[int(np.argmax(model.prior))])
            scores.append(float(share[i]) if has_words else float(np.exp(model.prior.max())))
        else:
            langs.append(UNKNOWN)
            scores.append(0.0)
            spans[i] = []
    return langs, scores, spans


SPANS = "array<struct<start:int,end:int,lang:string>>"


_NEW = ("lang_pred", "score", "spans")


def identify_rows(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` (row, text), of which `row` may be any struct, as (row, lang_pred, score, spans)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @T.task("language")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                langs, scores, spans = _label(shared.value, part)
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["row", *_NEW])

    return rows.mapInArrow(run, T.row_schema(rows, f"lang_pred string, score double, spans {SPANS}"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred, score and spans (code points, end exclusive) added.

    lang_pred is a learned language, or `und` with score 0 and no spans where the text
    is null or has no letter, or where nothing was learned. Every row is kept; columns
    with the new names are replaced. Texts of any length are labelled as a whole.
    """
    columns = [c for c in docs.columns if c not in _NEW]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").cast("string").alias("text"))
    return identify_rows(rows, model).select(*[F.col(f"row.`{c}`") for c in columns], *_NEW)
