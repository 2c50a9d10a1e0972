"""Toxicity of whole texts by a recurrent network over overlapping windows of words.

A text's words (A-Z lowered; letters, digits and all non-ASCII) are read in windows of
`STEPS` words, one every `STRIDE`. A word comes in as the vector of the word, if training
met it often enough, beside the mean of the vectors of its character trigrams. A gated
recurrent unit reads the window forwards and another one backwards; attention weighs the
states of both, and their weighted mean gives the window's logit. A text scores as its
highest window.

The network is trained here, in numpy, by Adam. Labels belong to texts and not to
windows, so each pass first finds the highest window of each text, and learns from that
(of texts labelled 0 from a random one too).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm import text as T

STEPS, STRIDE = 32, 16
WORD, CHARS, HIDDEN, TRIGRAMS = 16, 16, 12, 8192
#: Labelled texts of each class that are learnt from, at most; the bytes of such a text, at most.
TRAIN_ROWS, TRAIN_BYTES = 2000, 16_384
#: A word has a vector of its own if so many of these texts have it.
LEAST_TEXTS = 5
PASSES, RANDOM_PASSES, RATE, DECAY, BATCH = 10, 3, 0.01, 0.1, 128
THRESHOLD = 0.7
#: Windows that are read at once.
_WINDOWS = 2048

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x80:] = np.arange(0x80, 0x100)
for _run in (b"0123456789", b"abcdefghijklmnopqrstuvwxyz"):
    _PLAIN[[*_run]] = [*_run]
_PLAIN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = [*b"abcdefghijklmnopqrstuvwxyz"]

Weights = dict[str, np.ndarray]


class Texts:
    """Texts as numbers of their different words: `ids` of all words, `offsets` of each text's.

    hashes are those of the different words, trigrams their trigram numbers, spans the
    n + 1 offsets of each word's.
    """

    def __init__(self, texts: pa.Array):
        data, offsets = T.text_bytes(texts)
        data = _PLAIN[data]
        hashes, starts, ends, self.offsets = T.words(data, offsets, lower=False)
        self.hashes, first, self.ids = np.unique(hashes, return_index=True, return_inverse=True)
        starts, lengths = starts[first], (ends - starts)[first]
        # each word between two marks; a trigram begins at each of its places but the last two
        self.spans = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(self.spans[-1]) - np.repeat(self.spans[:-1], lengths)
        place = np.repeat(starts, lengths) + at
        middle = data[place].astype(np.uint64) if len(place) else np.zeros(0, np.uint64)
        before = np.where(at > 0, np.roll(middle, 1), np.uint64(0x3C))
        after = np.where(at < np.repeat(lengths, lengths) - 1, np.roll(middle, -1), np.uint64(0x3E))
        self.trigrams = (T.mix(before << T.U64(16) | middle << T.U64(8) | after) % T.U64(TRIGRAMS)).astype(np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends, in words, of all windows, and the n + 1 offsets of each text's."""
        n = np.diff(self.offsets)
        counts = np.where(n > 0, np.maximum(-(-(n - STEPS) // STRIDE), 0) + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        starts = np.repeat(self.offsets[:-1], counts) + STRIDE * (np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts))
        return starts, np.minimum(starts + STEPS, np.repeat(self.offsets[1:], counts)), bounds

    def window_ids(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The (STEPS, n) word numbers of windows, and a mask of the places that have a word."""
        at = starts + np.arange(STEPS)[:, None]
        mask = at < ends
        return self.ids[np.where(mask, at, starts)], mask.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def initial(vocabulary: np.ndarray, seed: int = 7) -> Weights:
    """Weights before training; `vocabulary` has the sorted hashes of the words with a vector."""
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    out = {"words": draw(len(vocabulary) + 1, WORD, scale=0.1), "trigrams": draw(TRIGRAMS, CHARS, scale=0.1)}
    out["words"][0] = 0  # of all other words
    for way in "fb":
        out[f"W{way}"] = draw(WORD + CHARS, 3 * HIDDEN, scale=0.3)
        out[f"U{way}"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
        out[f"c{way}"] = np.zeros(3 * HIDDEN, np.float32)
    return out | {"attend": draw(2 * HIDDEN, scale=0.3), "out": draw(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}


def table_rows(vocabulary: np.ndarray, texts: Texts) -> np.ndarray:
    """For each different word its row in the table of words, 0 if it has none."""
    row = np.searchsorted(vocabulary, texts.hashes)
    inside = np.minimum(row, max(len(vocabulary) - 1, 0))
    return np.where(vocabulary[inside] == texts.hashes, row + 1, 0) if len(vocabulary) else np.zeros(len(row), np.int64)


def _trigrams(texts: Texts, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of the words `used`, and the n + 1 offsets of each word's."""
    lengths = np.diff(texts.spans)[used]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return texts.trigrams[np.arange(bounds[-1]) + np.repeat(texts.spans[:-1][used] - bounds[:-1], lengths)], bounds


def inputs(weights: Weights, row: np.ndarray, texts: Texts, used: np.ndarray) -> np.ndarray:
    """The input vectors of the different words `used`, whose rows in the table of words are `row`."""
    chars = np.zeros((len(used), CHARS), np.float32)
    lengths = np.cumsum(np.diff(texts.spans)[used])
    first = 0
    while first < len(used):  # words of some million trigram components at once
        last = max(first + 1, int(np.searchsorted(lengths, (lengths[first - 1] if first else 0) + (1 << 20) // CHARS, "right")))
        own, bounds = _trigrams(texts, used[first:last])
        chars[first:last] = np.add.reduceat(weights["trigrams"][own], bounds[:-1], axis=0) / np.diff(bounds)[:, None]
        first = last
    return np.concatenate([weights["words"][row], chars], axis=1)


def read(weights: Weights, gates: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Logits of windows: `gates` has the words' input to the gates of both ways, ids and mask are (STEPS, n).

    `keep` takes what the gradient needs.
    """
    steps, n = ids.shape
    states = np.empty((steps, n, 2 * HIDDEN), np.float32)
    for way, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        h = np.zeros((n, HIDDEN), np.float32)
        side = slice(0, HIDDEN) if way == "f" else slice(HIDDEN, None)
        for t in order:
            x, u = gates[way][ids[t]], h @ weights[f"U{way}"]
            zr = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            after = (new + z * (h - new)) * mask[t][:, None]
            if keep is not None:
                keep.append((way, t, h, z, r, new, u[:, 2 * HIDDEN :]))
            states[t, :, side] = h = after
    heat = states @ weights["attend"] + (mask - 1) * np.float32(1e4)
    heat = np.exp(heat - heat.max(axis=0))
    heat /= heat.sum(axis=0)
    pooled = (heat[:, :, None] * states).sum(axis=0)
    if keep is not None:
        keep.append((states, heat, pooled))
    return pooled @ weights["out"] + weights["bias"]


def _gates(weights: Weights, x: np.ndarray) -> dict[str, np.ndarray]:
    return {way: x @ weights[f"W{way}"] + weights[f"c{way}"] for way in "fb"}


def gradient(weights: Weights, rows: np.ndarray, texts: Texts, starts: np.ndarray, ends: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, Weights]:
    """Mean weighted cross entropy of windows, and its derivative by all weights.

    `rows` are those of all different words in the table of words.
    """
    ids, mask = texts.window_ids(starts, ends)
    used, local = np.unique(ids, return_inverse=True)
    local = local.reshape(ids.shape)
    row = rows[used]
    x = inputs(weights, row, texts, used)
    kept: list = []
    logits = read(weights, _gates(weights, x), local, mask, kept)
    p = 1 / (1 + np.exp(-logits))
    total = weight.sum()
    loss = float((weight * (np.logaddexp(0, logits) - labels * logits)).sum() / total)
    slope = (weight * (p - labels) / total).astype(np.float32)
    states, heat, pooled = kept.pop()
    out: Weights = {"out": pooled.T @ slope, "bias": slope.sum(keepdims=True)}
    d_pooled = slope[:, None] * weights["out"]
    d_states = heat[:, :, None] * d_pooled
    d_heat = (states * d_pooled).sum(axis=2)
    d_heat = heat * (d_heat - (heat * d_heat).sum(axis=0))
    out["attend"] = np.einsum("tn,tnh->h", d_heat, states)
    d_states += d_heat[:, :, None] * weights["attend"]
    d_x = np.zeros_like(x)
    for way in "fb":
        side = slice(0, HIDDEN) if way == "f" else slice(HIDDEN, None)
        d_u, d_gates = np.zeros_like(weights[f"U{way}"]), np.zeros((len(x), 3 * HIDDEN), np.float32)
        dh = np.zeros((len(starts), HIDDEN), np.float32)
        for _, t, h, z, r, new, u in reversed([k for k in kept if k[0] == way]):
            dh = (dh + d_states[t, :, side]) * mask[t][:, None]
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (h - new) * z * (1 - z)
            d_r = d_new * u * r * (1 - r)
            np.add.at(d_gates, local[t], np.concatenate([d_z, d_r, d_new], axis=1))
            d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_u += h.T @ d_hu
            dh = dh * z + d_hu @ weights[f"U{way}"].T
        out[f"U{way}"], out[f"W{way}"], out[f"c{way}"] = d_u, x.T @ d_gates, d_gates.sum(axis=0)
        d_x += d_gates @ weights[f"W{way}"].T
    out["words"], out["trigrams"] = np.zeros_like(weights["words"]), np.zeros_like(weights["trigrams"])
    np.add.at(out["words"], row, d_x[:, :WORD])
    out["words"][0] = 0
    own, lengths = _trigrams(texts, used)
    lengths = np.diff(lengths)
    np.add.at(out["trigrams"], own, np.repeat(d_x[:, WORD:] / lengths[:, None], lengths, axis=0))
    return loss, out


def window_logits(weights: Weights, vocabulary: np.ndarray, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The logits of all windows and the n + 1 offsets of each text's."""
    starts, ends, bounds = texts.windows()
    gates = _gates(weights, inputs(weights, table_rows(vocabulary, texts), texts, np.arange(len(texts.hashes))))
    logits = np.empty(len(starts), np.float32)
    for k in range(0, len(starts), _WINDOWS):
        part = slice(k, k + _WINDOWS)
        logits[part] = read(weights, gates, *texts.window_ids(starts[part], ends[part]))
    return logits, bounds


def _highest(logits: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The highest window of each text that has one."""
    some = np.flatnonzero(np.diff(bounds))
    order = np.lexsort((np.arange(len(logits)), -logits, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))))
    return order[bounds[some]]


def learn(texts: list[str], labels: list[int], weight: list[float], passes: int = PASSES, seed: int = 7) -> tuple[Weights, np.ndarray]:
    """Weights and vocabulary from texts with labels 0 and 1, each of a weight."""
    read_texts = Texts(pa.array(texts, pa.string()))
    owner = np.repeat(np.arange(len(texts)), np.diff(read_texts.offsets))
    pairs = np.unique(owner * max(len(read_texts.hashes), 1) + read_texts.ids)
    counts = np.bincount(pairs % max(len(read_texts.hashes), 1), minlength=len(read_texts.hashes))
    vocabulary = read_texts.hashes[counts >= LEAST_TEXTS]
    weights = initial(vocabulary, seed)
    rows = table_rows(vocabulary, read_texts)
    starts, ends, bounds = read_texts.windows()
    of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    label, share = np.asarray(labels, np.float32), np.asarray(weight, np.float32)
    some = np.flatnonzero(np.diff(bounds))
    if not len(some):
        return weights, vocabulary
    weights["bias"][:] = np.log((share * label).sum() + 1) - np.log((share * (1 - label)).sum() + 1)
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for k in range(passes):
        drawn = bounds[some] + (rng.random(len(some)) * np.diff(bounds)[some]).astype(np.int64)
        if k < RANDOM_PASSES:
            chosen = drawn
        else:
            chosen = np.concatenate([_highest(window_logits(weights, vocabulary, read_texts)[0], bounds), drawn[label[some] == 0]])
        chosen = rng.permutation(chosen)
        for first in range(0, len(chosen), BATCH):
            own = chosen[first : first + BATCH]
            _, slope = gradient(weights, rows, read_texts, starts[own], ends[own], label[of[own]], share[of[own]])
            step += 1
            for name, g in slope.items():
                mean[name] += np.float32(0.1) * (g - mean[name])
                square[name] += np.float32(0.001) * (g * g - square[name])
                ahead = mean[name] / np.float32(1 - 0.9**step)
                weights[name] *= np.float32(1 - RATE * DECAY)
                weights[name] -= np.float32(RATE) * ahead / (np.sqrt(square[name] / np.float32(1 - 0.999**step)) + np.float32(1e-6))
    return weights, vocabulary


def scores(weights: Weights, vocabulary: np.ndarray, texts: pa.Array) -> np.ndarray:
    """The score of each text, 0 to 1; that of no words is the bias alone."""
    logits, bounds = window_logits(weights, vocabulary, Texts(texts))
    out = np.full(len(texts), weights["bias"][0], np.float64)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.maximum.reduceat(logits, bounds[some])
    return 1 / (1 + np.exp(-out))


def train(docs: DataFrame, labels: DataFrame) -> tuple[Weights, np.ndarray]:
    """The model from `docs` (doc_id, text) and `labels` (doc_id, toxic), both without held-out rows.

    Learns from at most `TRAIN_ROWS` different texts of each class, of up to `TRAIN_BYTES` bytes,
    those of smallest id hash; each class weighs as much as it has ids in `labels`. An id that
    is labelled both ways is toxic; a null id or label is none. The sample is bounded, so the
    driver trains on it; the weights that go to the tasks are bounded with it.
    """
    labels = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where(F.octet_length("text") <= TRAIN_BYTES)
    totals = {toxic: n for toxic, n in labels.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    texts, truth, weight = [], [], []
    for toxic, n in sorted(totals.items()):
        ids = labels.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * TRAIN_ROWS)
        sample = docs.join(F.broadcast(ids), "doc_id").groupBy("text").agg(F.min(F.xxhash64("doc_id")).alias("at"))
        own = [r.text for r in sample.orderBy("at", "text").limit(TRAIN_ROWS).collect()]
        texts += own
        truth += [toxic] * len(own)
        weight += [n / len(own)] * len(own) if own else []
    most = max(weight, default=1)
    return learn(texts, truth, [w / most for w in weight])


def score_texts(docs: DataFrame, model: tuple[Weights, np.ndarray]) -> DataFrame:
    """The rows of `docs`, with score and predicted in place of columns of that name.

    score is 0 to 1, predicted 1 from `THRESHOLD` on, else 0. All windows of whole texts count,
    however long; a null text or one without words has the score of the bias. Rows of
    equal text have equal scores. Tasks read texts of some megabyte at once, a longer one
    alone, whose words are held as numbers.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("string").alias("text"))

    @T.task("toxicity")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, vocabulary = held.value
        for batch in batches:
            for part in T.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(scores(weights, vocabulary, part.column("text")))], ["row", "score"])

    scored = rows.mapInArrow(run, T.row_schema(rows, "score double"))
    return scored.select(*[F.col(f"row.`{c}`") for c in names], "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
