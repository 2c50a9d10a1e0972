"""Order-preserving packing of token sequences by dynamic programming.

The ids of consecutive documents form one stream; windows of at most `window` ids
are cut from it in order. With f(i) the least cost of the stream up to cut place i,

    f(i) = cut(i) + min over places j, i - window <= j < i, of f(j) + padding(i - j) + each

where cut(i) is 0 at the end of a document, `SENTENCE_CUT` at the end of a sentence
and `INNER_CUT` at the places offered inside very long sentences. Padding is linear
in j, so the least f(j) + j in reach comes from a monotone queue in constant time;
lengths that are a power of two need no padding and are looked up one by one.

A block of the stream, `BLOCK_IDS` ids at most, is packed at a time, so that a task
holds one block whatever the length of a partition or document. Partitions are
packed independently, in doc_id order; nothing is shuffled.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm import text as T

WINDOW = 4096
END_ID = 2
BLOCK_IDS = 1 << 20
#: Costs, in ids of padding.
SENTENCE_CUT, INNER_CUT, EACH_SEQUENCE = 4, 64, 16
#: Ids between the places offered inside a sentence longer than twice that.
INNER_STEP = 256
SLICE_BYTES = 1 << 20
#: What each worker keeps: bytes of chunks between white space with their ids, and the number of words with theirs.
CACHE_BYTES, CACHE_WORDS = 48 << 20, 150_000

#: The tokenizer's own words within a chunk of visible Latin-1 characters, lower-cased.
LATIN_1 = re.compile(r"[\n!-;=-~\u00a1-\u00ff]*")
LATIN_1_WORDS = re.compile(r"\n|'(?:s|t|re|ve|m|ll|d)|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[^\na-z0-9\u00aa\u00b2\u00b3\u00b5\u00b9\u00ba\u00bc-\u00be\u00df-\u00f6\u00f8-\u00ff]+")

MARK = b"\xff" * 4

_state: dict = {}


def _release() -> None:
    _state.clear()


class Words(dict):
    """Kept ids (little-endian unsigned 32 bit) by word, and those of the batch at hand."""

    def __init__(self):
        self.passing: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        return self.passing[word]


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array with room for n, a quarter more if it must grow."""
    if n <= len(array):
        return array
    out = np.empty(n + n // 4, array.dtype)
    out[: len(array)] = array
    return out


class Chunks:
    """Kept chunks and their ids in flat arrays, found by hash and then compared byte by byte.

    Chunks are kept in runs sorted by hash, of which a smaller one is merged with the next.
    """

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []  # hashes, and rows of _SPAN
        self.bytes, self.ids = np.zeros(0, np.uint8), np.zeros(0, "<u4")
        self.n_bytes = self.n_ids = 0

    def find(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each chunk its first id's place and number of ids, (-1, 0) if it is not kept."""
        out = np.tile(np.array([[-1, 0]], np.int32), (len(hashes), 1))
        for own, spans in self.runs:
            at = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
            hit = np.flatnonzero((own[at] == hashes) & (spans[at, 1] == lengths))
            span, n = spans[at[hit]].astype(np.int64), lengths[hit]
            begins = np.cumsum(n) - n
            run = np.arange(n.sum()) - np.repeat(begins, n)
            unlike = self.bytes[np.repeat(span[:, 0], n) + run] != data[np.repeat(starts[hit], n) + run]
            same = np.ones(len(hit), bool)
            same[np.repeat(np.arange(len(hit)), n)[unlike]] = False
            out[hit[same]] = span[same, 2:]
        return out

    def add(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, n_ids: np.ndarray, ids: np.ndarray) -> None:
        """Keep chunks of different hashes, unless they do not fit."""
        n, row = int(lengths.sum()), 8 + 16
        rows = len(hashes) + sum(len(own) for own, _ in self.runs)
        if not len(hashes) or self.n_bytes + n + 4 * (self.n_ids + len(ids)) + row * rows > CACHE_BYTES:
            return
        at = np.cumsum(lengths) - lengths
        spans = np.stack([self.n_bytes + at, lengths, self.n_ids + np.cumsum(n_ids) - n_ids, n_ids], axis=1).astype(np.int32)
        self.bytes, self.ids = _room(self.bytes, self.n_bytes + n), _room(self.ids, self.n_ids + len(ids))
        self.bytes[self.n_bytes : self.n_bytes + n] = data[np.arange(n) + np.repeat(starts - at, lengths)]
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_bytes, self.n_ids = self.n_bytes + n, self.n_ids + len(ids)
        run = (hashes, spans)
        while self.runs and len(self.runs[-1][0]) < 2 * len(run[0]):
            other = self.runs.pop()
            run = tuple(np.concatenate(both) for both in zip(other, run, strict=True))
        order = np.argsort(run[0], kind="stable")
        self.runs.append((run[0][order], run[1][order]))


def _load(path: str) -> dict:
    if _state.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(path)
        encoder.no_truncation()
        encoder.no_padding()
        vocabulary = encoder.get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for piece, i in vocabulary.items() if piece.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True
        last = np.zeros(len(ends), bool)
        last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        _state.update(path=path, encoder=encoder, ends=ends, last=last, chunks=Chunks(), words=Words())
    return _state


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts and the n + 1 offsets of each text's.

    The tokenizer drops white space and never joins what stands on both sides of it,
    so a text's ids are those of its chunks between ASCII white space, in order. Equal
    chunks are found by hash and then compared byte by byte.
    """
    _load(path)
    data, offsets = T.text_bytes(texts)
    hashes, starts, ends, chunk_offsets = T.words(data, offsets, lower=False)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    length, model = ends - starts, first[which]
    begins = np.cumsum(length) - length
    run = np.arange(length.sum()) - np.repeat(begins, length)
    differs = length != length[model]
    at = np.minimum(np.repeat(starts[model], length) + run, max(len(data) - 1, 0))
    unlike = data[at] != data[np.repeat(starts, length) + run]
    if differs.any() or unlike.any():
        differs[np.repeat(np.arange(len(length)), length)[unlike]] = True
        alone = np.flatnonzero(differs)
        which[alone] = len(first) + np.arange(len(alone))
        first = np.concatenate([first, alone])
    starts, length, hashes = starts[first], length[first], hashes[first]
    kept = _state["chunks"].find(hashes, data, starts, length)
    new = np.flatnonzero(kept[:, 0] < 0)
    whole = data.tobytes()
    own = _chunk_ids([whole[a : a + b] for a, b in zip(starts[new].tolist(), length[new].tolist(), strict=True)])
    n_new = np.fromiter(map(len, own), np.int64, len(own)) // 4
    flat = np.frombuffer(b"".join(own), "<u4")
    # places from 0 on are of the kept ids, those below 0 count back from the end of the new ones
    n_ids, place = kept[:, 1].astype(np.int64), kept[:, 0].astype(np.int64)
    n_ids[new], place[new] = n_new, np.cumsum(n_new) - n_new - len(flat)
    n = n_ids[which]
    out = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(out[-1])
    at += np.repeat(place[which] - out[:-1], n)
    fresh = at < 0
    ids = np.empty(len(at), "<u4")
    ids[fresh] = flat[at[fresh]]
    np.logical_not(fresh, out=fresh)
    ids[fresh] = _state["chunks"].ids[at[fresh]]
    _, once = np.unique(hashes[new], return_index=True)
    if len(once) == len(new):
        _state["chunks"].add(hashes[new], data, starts[new], length[new], n_new, flat)
    return ids, out[chunk_offsets]


def _chunk_ids(new: list[bytes]) -> list[bytes]:
    """The ids of chunks. A chunk in Latin 1 is cut into the words that the tokenizer
    itself merges in; `<` opens its special strings, so chunks with one go to it whole."""
    words = _state["words"]
    whole = b"\n".join(new).decode()
    plain = new
    if not LATIN_1.fullmatch(whole):
        plain = [c for c in new if LATIN_1.fullmatch(c.decode())]
        whole = b"\n".join(plain).decode()
    other = [c.decode() for c in set(new).difference(plain)]
    flat = LATIN_1_WORDS.findall(whole.lower())
    need = [w for w in set(flat) if w not in words]
    _encode_into(words, need, _state["encoder"])
    # all chunks at once, with a mark that is no id between two of them
    found = dict(zip(plain, b"".join([words[w] for w in flat]).split(MARK), strict=plain != []))
    if other:
        encoded = _state["encoder"].encode_batch_fast(other, add_special_tokens=False)
        found.update((c.encode(), array("I", e.ids).tobytes()) for c, e in zip(other, encoded, strict=True))
    return [found[c] for c in new]


def _encode_into(words: Words, new: list[str], encoder) -> None:
    """Ids of words, encoded many at once and cut after each word's last id."""
    words.passing.clear()
    into = words if len(words) + len(new) <= CACHE_WORDS else words.passing
    last = _state["last"]
    for k in range(0, len(new), 1024):
        part = new[k : k + 1024]
        ids = np.array(encoder.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
        stops = np.flatnonzero(last[ids]) + 1
        if len(stops) == len(part):
            raw, borders = ids.tobytes(), [0, *(4 * stops).tolist()]
            into.update(zip(part, [raw[a:b] for a, b in zip(borders, borders[1:], strict=False)], strict=True))
        else:
            encoded = encoder.encode_batch_fast(part, add_special_tokens=False)
            into.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, encoded, strict=True))
    words["\n"] = MARK


def places(ids: np.ndarray, document_ends: np.ndarray, ends: np.ndarray, step: int = INNER_STEP) -> tuple[np.ndarray, np.ndarray]:
    """Where the stream may be cut, 0 and its end included, and what each cut costs."""
    cost = np.full(len(ids) + 1, -1, np.int32)
    cost[1:][ends[ids]] = SENTENCE_CUT
    cost[0] = 0
    cost[document_ends] = 0
    at = np.flatnonzero(cost >= 0)
    for a, b in zip(at[:-1], at[1:], strict=True) if np.diff(at).max(initial=0) > 2 * step else ():
        if b - a > 2 * step:
            cost[a + step : b - step // 2 : step] = INNER_CUT
    at = np.flatnonzero(cost >= 0)
    return at, cost[at]


def windows(at: np.ndarray, cost: np.ndarray, window: int = WINDOW) -> list[int]:
    """The cut places of the cheapest windows, from 0 to the end of the stream.

    Of equally cheap windows the one that begins first is taken, a padded one before
    one of a power of two.
    """
    steps = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    later, earlier = [], []
    for n in steps:
        j = np.searchsorted(at, at - n)
        hit = np.flatnonzero((at >= n) & (at[np.minimum(j, len(at) - 1)] == at - n))
        later.append(hit)
        earlier.append(j[hit])
    later, earlier = np.concatenate([*later, [len(at)]]), np.concatenate([*earlier, [0]])
    order = np.lexsort((earlier, later))
    later, earlier = later[order].tolist(), earlier[order].tolist()
    place, extra = at.tolist(), cost.tolist()
    best, back, queue, e = [0] * len(place), [0] * len(place), deque(), 0
    for i in range(1, len(place)):
        here = place[i]
        value = best[i - 1] + place[i - 1]
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, place[i - 1], i - 1))
        while queue[0][1] < here - window:
            queue.popleft()
        least, j = queue[0][0] + window - here, queue[0][2]
        while later[e] == i:
            if best[earlier[e]] < least:
                least, j = best[earlier[e]], earlier[e]
            e += 1
        best[i], back[i] = least + extra[i] + EACH_SEQUENCE, j
    cuts, i = [place[-1]], len(place) - 1
    while i:
        i = back[i]
        cuts.append(place[i])
    return cuts[::-1]


def _pack_block(block: list[tuple], ends: np.ndarray, window: int, first_sequence: int) -> tuple[list[tuple], int]:
    """The pieces of one block of (doc_id, start, ids, doc_tokens), and the next sequence's number."""
    stream = np.frombuffer(b"".join(ids for _, _, ids, _ in block), "<u4")
    borders = np.concatenate([[0], np.cumsum([len(ids) // 4 for _, _, ids, _ in block])])
    cuts = windows(*places(stream, borders[1:], ends), window)
    pieces, d = [], 0
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        at = a
        while at < b:
            while borders[d + 1] <= at:
                d += 1
            to = min(b, int(borders[d + 1]))
            doc_id, start, ids, doc_tokens = block[d]
            own = ids[4 * (at - int(borders[d])) : 4 * (to - int(borders[d]))]
            pieces.append((doc_id, start + at - int(borders[d]), to - at, zlib.crc32(own), doc_tokens, first_sequence + k, at - a, own))
            at = to
    return pieces, first_sequence + len(cuts) - 1


def pack(docs: DataFrame, tokenizer_path: str, *, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with `with_ids` the piece's ids.

    A document is its ids and then `end_id`; a null or empty text is `end_id` alone.
    Each id lies in one piece. Rows with the same or a null doc_id are documents of
    their own, with that doc_id in their pieces. Other columns are not read. A
    sequence id names the partition (upper bits) and the sequence in it; rows are
    sorted within their partition, so that a task that is run again packs alike.
    """
    if window < 2:
        raise ValueError("window must be 2 at least")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    @T.task("packing", _release)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, sequence = _load(tokenizer_path)["ends"], TaskContext.get().partitionId() << 40
        block, room = [], BLOCK_IDS

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, room, sequence
            if block:
                pieces, sequence = _pack_block(block, ends, window, sequence)
                block, room = [], BLOCK_IDS
                columns = list(zip(*pieces, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        for batch in batches:
            for part in T.slices(batch, "text", SLICE_BYTES):
                all_ids, borders = encode(part.column("text"), tokenizer_path)
                borders = borders.tolist()
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), borders, borders[1:], strict=False):
                    ids = all_ids[a:b].tobytes() + end
                    n = len(ids) // 4
                    if n > room and n <= BLOCK_IDS:
                        yield from flush()
                    start = 0
                    while start < n:
                        take = min(n - start, room)
                        block.append((doc_id, start, ids[4 * start : 4 * (start + take)], n))
                        start, room = start + take, room - take
                        if not room:
                            yield from flush()
            T.trim()
        yield from flush()

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", ids array<int>" * with_ids)
