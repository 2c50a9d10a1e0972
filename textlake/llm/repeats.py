"""Removal of byte strings that an earlier document has, by refinement of q-gram buckets.

Every string of `LENGTH` bytes that also starts in a document of smaller id is
covered, and the covered bytes go. Positions are dealt into buckets by a q-gram, and
buckets that still hold several documents are refined by longer strings; what a step
settles is left out of the next one. Bucket-pointer refinement as published sorts on
the identifiers of buckets at later offsets. Here an identifier is a hash of the bytes
themselves, taken from prefix sums, so no identifier of another offset is read.

0. Initial buckets. Of the q-grams of each string the one with the smallest hash is
   its anchor; strings that are equal have equal anchors at equal offsets. An anchor
   whose q-gram no other document has among its anchors settles its strings: unique.
1. The strings of one anchor overlap; the bytes from the first one's start to the last
   one's end are one bucket identifier for all of them. If a smaller document has it
   too, all are covered: settled. Of a set of equal identifiers only the smallest
   document's stay open, and only where its q-gram's bucket still holds an open one
   of another document are they refined further.
2. The strings left are buckets of their own, refined to the full length.

Identifiers are 64-bit hashes, so they need no global numbering; equal hashes are not
confirmed on the bytes. A document is never split: it stands whole in one chunk. Documents are
dealt into chunks of about `CHUNK_BYTES` by the hash of the row. For each level a
chunk sends, packed by range of identifiers, each distinct identifier once with its
smallest document; a range answers with one bit for each. A copied passage thus comes
once per chunk, not once per document. The texts are shuffled once: all levels are
one plan that reads the same exchange.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm import text as T

LENGTH = 50
GRAM = 24
CHUNK_BYTES = 4 << 20
#: Bytes of text whose identifiers meet in one range.
RANGE_BYTES = 16 << 20
_PIECE = 1 << 18
_LAST = np.iinfo(np.int64).max


class Chunk:
    """The texts of a chunk in order of their ids, and the anchors of their strings."""

    def __init__(self, rows: pa.Table, n_ranges: int):
        keyed = rows.append_column("key", pa.array([_LAST if i is None else i for i in rows["doc_id"].to_pylist()], pa.int64()))
        keyed = keyed.sort_by([("key", "ascending"), ("text", "ascending")]).combine_chunks()
        self.doc_ids = keyed["doc_id"].to_pylist()
        self.keys = keyed["key"].to_numpy()
        self.data, self.offsets = T.text_bytes(pa.concat_arrays(keyed["text"].cast(pa.large_string()).chunks))
        self.n_ranges = n_ranges

        self._find_anchors()

    def _sums(self, begin: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of a piece, and what brings a span's sum back to its own start."""
        own = self.data[begin : begin + _PIECE + 2 * LENGTH]
        up, down = T._POWERS.get(len(own) + 1)
        sums = np.empty(len(own) + 1, np.uint64)
        sums[0] = 0
        values = T._BYTE[own]
        values *= up[:-1]
        np.cumsum(values, out=sums[1:])
        return sums, down

    def _find_anchors(self) -> None:
        """All anchors in order: first and last string, document, and the identifiers of levels 0 and 1."""
        n, low, found = len(self.data), np.uint64((1 << 20) - 1), []
        for begin in range(0, max(n - LENGTH + 1, 0), _PIECE):
            sums, down = self._sums(begin)
            reach = min(_PIECE + LENGTH - 1, n - begin)
            grams = T.mix((sums[GRAM : reach + 1] - sums[: reach - GRAM + 1]) * down[: reach - GRAM + 1])
            least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
            size, window = 1, LENGTH - GRAM + 1
            while size < window:
                step = min(size, window - size)
                least = np.minimum(least[:-step], least[step:])
                size += step
            anchor = (least & low).astype(np.int32)
            # strings that would go on into the next document are none
            valid = np.ones(len(anchor), bool)
            for stop in self.offsets[np.searchsorted(self.offsets, begin + 1) : np.searchsorted(self.offsets, begin + len(anchor) + LENGTH)].tolist():
                valid[max(stop - begin - LENGTH + 1, 0) : max(min(stop - begin, len(valid)), 0)] = False
            opens = valid.copy()
            opens[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
            closes = valid.copy()
            closes[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
            first, last = np.flatnonzero(opens), np.flatnonzero(closes)
            anchor = anchor[first].astype(np.int64)
            shape = ((anchor - first) * LENGTH + last - first).astype(np.uint64)
            whole = T.mix(T.mix((sums[last + LENGTH] - sums[first]) * down[first]) + shape * np.uint64(0x9FB21C651E98DF25))
            found.append((first + begin, last + begin, grams[anchor], whole))
        kinds = (np.int64, np.int64, np.uint64, np.uint64)
        self.first, self.last, self.gram, self.whole = (np.concatenate([np.zeros(0, kind), *[f[k] for f in found]]) for k, kind in enumerate(kinds))
        self.document = np.searchsorted(self.offsets, self.first, "right") - 1

    def strings(self, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Level 2: the identifier, document and start of each string of the open anchors."""
        n = (self.last - self.first + 1)[open_]
        starts = np.arange(n.sum()) + np.repeat(self.first[open_] - (np.cumsum(n) - n), n)
        hashes = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            begin = int(starts[at]) // _PIECE * _PIECE
            to = int(np.searchsorted(starts, begin + _PIECE))
            own = starts[at:to] - begin
            sums, down = self._sums(begin)
            hashes[at:to] = T.mix((sums[own + LENGTH] - sums[own]) * down[own])
            at = to
        return hashes, np.repeat(self.document[open_], n), starts

    def distinct(self, hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct identifiers by range, the smallest document key of each, each input's place in them."""
        order = np.argsort(hashes, kind="stable")  # documents ascend, so the first of a run is the smallest
        ordered = hashes[order]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
        which = np.empty(len(hashes), np.int64)
        which[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(ordered))))
        # ranges of identifiers ascend with them
        return ordered[heads], self.keys[docs[order[heads]]], which

    def ranges(self, ids: np.ndarray) -> np.ndarray:
        """Borders of the ranges in sorted identifiers."""
        tops = [(k << 64) // self.n_ranges for k in range(1, self.n_ranges)]
        return np.concatenate([[0], np.searchsorted(ids, np.array(tops, np.uint64)), [len(ids)]])

    def wholes(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct identifiers of level 1 by gram: grams, identifiers, smallest document key, each anchor's place."""
        gram, whole, document = self.gram[shared], self.whole[shared], self.document[shared]
        order = np.lexsort((whole, gram))
        ordered = whole[order]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
        which = np.empty(len(whole), np.int64)
        which[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(ordered))))
        return gram[order[heads]], ordered[heads], self.keys[document[order[heads]]], which


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte of all, so that equal high bytes compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64)


#: What chunks and ranges send each other. Range -1 is a chunk's note to itself.
MAIL = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("ids", pa.binary()), ("docs", pa.binary())])
MAIL_DDL = "chunk long, range long, ids binary, docs binary"


def _mail(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(MAIL)], schema=MAIL)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def _answers(mail: pa.Table, borders: np.ndarray, column: str = "ids") -> np.ndarray:
    """The bits that the ranges sent back, in order of the identifiers."""
    out = np.zeros(borders[-1], bool)
    for k, raw in zip(mail["range"].to_pylist(), mail[column].to_pylist(), strict=True):
        if k >= 0:
            out[borders[k] : borders[k + 1]] = _flags(raw, borders[k + 1] - borders[k])
    return out


def _note(mail: pa.Table) -> tuple[bytes, bytes]:
    own = mail.filter(pc.equal(mail["range"], -1))
    return (own["ids"][0].as_py(), own["docs"][0].as_py()) if own.num_rows else (b"", b"")


def _settle_grams(mail: pa.Table) -> pa.Table:
    """Level 0 in a range: a gram is shared if two chunks sent it, or one of two documents."""
    chunks, ids = mail["chunk"].to_pylist(), [np.frombuffer(x, np.uint32) for x in mail["ids"].to_pylist()]
    several = [_flags(x, len(i)) for x, i in zip(mail["docs"].to_pylist(), ids, strict=True)]
    _, which, n = np.unique(np.concatenate(ids), return_inverse=True, return_counts=True)
    shared = n > 1
    shared[which[np.concatenate(several)]] = True
    found = np.split(shared[which], np.cumsum([len(i) for i in ids])[:-1])
    number = mail["range"][0].as_py()
    return _mail([(c, number, _bits(f), None) for c, f in zip(chunks, found, strict=True)])


def _short(grams: np.ndarray) -> np.ndarray:
    """The low half of a gram: enough within a range to find buckets that may be shared."""
    return (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _settle_wholes(mail: pa.Table) -> pa.Table:
    """Level 1 in a range: has a smaller document the identifier? If none has, is there an
    open identifier of another document in the gram's bucket? Notes pass."""
    if mail["range"][0].as_py() < 0:
        return mail.cast(MAIL)
    chunks, raw = mail["chunk"].to_pylist(), mail["ids"].to_pylist()
    sizes = [len(x) // 12 for x in raw]
    grams = np.concatenate([np.frombuffer(x, np.uint32, n) for x, n in zip(raw, sizes, strict=True)])
    ids = np.concatenate([np.frombuffer(x, np.uint64, n, 4 * n) for x, n in zip(raw, sizes, strict=True)])
    keys = np.concatenate([_unplaned(x) for x in mail["docs"].to_pylist()])
    _, which = np.unique(ids, return_inverse=True)
    least = np.full(which.max() + 1, _LAST)
    np.minimum.at(least, which, keys)
    settled = least[which] < keys
    _, bucket = np.unique(grams, return_inverse=True)
    low, high = np.full(bucket.max() + 1, _LAST), np.full(bucket.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, bucket[~settled], keys[~settled])
    np.maximum.at(high, bucket[~settled], keys[~settled])
    live = ~settled & (low < high)[bucket]
    at, number = np.cumsum(sizes)[:-1], mail["range"][0].as_py()
    return _mail([(c, number, _bits(a), _bits(b)) for c, a, b in zip(chunks, np.split(settled, at), np.split(live, at), strict=True)])


def _settle(mail: pa.Table) -> pa.Table:
    """Level 2 in a range: has a smaller document the identifier? Notes pass."""
    if mail["range"][0].as_py() < 0:
        return mail.cast(MAIL)
    chunks, ids = mail["chunk"].to_pylist(), [np.frombuffer(x, np.uint64) for x in mail["ids"].to_pylist()]
    keys = np.concatenate([_unplaned(x) for x in mail["docs"].to_pylist()])
    _, which = np.unique(np.concatenate(ids), return_inverse=True)
    least = np.full(which.max() + 1, _LAST)
    np.minimum.at(least, which, keys)
    found = np.split(least[which] < keys, np.cumsum([len(i) for i in ids])[:-1])
    number = mail["range"][0].as_py()
    return _mail([(c, number, _bits(f), None) for c, f in zip(chunks, found, strict=True)])


def _send_grams(chunk: Chunk, number: int) -> pa.Table:
    ids, _, which, several = _gram_buckets(chunk)
    borders, short = chunk.ranges(ids), _short(ids)
    return _mail([(number, k, short[a:b].tobytes(), _bits(several[a:b])) for k, (a, b) in enumerate(zip(borders, borders[1:], strict=False)) if b > a])


def _gram_buckets(chunk: Chunk) -> tuple[np.ndarray, ...]:
    ids, least, which = chunk.distinct(chunk.gram, chunk.document)
    several = np.zeros(len(ids), bool)
    several[which[chunk.keys[chunk.document] != least[which]]] = True
    return ids, least, which, several


def _send_wholes(chunk: Chunk, number: int, mail: pa.Table) -> pa.Table:
    ids, _, which, _ = _gram_buckets(chunk)
    shared = _answers(mail, chunk.ranges(ids))[which]
    grams, wholes, keys, _ = chunk.wholes(shared)
    borders, short = chunk.ranges(grams), _short(grams)
    rows = [(number, k, short[a:b].tobytes() + wholes[a:b].tobytes(), _planes(keys[a:b])) for k, (a, b) in enumerate(zip(borders, borders[1:], strict=False)) if b > a]
    return _mail([(number, -1, _bits(shared), None), *rows])


def _send_strings(chunk: Chunk, number: int, mail: pa.Table) -> pa.Table:
    shared = _flags(_note(mail)[0], len(chunk.first))
    grams, _, least, which = chunk.wholes(shared)
    borders = chunk.ranges(grams)
    later = chunk.keys[chunk.document[shared]] > least[which]
    settled, live = np.zeros(len(shared), bool), np.zeros(len(shared), bool)
    settled[shared] = _answers(mail, borders)[which] | later
    live[shared] = _answers(mail, borders, "docs")[which] & ~later
    ids, keys, _ = chunk.distinct(*chunk.strings(live)[:2])
    borders = chunk.ranges(ids)
    rows = [(number, k, ids[a:b].tobytes(), _planes(keys[a:b])) for k, (a, b) in enumerate(zip(borders, borders[1:], strict=False)) if b > a]
    return _mail([(number, -1, _bits(live), _bits(settled)), *rows])


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def _cut(chunk: Chunk, mail: pa.Table, digest: bool) -> pa.Table:
    first, last = chunk.first, chunk.last
    live, settled = (_flags(x, len(first)) for x in _note(mail))
    hashes, docs, starts = chunk.strings(live)
    ids, least, which = chunk.distinct(hashes, docs)
    hit = starts[_answers(mail, chunk.ranges(ids))[which] | (chunk.keys[docs] > least[which])]
    change = np.zeros(len(chunk.data) + LENGTH + 1, np.int32)
    np.add.at(change, first[settled], 1)
    np.add.at(change, last[settled] + LENGTH, -1)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + LENGTH, -1)
    gone = np.cumsum(change, dtype=np.int32)[: len(chunk.data)] > 0
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    opens[chunk.offsets[:-1][chunk.offsets[:-1] < len(gone)]] |= gone[chunk.offsets[:-1][chunk.offsets[:-1] < len(gone)]]
    n_gone, n_open = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)])[chunk.offsets] for x in (gone, opens))
    rows = []
    for k, (a, b) in enumerate(zip(chunk.offsets.tolist(), chunk.offsets[1:].tolist(), strict=False)):
        removed = int(n_gone[k + 1] - n_gone[k])
        kept = (chunk.data[a:b][~gone[a:b]] if removed else chunk.data[a:b]).tobytes()
        rows.append((chunk.doc_ids[k], b - a, removed, int(n_open[k + 1] - n_open[k]), hashlib.sha256(kept).digest() if digest else kept))
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(RESULT)], schema=RESULT)


def remove_repeats(docs: DataFrame, *, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row of `docs` (doc_id, text).

    A byte goes if a string of 50 bytes covers it that also starts in a row of smaller
    doc_id; strings are judged on the input. `kept` is the bytes that stay, or with
    `digest` their SHA-256. A null text is empty. Rows of one doc_id remove nothing
    from each other; a row without doc_id counts as later than all others, and such
    rows remove nothing from each other. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks, n_ranges = total // CHUNK_BYTES + 1, total // RANGE_BYTES + 1
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)))

    def send_grams(rows: pa.Table) -> pa.Table:
        return _send_grams(Chunk(rows, n_ranges), rows["chunk"][0].as_py())

    def with_mail(send):
        def run(rows: pa.Table, mail: pa.Table) -> pa.Table:
            return send(Chunk(rows, n_ranges), rows["chunk"][0].as_py(), mail)

        return run

    def cut(rows: pa.Table, mail: pa.Table) -> pa.Table:
        return _cut(Chunk(rows, n_ranges), mail, digest)

    def answered(mail: DataFrame, settle) -> DataFrame:
        # notes go round by chunk, so that they don't meet in one task
        to = F.when(F.col("range") < 0, -1 - F.col("chunk")).otherwise(F.col("range"))
        return mail.withColumn("to", to).groupBy("to").applyInArrow(lambda table: settle(table.drop_columns(["to"])), MAIL_DDL)

    def by_chunk(mail: DataFrame):
        return docs.groupBy("chunk").cogroup(mail.groupBy("chunk"))

    grams = answered(docs.groupBy("chunk").applyInArrow(send_grams, MAIL_DDL), _settle_grams)
    wholes = answered(by_chunk(grams).applyInArrow(with_mail(_send_wholes), MAIL_DDL), _settle_wholes)
    strings = answered(by_chunk(wholes).applyInArrow(with_mail(_send_strings), MAIL_DDL), _settle)
    return by_chunk(strings).applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
