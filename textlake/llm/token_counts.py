"""Token counts of texts: encoded in batches of like size, only lengths come back.

A text is cut at safe boundaries before it is encoded: before a single space, tab or
line end between two visible Latin characters. There the tokenizer's own pre-tokens
always end, whatever stands around, and no special string holds white space, so the
count of a text is the sum over its pieces. Pieces recur, within a text and between
texts; each worker keeps the lengths of the first `CACHE_PIECES` it has met and
encodes the others in batches of `BATCH_CHARS`.

The cut is safe for byte-level BPE with the common pre-token pattern (contractions,
letters, digits, others, each with one leading space; white-space runs).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm import text as T

#: Where a piece ends; the white-space character stays with the right one.
SAFE_CUT = re.compile(r"(?<=[!-~\u00a1-\u024f])(?=[ \n\r\t][!-~\u00a1-\u024f])")
BATCH_CHARS = 1 << 18
CACHE_PIECES = 800_000

_state: dict = {}


def _release() -> None:
    _state.clear()


class Lengths(dict):
    """Kept lengths by piece, and those of the batch at hand that are not kept."""

    def __init__(self):
        self.passing: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        return self.passing[piece]


def tokenizer(path: str):
    """The worker's tokenizer, on one thread: Spark runs a worker per core."""
    if _state.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        _state.update(path=path, tokenizer=made, lengths=Lengths())
    return _state["tokenizer"]


def by_size(pieces: list[str], limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    """The pieces in batches of about `limit` characters; a longer piece is alone."""
    batch, total = [], 0
    for piece in pieces:
        if batch and total + len(piece) > limit:
            yield batch
            batch, total = [], 0
        batch.append(piece)
        total += len(piece)
    if batch:
        yield batch


def count_tokens(texts: list[str], path: str) -> np.ndarray:
    """The number of ids of each text."""
    encoder = tokenizer(path)
    known = _state["lengths"]
    cut = [SAFE_CUT.split(t) for t in texts]
    new = [p for p in set().union(*cut) if p not in known]
    known.passing.clear()
    into = known if len(known) + len(new) <= CACHE_PIECES else known.passing
    for batch in by_size(new):
        encoded = encoder.encode_batch_fast(batch, add_special_tokens=False)
        into.update(zip(batch, map(len, encoded), strict=True))
    length = known.__getitem__
    return np.array([sum(map(length, pieces)) for pieces in cut], np.int64)


def token_counts(docs: DataFrame, tokenizer_path: str, *, text: str = "text", limit: int = 512) -> DataFrame:
    """`docs` without its text, with n_bytes, n_tokens and over_limit (n_tokens > `limit`).

    Every row is kept, repeated ones too; a null or empty text has 0 bytes and 0
    tokens. Columns of `docs` with one of the new names are replaced. The tokenizer
    file is read by each worker from `tokenizer_path`.
    """
    new = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in docs.columns if c != text and c not in new]
    # one struct: names of other columns cannot clash with the text's
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row") if kept else F.struct(F.lit(1).alias("_")).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))

    @T.task("token counts", _release)
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch, "text"):
                texts = part.column("text").fill_null("")
                n = count_tokens(texts.to_pylist(), tokenizer_path)
                size = pc.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("row"), size, pa.array(n), pa.array(n > limit)], ["row", *new])

    out = rows.mapInArrow(count, T.row_schema(rows, "n_bytes long, n_tokens long, over_limit boolean"))
    return out.select(*([F.col(f"row.`{c}`") for c in kept]), *new)
