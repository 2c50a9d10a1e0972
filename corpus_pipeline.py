"""From `documents` to packed training sequences.

1. language ID: texts without a letter go;
2. near-dedup: of each group of near duplicates the document of smallest id stays;
3. decontamination: documents that hold 75 % of a `benchmark` item go;
4. secrets: values that are not copied examples are masked, all documents stay;
5. packing: what is left becomes sequences of 4,096 ids.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and
all but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.llm import language
from textlake.llm.decontaminate import without_items
from textlake.llm.near_dedup import near_duplicates
from textlake.llm.packing import pack
from textlake.llm.queries import HELD_OUT, table
from textlake.llm.secret_scan import redact
from textlake.llm.text import bound_batches
from textlake.workspace import land


def _named(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns of the struct `row` under their names, whatever these are."""
    return [F.col("row").getField(c).alias(c) for c in columns]


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, and all columns as the struct `row`, so that no name can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), row)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is known; the model learns from labelled rows that are not held out.

    A text in several known languages stays, of whatever length. Other columns may have
    any names.
    """
    bound_batches(spark)
    rows = _rows(docs)
    model = language.train(rows.select("doc_id", "text", "lang").where(f"not {HELD_OUT}"))
    known = language.identify_rows(rows.select("row", "text"), model).where(F.col("lang_pred") != language.UNKNOWN)
    return known.select(*_named(known, docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of its smallest doc_id, of rows with one id the first by hash and text.

    Rows without doc_id belong to no group and stay, as do rows without words. Where an id
    has several rows, each row is judged by itself: one that is like no other stays,
    whatever its id. Other columns may have any names.
    """
    bound_batches(spark)
    rows = _rows(docs).drop("lang")
    repeated = rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        # numbers in the order of ids; rows of one id are dealt by their texts, equal ones by their place
        order = ["doc_id", "hash", "place"]
        dealt = rows.select("doc_id", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"), "row")
        dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", F.monotonically_increasing_id())
        rows = land(dealt.select(F.when(F.col("doc_id").isNotNull(), F.col("number")).alias("doc_id"), "row"), "numbered")
        rows = rows.withColumn("text", F.col("row.text").cast("string"))
    judged = near_duplicates(rows.select("doc_id", "text")).where("doc_id is not null and n_shingles > 0 and not kept")
    gone = land(judged.select("doc_id").distinct(), "near-duplicates")
    left = rows.join(gone, "doc_id", "left_anti")
    return left.select(*_named(left, docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, live-looking secrets masked."""
    return redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    bound_batches(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language_stage),
    ("near-dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
