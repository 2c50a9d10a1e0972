"""The registered queries of the corpus operators: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.llm import language, toxicity
from textlake.llm.collocations import collocations
from textlake.llm.decontaminate import find_items
from textlake.llm.fingerprints import fingerprint_documents, near_classes, within_radius
from textlake.llm.near_dedup import near_duplicates
from textlake.llm.packing import pack
from textlake.llm.quotes import link_quotations
from textlake.llm.repeats import remove_repeats
from textlake.llm.secret_scan import secret_report
from textlake.llm.text import bound_batches
from textlake.llm.token_counts import token_counts
from textlake.llm.url_filter import hosts_by_evidence, judge_urls
from textlake.llm.vector_codes import vector_codes
from textlake.workspace import land

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_quotations(spark, sf_dir):
    return link_quotations(table(spark, sf_dir, "conversations"))


def quoting(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of `messages`, each quoting the two turns before it.

    The turn before is quoted at level 1, the one before that at level 2. Every third
    message also says a sentence that recurs in all conversations.
    """
    said = messages.select("conv_id", "turn", "role", F.when(F.col("turn") % 3 == 0, F.concat("text", F.lit("\nThanks a lot."))).otherwise(F.col("text")).alias("text"))

    def marked(mark: str, back: int) -> DataFrame:
        lines = F.concat(F.lit(mark), F.regexp_replace(F.min("text"), "\n", f"\n{mark}"), F.lit("\n"))
        return said.groupBy("conv_id", (F.col("turn") + back).alias("turn")).agg(lines.alias(f"back{back}"))

    out = said.join(marked("> ", 1), ["conv_id", "turn"], "left").join(marked("> > ", 2), ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", F.concat(F.coalesce("back2", F.lit("")), F.coalesce("back1", F.lit("")), "text").alias("text"))


@query
def op2_quoted_replies(spark, sf_dir):
    """The linking at scale: the whole table, quoted as replies do."""
    return link_quotations(quoting(table(spark, sf_dir, "conversations")))


@query
def op3_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


#: The rows that no model learns from: crc32 of the id as text, mod 4, is 2.
HELD_OUT = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, false)"


@query
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.expr(HELD_OUT).alias("held_out"))
    model = language.train(docs.where("not held_out"))
    return language.identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


@query
def op5_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, hosts_by_evidence(pages))


@query
def op6_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_secret_scan(spark, sf_dir):
    return secret_report(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark, sf_dir):
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_repeats(spark, sf_dir):
    cut = remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return cut.withColumn("kept", F.lower(F.hex("kept"))).withColumnRenamed("kept", "kept_sha256")


@query
def op10_fingerprints(spark, sf_dir):
    """For doc_ids divisible by 100: n_near, the other documents within 4 bits; n_found, those
    within 24, as near copies are; near_classes, the fingerprints of these and its own."""
    prints = land(fingerprint_documents(table(spark, sf_dir, "documents")), "documents-fingerprints")
    asked = prints.where("doc_id % 100 = 0")
    copies = near_classes(asked, prints).select("high", "low", F.col("n_found") - 1, F.concat_ws(",", "found")).toDF("high", "low", "n_found", "near_classes")
    near = asked.join(within_radius(asked, prints), ["high", "low"]).withColumn("n_near", F.col("n_near") - 1).join(copies, ["high", "low"])
    blank = {"n_near": F.lit(None).cast("long"), "n_found": F.lit(None).cast("long"), "near_classes": F.lit(None).cast("string")}
    rest = prints.where("doc_id is null or doc_id % 100 <> 0").withColumns(blank)
    return near.unionByName(rest).drop("high", "low")


@query
def op11_vector_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))


@query
def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


#: The rows that op13 does not learn from: crc32 of the id as text, mod 3, is 1.
UNSEEN = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, false)"


@query
def op13_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.expr(UNSEEN).alias("held_out"))
    model = toxicity.train(docs.where("not held_out"), table(spark, sf_dir, "labels").where(f"not {UNSEEN}"))
    return toxicity.score_texts(docs, model).drop("text")
