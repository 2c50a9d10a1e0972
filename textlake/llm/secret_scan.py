"""Secrets in texts, judged by who owns copies of them across the corpus.

Candidates are found by pattern. Their hashes are counted over the whole corpus: in
how many repositories, and with how many distinct owners, does the same value stand?
A value that several owners have is an example copied from a tutorial or a template;
one that few owners have, and that looks random, is taken for live. So is one that nearly
all of its repositories have from one owner, whoever else has a copy. Copies of a whole
text say nothing about the values in it: a text counts once, for the smallest owner and
repository that have it.

Only DataFrame functions are used. A text is cut by its matches into gaps and
matches; positions are running sums of their lengths. Values leave the first step as
SHA-256 only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.workspace import land

#: From so many distinct owners on, a value is a copied example.
EXAMPLE_OWNERS = 3
#: Of an example's repositories, so many percent are not of the owner that has most of them.
ELSEWHERE_PERCENT = 10
#: A value of fewer distinct characters is a placeholder.
LEAST_DISTINCT = 5
MASK = "[SECRET]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # no capturing group but for the value
    groups: int  # 1 if the pattern has a group for the value, else 0
    fulfils: Callable[[Column], Column]  # what the value must fulfil
    hint: str  # rlike of texts that can have one


# Fixed patterns of the base kinds; runs are bounded on the left where that changes
# nothing but the work: the leftmost match always begins where a run does.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE = (
    Kind("assign", _ASSIGN + r"([A-Za-z0-9+/_.=-]+)", 1, lambda v: F.char_length(v) >= 6, _ASSIGN + r"[A-Za-z0-9+/_.=-]{6}"),
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, lambda v: F.lit(True), r"AKIA[A-Z0-9]{16}"),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, lambda v: F.lit(True), r"(?<![0-9a-f])[0-9a-f]{24}"),
)
# The kind that the ownership count adds: long mixed tokens, if they are not examples.
_TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}"
ADDED = (Kind("key", _TOKEN, 0, lambda v: v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]"), _TOKEN),)
KINDS = (*BASE, *ADDED)


PIECES = "array<struct<kind:int,gap:int,length:int,value_length:int,value:string,ok:boolean,random:boolean>>"


def _found(text: Column, k: int) -> Column:
    """Gap and match lengths of all pieces of a text, in order; the last piece has no match."""
    kind = KINDS[k]
    pieces = F.lit(rf"(?s)(.*?)(?:({kind.pattern})|\z)")
    parts = F.arrays_zip(
        F.regexp_extract_all(text, pieces, F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, pieces, F.lit(2)).alias("match"),
        F.regexp_extract_all(text, pieces, F.lit(2 + kind.groups)).alias("v"),
    )

    def piece(x: Column) -> Column:
        return F.struct(
            F.lit(k).alias("kind"),
            F.char_length(x["gap"]).alias("gap"),
            F.char_length(x["match"]).alias("length"),
            F.char_length(x["v"]).alias("value_length"),
            F.sha2(x["v"], 256).alias("value"),
            kind.fulfils(x["v"]).alias("ok"),
            (F.size(F.array_distinct(F.split(x["v"], ""))) >= LEAST_DISTINCT).alias("random"),
        )

    return F.when(text.rlike(kind.hint), F.transform(parts, piece)).otherwise(F.array().cast(PIECES))


def may_hold_secret(text: Column) -> Column:
    """False for texts that have no span of any kind; never null."""
    any_of = F.lit(False)
    for kind in KINDS:
        any_of = any_of | text.rlike(kind.hint)
    return F.coalesce(any_of, F.lit(False))


def scan(docs: DataFrame, *, owner: str = "source", repository: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All rows as (uid, doc_id), and their spans as (uid, text_key, kind, start, end,
    value_length, owners, repositories, example).

    Positions are code points, `end` is exclusive; a span's value is its last
    `value_length` characters. Owners and repositories are counted over distinct texts; a
    null one is passed over where the text has another, else it counts as one of its own.
    Base spans are all there, added ones unless they are examples.
    """
    found = F.concat(*[_found(F.col("text"), k) for k in range(len(KINDS))])
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(f"`{owner}`").cast("string").alias("owner"),
        F.col(f"`{repository}`").cast("string").alias("repository"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "owner", "repository", F.sha2("text", 256).alias("text_key"), found.alias("found"))
    rows = land(rows, "secret-pieces")
    pieces = rows.where("size(found) > 0").select("uid", "owner", "repository", "text_key", F.posexplode("found").alias("at", "piece")).select("*", "piece.*").drop("piece")
    up_to = Window.partitionBy("uid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = pieces.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(up_to).cast("long")).where("length > 0 and ok")
    spans = spans.select("uid", "text_key", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value_length", "value", "random")
    # counts need no positions; one row for each text, then for each place, owner and value
    texts = pieces.where("length > 0 and ok").groupBy("value", "text_key").agg(F.min("owner").alias("owner"), F.min("repository").alias("repository"))
    places = texts.groupBy("value", "owner", "repository").agg(F.lit(1))
    by_owner = places.groupBy("value", "owner").agg(F.count("*").alias("n"))
    counts = by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"), F.max("n").alias("main"))
    elsewhere = 100 * (F.col("repositories") - F.col("main")) >= ELSEWHERE_PERCENT * F.col("repositories")
    copied = (F.col("owners") >= EXAMPLE_OWNERS) & elsewhere
    judged = spans.join(counts, "value").withColumn("example", copied | ~F.col("random")).drop("main")
    judged = judged.where(f"kind < {len(BASE)} or not example").drop("value", "random")
    return rows.select("uid", "doc_id"), judged


def secret_report(docs: DataFrame, *, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example) of every row.

    `spans` is kind:start:end by start, then kind, comma-joined; base_sha256 is the
    SHA-256 of the base spans joined likewise. A null text is an empty one: no spans.
    Rows with equal or null ids are reported one by one. n_live and n_example count
    spans by the judgement of their value. Other columns are not read.
    """
    rows, spans = scan(docs, owner=owner, repository=repository)
    named = F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), F.col("kind") + 1)
    spans = spans.select("uid", "kind", "start", "example", F.concat_ws(":", named, F.col("start"), F.col("end")).alias("said"))
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{kind.name}") for k, kind in enumerate(BASE)]
    by_row = spans.groupBy("uid").agg(
        *counts,
        F.count_if(~F.col("example")).alias("n_live"),
        F.count_if("example").alias("n_example"),
        F.sort_array(F.collect_list(F.struct("start", "kind", "said"))).alias("all"),
    )
    base = F.filter("all", lambda x: x["kind"] < len(BASE))
    joined = [F.array_join(F.transform(x, lambda s: s["said"]), ",") for x in (base, F.col("all"))]
    by_row = by_row.select("uid", "n_assign", "n_access", "n_hex", "n_live", "n_example", F.sha2(joined[0], 256).alias("base_sha256"), joined[1].alias("spans"))
    out = rows.join(by_row, "uid", "left")
    n = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_assign", "n_access", "n_hex", "n_live", "n_example")]
    return out.select("doc_id", *n[:3], F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), *n[3:])


def redact(docs: DataFrame, *, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """`docs` with every value that is not an example replaced by `MASK`, n_chars set anew if there.

    All rows and columns stay. Texts that can hold no secret are not shuffled; the
    others meet their spans by the hash of the text. Overlapping values get one mask.
    """
    _, spans = scan(docs.where(may_hold_secret(F.col("text").cast("string"))), owner=owner, repository=repository)
    cuts = spans.where("not example").select("text_key", F.struct((F.col("end") - F.col("value_length")).alias("start"), "end").alias("cut")).distinct()
    cuts = cuts.groupBy("text_key").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    columns = docs.columns
    holds = may_hold_secret(F.col("text").cast("string"))
    rest = docs.where(~holds)
    hit = docs.where(holds).select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.sha2(F.col("text").cast("string"), 256).alias("text_key"))
    text = F.col("row.text")

    def cut_out(done: Column, cut: Column) -> Column:
        new = cut["start"] >= done["at"]
        kept = F.substring(text, done["at"] + 1, F.greatest(cut["start"] - done["at"], F.lit(0)))
        out = F.when(new, F.concat(done["out"], kept, F.lit(MASK))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], cut["end"].cast("int")).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("cuts", start, cut_out, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text))))
    hit = hit.join(cuts, "text_key", "left").withColumn("clean", F.when(F.col("cuts").isNull(), text).otherwise(clean))
    fields = {"text": F.col("clean")}
    if "n_chars" in columns:
        fields["n_chars"] = F.char_length("clean").cast(docs.schema["n_chars"].dataType)
    return rest.unionByName(hit.select(*[fields.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns]))
