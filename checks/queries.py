"""The registered queries: (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture
from textlake import plans, sinks, sources
from textlake.functions import title_key
from textlake.operators import add_column as with_column
from textlake.operators import (
    basic_preprocessing,
    deduplicate_df,
    df_join,
    groupby_expr,
)
from textlake.plans.tables import ARTICLE_ORDER
from textlake.schemas import ANALYTICS, ARTICLES, DOCUMENTS, KEY, MONTHS, RANKINGS
from textlake.workspace import fresh_path, land

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The example parameters of the read queries.
DAY, YEAR, MONTH, TITLE, SEED = "1997-09-21", 1997, 9, "Small_Ring", 42

# Entries per document in the query that splits histories.
SPLIT_AT = 365

CORPUS_SCHEMA = T.StructType([T.StructField("id", T.LongType()), *ARTICLES])
CORPUS_ORDER = ["id", "name", "description", "url", "abstract"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Scans: the derived raw tables are written as files by Spark and read back.

@query
def scan_csv(spark, sf_dir):
    path = fresh_path(spark, "pageviews-csv")
    fixture.raw_pageviews(spark, sf_dir).write.option("header", True).csv(path)
    return sources.read_pageviews(spark, path)


@query
def scan_csv_inferred(spark, sf_dir):
    path = fresh_path(spark, "pageviews-csv")
    fixture.raw_pageviews(spark, sf_dir).write.option("header", True).csv(path)
    return sources.ingest_data(spark, path, "CSV")


@query
def scan_jsonl(spark, sf_dir):
    path = fresh_path(spark, "articles-jsonl")
    fixture.raw_articles(spark, sf_dir).write.json(path)
    return sources.read_articles(spark, path, "jsonl", CORPUS_SCHEMA).select(*CORPUS_ORDER)


@query
def scan_jsonl_inferred(spark, sf_dir):
    path = fresh_path(spark, "articles-jsonl")
    fixture.raw_articles(spark, sf_dir).write.json(path)
    return sources.ingest_data(spark, path, "jsonl")


@query
def scan_json(spark, sf_dir):
    """One array of records per file, over several lines; a file has some 4 MB."""
    path = fresh_path(spark, "articles-json")
    records = fixture.raw_articles(spark, sf_dir).select(F.struct(*CORPUS_ORDER).alias("record"))
    size = records.agg(F.sum(F.octet_length(F.to_json("record")))).first()[0] or 0
    (
        records.groupBy(F.pmod(F.xxhash64("record"), F.lit(size // (4 << 20) + 1)).alias("file"))
        .agg(F.to_json(F.collect_list("record"), {"pretty": "true"}).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1).text(path)
    )
    return sources.read_articles(spark, path, "json", CORPUS_SCHEMA).select(*CORPUS_ORDER)


# Projections and filters

@query
def standardise(spark, sf_dir):
    return fixture.pageviews(spark, sf_dir).select("article", "views", "date", "rank", KEY)


@query
def standardise_texts(spark, sf_dir):
    documents = fixture.table(spark, sf_dir, "documents")
    return basic_preprocessing(documents, ["doc_id", "text"], "text", "text_key").select(
        "doc_id", "text_key")


@query
def row_count_drop(spark, sf_dir):
    quality = plans.pageview_quality(fixture.raw_pageviews(spark, sf_dir))
    return quality.select("raw_rows", "kept_rows")


def _dirty_csv(spark, sf_dir):
    path = fresh_path(spark, "dirty-csv")
    fixture.dirty_order_views(spark, sf_dir).write.option("header", True).csv(path)
    return path


def _dirty_jsonl(spark, sf_dir):
    path = fresh_path(spark, "dirty-jsonl")
    fixture.dirty_customer_lines(spark, sf_dir).write.text(path)
    return path


def _quoted_csv(spark, sf_dir):
    """A file for each of five slots, with both ways to write a quote; the lines are written as they are."""
    path = fresh_path(spark, "quoted-csv")
    lines = fixture.quoted_order_lines(spark, sf_dir).repartition("slot")
    lines.write.partitionBy("slot").options(header=True, quote="", sep="\u0001").csv(path)
    return f"{path}/*"


@query
def recovered_rows(spark, sf_dir):
    """Rows of a file with both ways to write a quote, those lost left out."""
    raw = sources.read_pageviews(spark, _quoted_csv(spark, sf_dir), flags=True, recover=True)
    return raw.where("not lost").select("article", "date", "views", "rank", "recovered")


@query
def recovered_rankings(spark, sf_dir):
    return plans.rankings(plans.clean_pageviews(sources.read_pageviews(spark, _quoted_csv(spark, sf_dir), recover=True)))


def _slot(files):
    """The slot that a file's folder says, in place of its path."""
    return files.withColumn("slot", F.regexp_extract("file", "slot=([0-9]+)/[^/]*$", 1).cast("long")).drop("file")


@query
def pageview_files(spark, sf_dir):
    raw = sources.read_pageviews(spark, _quoted_csv(spark, sf_dir), flags=True, recover=True, file=True)
    return _slot(plans.pageview_files(raw))


@query
def article_files(spark, sf_dir):
    """Faults of a corpus by file: a file holds the records of one market segment."""
    path = fresh_path(spark, "segments")
    segment = F.coalesce(F.get_json_object("value", "$.description"), F.lit("unreadable")).alias("slot")
    fixture.dirty_customer_lines(spark, sf_dir).select("value", segment).repartition("slot").write.partitionBy("slot").text(path)
    files = plans.article_files(sources.read_articles(spark, f"{path}/*", file=True))
    return files.withColumn("slot", F.regexp_extract("file", "slot=([A-Za-z]+)/[^/]*$", 1)).drop("file")


@query
def quality_report(spark, sf_dir):
    """Every figure above zero: on rows with each kind of fault."""
    return plans.pageview_quality(sources.read_pageviews(spark, _dirty_csv(spark, sf_dir), flags=True))


@query
def corpus_quality(spark, sf_dir):
    raw = sources.read_articles(spark, _dirty_jsonl(spark, sf_dir))
    return plans.corrupt_records(raw).crossJoin(plans.corpus_counts(plans.clean_articles(raw)))


@query
def build_report(spark, sf_dir):
    """What a build counts on the way, every figure above zero."""
    views, corpus = _dirty_csv(spark, sf_dir), _dirty_jsonl(spark, sf_dir)
    report = dataclasses.asdict(plans.build_tables(spark, views, corpus, fresh_path(spark, "tables")))
    del report["paths"]
    return spark.createDataFrame([tuple(report.values())], ", ".join(f"{name} long" for name in report))


@query
def distinct_count(spark, sf_dir):
    return fixture.pageviews(spark, sf_dir).agg(F.count_distinct(KEY).alias("n"))


@query
def bucket(spark, sf_dir):
    return groupby_expr(rankings(spark, sf_dir), "popularity_bucket", ["count(*) AS n"])


@query
def rankings(spark, sf_dir):
    return plans.rankings(fixture.pageviews(spark, sf_dir))


@query
def add_column(spark, sf_dir):
    df = fixture.pageviews(spark, sf_dir).select(KEY, "date", "views", "rank")
    df = with_column(df, "doubled", "views * 2")
    df = with_column(df, "next_rank", F.col("rank") + 1, default_value=0)
    df = with_column(df, "const", default_value="x")
    df = with_column(df, "empty", data_type="string")
    return df.drop("views", "rank")


@query
def preview(spark, sf_dir):
    rows = fixture.pageviews(spark, sf_dir).select(KEY, "views", "date", "rank")
    return plans.preview(rows, ["date", "rank"])


# Deduplication

@query
def dedup_first(spark, sf_dir):
    return fixture.articles(spark, sf_dir)


@query
def dedup_last(spark, sf_dir):
    return fixture.articles(spark, sf_dir, keep="last")


@query
def dedup_any(spark, sf_dir):
    return deduplicate_df(fixture.corpus(spark, sf_dir), [KEY]).select(KEY)


@query
def dedup_counts(spark, sf_dir):
    return plans.corpus_counts(fixture.corpus(spark, sf_dir))


@query
def dedup_texts(spark, sf_dir):
    """The first of the documents whose whole texts have the same key.

    The key is shuffled as its SHA-256 instead of the text itself.
    """
    documents = fixture.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.sha2(title_key("text"), 256).alias("text_key"),
    )
    return deduplicate_df(documents, ["text_key"], "doc_id").drop("text_key")


# Joins: the deduplicated side is landed, so that the join shuffles both sides
# itself and adaptive execution can split a hot title.

def _joined(pageviews, articles, join_type):
    return df_join(pageviews, land(articles, "articles"), [KEY], join_type)


def _parts_joined(spark, sf_dir, join_type):
    return _joined(fixture.pageviews(spark, sf_dir), fixture.articles(spark, sf_dir), join_type)


@query
def join_left(spark, sf_dir):
    return _parts_joined(spark, sf_dir, "left").select(
        KEY, "article", "views", "date", "rank", "name", "description", "url", "abstract")


@query
def join_inner(spark, sf_dir):
    return _parts_joined(spark, sf_dir, "inner").select(KEY, "views", "date", "rank", "url")


@query
def join_right(spark, sf_dir):
    return _parts_joined(spark, sf_dir, "right").select(KEY, "views", "date", "rank", "url")


@query
def join_full(spark, sf_dir):
    return _parts_joined(spark, sf_dir, "full").select(KEY, "views", "date", "rank", "url")


@query
def join_semi(spark, sf_dir):
    return _parts_joined(spark, sf_dir, "left_semi").select(KEY, "views", "date", "rank")


@query
def join_anti(spark, sf_dir):
    return _parts_joined(spark, sf_dir, "left_anti").select(KEY, "views", "date", "rank")


# Aggregates and documents

@query
def analytics(spark, sf_dir):
    return plans.analytics(fixture.pageviews(spark, sf_dir))


def _documents(spark, sf_dir, **options):
    return plans.article_documents(
        land(fixture.pageviews(spark, sf_dir), "pageviews"),
        fixture.corpus(spark, sf_dir), order_by="id", **options)


def _as_text(documents):
    """Arrays as comma-separated text, the same in every engine."""
    texts = [
        F.array_join(F.col(array).cast("array<string>"), ",").alias(name)
        for array, name in (("date", "dates"), ("views", "views"), ("rank", "ranks"))
    ]
    return documents.select(KEY, "part", *texts, "description", "url", "abstract")


@query
def documents(spark, sf_dir):
    return _as_text(_documents(spark, sf_dir))


@query
def documents_split(spark, sf_dir):
    """Documents in parts of 365 entries."""
    return _as_text(_documents(spark, sf_dir, max_entries=SPLIT_AT))


# Read queries

@query
def lookup_document(spark, sf_dir):
    path = fresh_path(spark, "documents")
    sinks.write_documents(_documents(spark, sf_dir), path)
    stored = sources.read_table(spark, path, DOCUMENTS)
    return _as_text(plans.lookup_document(stored, TITLE))


@query
def sample_document(spark, sf_dir):
    return _as_text(plans.sample_document(_documents(spark, sf_dir), SEED))


@query
def sample_split(spark, sf_dir):
    """One document, all its parts."""
    return _as_text(plans.sample_document(_documents(spark, sf_dir, max_entries=SPLIT_AT), SEED))


@query
def lookup_split(spark, sf_dir):
    """All parts of a document, from the stored table."""
    path = fresh_path(spark, "documents")
    sinks.write_documents(_documents(spark, sf_dir, max_entries=SPLIT_AT), path)
    return _as_text(plans.lookup_document(sources.read_table(spark, path, DOCUMENTS), TITLE))


@query
def lookup_analytics(spark, sf_dir):
    return plans.lookup_analytics(analytics(spark, sf_dir), TITLE)


@query
def top_day(spark, sf_dir):
    return plans.top_article_of_day(rankings(spark, sf_dir), DAY)


def _long(totals):
    """Totals that fit a long, as one."""
    return totals.withColumn("total_views", F.col("total_views").cast("bigint"))


@query
def top_month(spark, sf_dir):
    return _long(plans.top_article_of_month(rankings(spark, sf_dir), YEAR, MONTH))


@query
def top_year(spark, sf_dir):
    return _long(plans.top_article_of_year(rankings(spark, sf_dir), YEAR))


@query
def top_every_day(spark, sf_dir):
    return plans.top_articles_by_day(rankings(spark, sf_dir))


@query
def top_every_month(spark, sf_dir):
    return _long(plans.top_articles_by_month(rankings(spark, sf_dir)))


@query
def top_every_year(spark, sf_dir):
    return _long(plans.top_articles_by_year(rankings(spark, sf_dir)))


# Totals beyond a long, as text

def _text(totals):
    return totals.withColumn("total_views", F.col("total_views").cast("string"))


@query
def huge_top_month(spark, sf_dir):
    return _text(plans.top_article_of_month(fixture.huge_rankings(spark, sf_dir), YEAR, MONTH))


@query
def huge_top_year(spark, sf_dir):
    return _text(plans.top_article_of_year(fixture.huge_rankings(spark, sf_dir), YEAR))


@query
def huge_top_every_month(spark, sf_dir):
    return _text(plans.top_articles_by_month(fixture.huge_rankings(spark, sf_dir)))


@query
def huge_top_every_year(spark, sf_dir):
    return _text(plans.top_articles_by_year(fixture.huge_rankings(spark, sf_dir)))


# The read queries on stored tables: folders, row groups and files are skipped

def _stored_rankings(spark, sf_dir):
    path = fresh_path(spark, "rankings")
    sinks.write_rankings(rankings(spark, sf_dir), path)
    return plans.open_tables(spark, {"article_rankings": path})["article_rankings"]


@query
def stored_top_day(spark, sf_dir):
    return plans.top_article_of_day(_stored_rankings(spark, sf_dir), DAY)


@query
def stored_top_month(spark, sf_dir):
    return _long(plans.top_article_of_month(_stored_rankings(spark, sf_dir), YEAR, MONTH))


@query
def stored_top_year(spark, sf_dir):
    return _long(plans.top_article_of_year(_stored_rankings(spark, sf_dir), YEAR))


@query
def stored_lookup_analytics(spark, sf_dir):
    path = fresh_path(spark, "analytics")
    sinks.write_analytics(analytics(spark, sf_dir), path)
    return plans.lookup_analytics(sources.read_table(spark, path, ANALYTICS), TITLE)


@query
def top_year_sql(spark, sf_dir):
    """Totals of a year as SQL text with parameters, on the stored table."""
    _stored_rankings(spark, sf_dir)
    return spark.sql("""
        SELECT CAST(:year AS INT) AS year, article_name, total_views
        FROM (SELECT article_name, sum(views) AS total_views FROM article_rankings
              WHERE year = :year AND date BETWEEN make_date(:year, 1, 1) AND make_date(:year, 12, 31)
              GROUP BY article_name)
        ORDER BY total_views DESC, article_name LIMIT 1""", args={"year": YEAR})


# The same operators where the number of titles grows with the tables

@query
def orders_quality(spark, sf_dir):
    return plans.pageview_quality(fixture.raw_order_views(spark, sf_dir))


@query
def orders_analytics(spark, sf_dir):
    return plans.analytics(fixture.order_views(spark, sf_dir))


@query
def orders_dedup(spark, sf_dir):
    return plans.unique_articles(fixture.customers(spark, sf_dir))


def _orders_joined(spark, sf_dir, join_type):
    articles = plans.unique_articles(fixture.customers(spark, sf_dir))
    joined = _joined(fixture.order_views(spark, sf_dir), articles, join_type)
    return joined.select(KEY, "views", "date", "rank", "name", "url")


@query
def orders_join_left(spark, sf_dir):
    return _orders_joined(spark, sf_dir, "left")


def _orders_with_copies(spark, sf_dir, join_type):
    """Against the whole corpus: copies and NULL keys on both sides, unmatched rows on both."""
    corpus = fixture.customers(spark, sf_dir)
    joined = df_join(fixture.order_views(spark, sf_dir), corpus, [KEY], join_type)
    return joined.select(*[c for c in (KEY, "views", "date", "rank", "name", "url") if c in joined.columns])


@query
def orders_join_inner(spark, sf_dir):
    return _orders_with_copies(spark, sf_dir, "inner")


@query
def orders_join_right(spark, sf_dir):
    return _orders_with_copies(spark, sf_dir, "right")


@query
def orders_join_full(spark, sf_dir):
    return _orders_with_copies(spark, sf_dir, "full")


@query
def orders_join_semi(spark, sf_dir):
    return _orders_with_copies(spark, sf_dir, "left_semi")


@query
def orders_join_anti(spark, sf_dir):
    return _orders_with_copies(spark, sf_dir, "left_anti")


@query
def orders_rankings(spark, sf_dir):
    return plans.rankings(fixture.order_views(spark, sf_dir))


@query
def orders_documents(spark, sf_dir):
    pageviews = land(fixture.order_views(spark, sf_dir), "pageviews")
    return _as_text(plans.article_documents(pageviews, fixture.customers(spark, sf_dir)))


@query
def orders_top_every_month(spark, sf_dir):
    return _long(plans.top_articles_by_month(orders_rankings(spark, sf_dir)))


@query
def orders_top_every_year(spark, sf_dir):
    return _long(plans.top_articles_by_year(orders_rankings(spark, sf_dir)))


@query
def orders_top_every_day(spark, sf_dir):
    return plans.top_articles_by_day(orders_rankings(spark, sf_dir)).drop("views")


# The roll-up by month: states of two loads that share days, stored one after the other

def _halves(pageviews):
    """Two loads of the same days: every day has rows in both."""
    half = F.pmod(F.xxhash64("article", "views", "date", "rank"), F.lit(2))
    return [pageviews.where(half == k) for k in (0, 1)]


def _stored_months(spark, pageviews):
    path = fresh_path(spark, "months")
    for load in _halves(land(pageviews, "pageviews")):
        sinks.write_months(plans.month_totals(load), path)
    return sources.read_table(spark, path, MONTHS)


@query
def months_analytics(spark, sf_dir):
    return plans.analytics_of_months(_stored_months(spark, fixture.pageviews(spark, sf_dir)))


@query
def orders_months_analytics(spark, sf_dir):
    return plans.analytics_of_months(_stored_months(spark, fixture.order_views(spark, sf_dir)))


@query
def months_lookup_analytics(spark, sf_dir):
    months = _stored_months(spark, fixture.pageviews(spark, sf_dir))
    return plans.lookup_analytics(plans.analytics_of_months(months), TITLE)


@query
def months_merged(spark, sf_dir):
    """The roll-up itself, a row per article and month after both loads."""
    months = plans.merge_months(_stored_months(spark, fixture.order_views(spark, sf_dir)))
    days = F.bit_count("days").cast("long").alias("n_days")
    return months.select(KEY, "year", "month", F.col("total_views").cast("bigint").alias("total_views"), "n_views", "max_views", "best_rank", days)


@query
def months_top_month(spark, sf_dir):
    return _long(plans.top_of_month(_stored_months(spark, fixture.pageviews(spark, sf_dir)), YEAR, MONTH))


@query
def months_top_year(spark, sf_dir):
    return _long(plans.top_of_year(_stored_months(spark, fixture.pageviews(spark, sf_dir)), YEAR))


@query
def orders_months_top_every_month(spark, sf_dir):
    return _long(plans.top_of_months(_stored_months(spark, fixture.order_views(spark, sf_dir))))


@query
def orders_months_top_every_year(spark, sf_dir):
    return _long(plans.top_of_years(_stored_months(spark, fixture.order_views(spark, sf_dir))))


def _huge_months(spark, sf_dir):
    rows = fixture.huge_rankings(spark, sf_dir).withColumn("article", F.col(KEY))
    return _stored_months(spark, rows)


@query
def huge_months_top_month(spark, sf_dir):
    return _text(plans.top_of_month(_huge_months(spark, sf_dir), YEAR, MONTH))


@query
def huge_months_top_every_month(spark, sf_dir):
    return _text(plans.top_of_months(_huge_months(spark, sf_dir)))


@query
def huge_months_top_every_year(spark, sf_dir):
    return _text(plans.top_of_years(_huge_months(spark, sf_dir)))


# Loads of a period that are repeated: the year's folders are replaced

def _reloaded(spark, table, write, year):
    """A table whose first load had a year wrong: loaded again twice, then read back."""
    path = fresh_path(spark, "reloaded")
    table = land(table, "table")
    wrong = F.when(year == YEAR, F.lit("wrong")).otherwise(F.col(KEY)).alias(KEY)
    write(table.select(*[wrong if c == KEY else c for c in table.columns]), path)
    for _ in range(2):
        write(table.where(year == YEAR), path, sinks.REPLACE_YEARS)
    return sources.read_table(spark, path)


@query
def reloaded_rankings(spark, sf_dir):
    return _reloaded(spark, rankings(spark, sf_dir), sinks.write_rankings, F.year("date")).select(*RANKINGS.names)


@query
def orders_reloaded_rankings(spark, sf_dir):
    return _reloaded(spark, orders_rankings(spark, sf_dir), sinks.write_rankings, F.year("date")).select(*RANKINGS.names)


@query
def orders_reloaded_analytics(spark, sf_dir):
    """Statistics after a year's roll-up was corrected."""
    months = plans.month_totals(fixture.order_views(spark, sf_dir))
    return plans.analytics_of_months(_reloaded(spark, months, sinks.write_months, F.col("year")))


# Documents that grow: loads up to a year, from a later year on, then the days between

def _grown(spark, pageviews, articles, year, **options):
    path, pageviews, articles = fresh_path(spark, "grown"), land(pageviews, "pageviews"), land(articles, "texts")
    at = F.year("date")
    for load in (pageviews.where(at < year), pageviews.where(at > year), pageviews.where(at == year)):
        plans.append_documents(spark, path, load, articles, **options)
    return path


@query
def grown_documents(spark, sf_dir):
    """In parts of 365 entries; the last load changes parts in the middle."""
    path = _grown(spark, fixture.pageviews(spark, sf_dir), fixture.articles(spark, sf_dir), YEAR - 2, max_entries=SPLIT_AT)
    return _as_text(plans.current_documents(spark, path))


@query
def orders_grown_documents(spark, sf_dir):
    path = _grown(spark, fixture.order_views(spark, sf_dir), plans.unique_articles(fixture.customers(spark, sf_dir)), YEAR - 2)
    return _as_text(plans.current_documents(spark, path))


@query
def grown_lookup(spark, sf_dir):
    """One document of the grown table, after it was compacted."""
    path, target = _grown(spark, fixture.pageviews(spark, sf_dir), fixture.articles(spark, sf_dir), YEAR, max_entries=SPLIT_AT), fresh_path(spark, "compacted")
    plans.compact_documents(spark, path, target, SPLIT_AT)
    return _as_text(plans.lookup_document(plans.current_documents(spark, target), TITLE))


# A corpus in several files, of which one arrives twice

def _arrived(spark, rows, files, *rule, **options):
    path, rows = fresh_path(spark, "arrivals"), land(rows, "corpus")
    for k in [*range(files), 1]:
        own = F.pmod(F.xxhash64(*rows.columns), F.lit(files)) == k
        plans.add_arrival(rows.where(own), path, f"file {k}", *rule, **options)
    return plans.winners_of_arrivals(spark, path, *rule, **options)


@query
def arrivals_dedup_texts(spark, sf_dir):
    documents = fixture.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.sha2(title_key("text"), 256).alias("text_key"))
    return _arrived(spark, documents, 4, ["text_key"], "doc_id").drop("text_key")


@query
def arrivals_orders_dedup(spark, sf_dir):
    return _arrived(spark, fixture.customers(spark, sf_dir), 5, [KEY], "url", tie_breakers=ARTICLE_ORDER)


# Sinks: written, then read back

@query
def write_rankings(spark, sf_dir):
    path = fresh_path(spark, "rankings")
    sinks.write_rankings(rankings(spark, sf_dir), path)
    return sources.read_table(spark, path).select(*RANKINGS.names)


@query
def orders_write_rankings(spark, sf_dir):
    path = fresh_path(spark, "rankings")
    sinks.write_rankings(land(orders_rankings(spark, sf_dir), "rankings"), path)
    return sources.read_table(spark, path).select(*RANKINGS.names)


@query
def orders_write_analytics(spark, sf_dir):
    path = fresh_path(spark, "analytics")
    sinks.write_analytics(orders_analytics(spark, sf_dir), path)
    return sources.read_table(spark, path, ANALYTICS)


@query
def orders_write_documents(spark, sf_dir):
    """The whole documents table, read back from Parquet."""
    path = fresh_path(spark, "documents")
    pageviews = land(fixture.order_views(spark, sf_dir), "pageviews")
    sinks.write_documents(plans.article_documents(pageviews, fixture.customers(spark, sf_dir)), path)
    return _as_text(sources.read_table(spark, path, DOCUMENTS))


@query
def write_analytics(spark, sf_dir):
    path = fresh_path(spark, "analytics")
    sinks.write_analytics(analytics(spark, sf_dir), path)
    return sources.read_table(spark, path, ANALYTICS)


@query
def write_documents(spark, sf_dir):
    path = fresh_path(spark, "documents")
    sinks.write_documents(_documents(spark, sf_dir), path, source="json")
    stored = spark.read.schema(DOCUMENTS).json(path)
    total = F.aggregate("views", F.lit(0).cast("bigint"), lambda total, n: total + n)
    return (
        stored.select(KEY, F.size("date").alias("n_days"), total.alias("total_views"), "url")
        .groupBy(KEY)
        .agg(F.sum("n_days").alias("n_days"), F.sum("total_views").alias("total_views"),
             F.min("url").alias("url"))
    )


def _all_rows(spark, views, corpus):
    """The rows of the three tables that a build makes, as (table_name, article_name, said)."""
    return _said(plans.open_tables(spark, plans.build_tables(spark, views, corpus, fresh_path(spark, "tables")).paths))


def _said(stored):
    """The rows of the three tables, each as one text."""
    said = {
        "article_rankings": ["views", "popularity_bucket", "date", "rank"],
        "article_analytics": [F.round("avg_views", 3).cast("decimal(30,3)"), "max_views", "best_rank", "total_days_ranked"],
        "article_documents": ["part", "dates", "views", "ranks", "description", "url", "abstract"],
    }
    stored = {**stored, "article_documents": _as_text(stored["article_documents"])}
    rows = [
        stored[name].select(
            F.lit(name).alias("table_name"), KEY,
            F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("-")) for c in columns]).alias("said"))
        for name, columns in said.items()
    ]
    return rows[0].union(rows[1]).union(rows[2])


@query
def end_to_end(spark, sf_dir):
    """CSV and JSON lines to the three stored tables; all their rows."""
    views, corpus = fresh_path(spark, "pageviews-csv"), fresh_path(spark, "articles-jsonl")
    fixture.raw_pageviews(spark, sf_dir).write.option("header", True).csv(views)
    fixture.raw_articles(spark, sf_dir).write.json(corpus)
    return _all_rows(spark, views, corpus)


@query
def orders_end_to_end(spark, sf_dir):
    """The same from files with faults, where titles grow with the tables."""
    return _all_rows(spark, _dirty_csv(spark, sf_dir), _dirty_jsonl(spark, sf_dir))


@query
def updated_tables(spark, sf_dir):
    """The same tables, from a corpus in three files of which one comes twice, and pageviews in
    three loads, the days between the others last; a wrong year is corrected at the end."""
    target, corpus, views = (fresh_path(spark, name) for name in ("tables", "corpus", "views"))
    articles = land(fixture.raw_articles(spark, sf_dir).drop("id"), "raw-articles")
    file = F.pmod(F.xxhash64("url"), F.lit(3))
    for k in range(3):
        articles.where(file == k).write.json(f"{corpus}/{k}")
    for k in (2, 0, 1, 0):
        plans.add_corpus_file(spark, f"{corpus}/{k}", target, f"file {k}")
    pageviews, year = land(fixture.raw_pageviews(spark, sf_dir), "raw-pageviews"), F.year("date")
    loads = {"old": year < YEAR - 2, "new": year > YEAR - 2, "between": year == YEAR - 2}
    for name, rows in loads.items():
        pageviews.where(rows).write.option("header", True).csv(f"{views}/{name}")
        plans.add_pageviews(spark, f"{views}/{name}", target)
    # rankings and statistics as if the middle year had come twice, until it is given once more
    sinks.write_rankings(rankings(spark, sf_dir).where(loads["between"]), f"{target}/article_rankings")
    sinks.write_months(plans.month_totals(fixture.pageviews(spark, sf_dir).where(loads["between"])), f"{target}/article_months")
    for _ in range(2):
        plans.replace_years(spark, f"{views}/between", target)
    return _said(plans.open_updated(spark, target))
