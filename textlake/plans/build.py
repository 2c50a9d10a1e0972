"""End to end: raw files to the stored tables."""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.plans.tables import (
    analytics,
    article_documents,
    clean_articles,
    clean_pageviews,
    rankings,
    unique_articles,
    unreadable,
    viewed_keys,
)
from textlake.operators import keep_matching
from textlake.schemas import ANALYTICS_SQL, DOCUMENTS, KEY, RANKINGS_SQL
from textlake.sinks import (
    load_to_postgres,
    upload_to_mongo,
    write_analytics,
    write_documents,
    write_rankings,
)
from textlake.sinks.stores import INSERT_BATCH, RELATIONAL_BATCH
from textlake.sources import read_articles, read_collection, read_pageviews, read_table
from textlake.workspace import land, temporary

_WRITERS = {
    "article_rankings": write_rankings,
    "article_analytics": write_analytics,
    "article_documents": write_documents,
}


@dataclasses.dataclass(frozen=True)
class BuildReport:
    """Where the tables are, and the counts taken on the way.

    Rows of the raw files and those kept, dates and ranks that could not be read,
    counts too long for a long; lines of the corpus and those that could not be read,
    records of viewed articles before and after deduplication; documents.
    """

    paths: dict[str, str]
    raw_pageviews: int
    kept_pageviews: int
    bad_dates: int
    bad_ranks: int
    overflowed_views: int
    raw_articles: int
    unreadable_articles: int
    viewed_articles: int
    unique_articles: int
    documents: int


def _counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """`df` with its rows, and those under conditions, counted by the job that reads it."""
    observation = Observation()
    counts = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


def build_tables(
    spark: SparkSession,
    pageviews_path: str,
    articles_path: str,
    target: str,
    mode: str = "append",
    articles_filetype: str = "jsonl",
) -> BuildReport:
    """Read both raw inputs once, and write the three tables below `target`.

    The raw text becomes two clean columnar tables in the shared folder, of which
    the corpus holds only the viewed articles; everything after reads those, and
    they are deleted at the end. The row counts ride on these two jobs, which
    have no shuffle (unless the viewed titles are too many to broadcast), so that
    a lost executor does not count a row twice. Rankings are range-partitioned by a
    sample of their input, which is why the clean table is stored first.

    Appending again adds the rows again; use ``mode="overwrite"`` to rerun.
    """
    with temporary(spark):
        flagged = read_pageviews(spark, pageviews_path, flags=True)
        raw, raw_views = _counted(flagged, bad_date=F.col("bad_date"), bad_rank=F.col("bad_rank"))
        clean, kept_views = _counted(clean_pageviews(raw), overflowed=F.col("views").isNull())
        pageviews = land(clean, "pageviews")
        keys = viewed_keys(pageviews)

        raw, raw_texts = _counted(read_articles(spark, articles_path, articles_filetype), unreadable=unreadable())
        viewed, viewed_texts = _counted(keep_matching(clean_articles(raw), keys, [KEY]))
        articles = land(viewed, "articles")
        once = land(unique_articles(articles), "unique-articles")

        products = {
            "article_rankings": rankings(pageviews),
            "article_analytics": analytics(pageviews),
            "article_documents": article_documents(pageviews, once, viewed_only=True),
        }
        paths = {name: f"{target.rstrip('/')}/{name}" for name in products}
        for name, table in products.items():
            # rankings only add columns to the landed pageviews
            _WRITERS[name](table, paths[name], mode, landed=name == "article_rankings")
        # rows of landed tables, from their footers
        n_unique, n_documents = once.count(), keys.count()

    return BuildReport(
        paths=paths,
        raw_pageviews=raw_views.get["rows"],
        kept_pageviews=kept_views.get["rows"],
        bad_dates=raw_views.get["bad_date"],
        bad_ranks=raw_views.get["bad_rank"],
        overflowed_views=kept_views.get["overflowed"],
        raw_articles=raw_texts.get["rows"],
        unreadable_articles=raw_texts.get["unreadable"],
        viewed_articles=viewed_texts.get["rows"],
        unique_articles=n_unique,
        documents=n_documents,
    )


def open_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The tables of a build by name, also as temporary views for SQL text."""
    tables = {name: read_table(spark, path) for name, path in paths.items()}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def load_stores(
    spark: SparkSession,
    paths: dict[str, str],
    db_config: dict,
    uri: str,
    collection_name: str,
    db_name: str = "textlake",
    mode: str = "append",
    batch_size: int = RELATIONAL_BATCH,
    max_connections: int = 16,
    document_batch: int = INSERT_BATCH,
) -> None:
    """Copy the tables of a build to the relational and the document store.

    Documents replace stored ones of the same key and part, so that they are not
    doubled by a rerun. Parts that the store has and the build has no more become
    blanks, which lookups leave out. To find them the store sends key and part of its
    documents, without the blanks it already has.
    """
    for name, types in (
        ("article_rankings", RANKINGS_SQL), ("article_analytics", ANALYTICS_SQL),
    ):
        table = read_table(spark, paths[name])
        load_to_postgres(table, list(types), types, db_config, name, batch_size, mode, max_connections)
    documents = read_table(spark, paths["article_documents"], DOCUMENTS)
    if mode == "append":
        stored = read_collection(spark, db_name, collection_name, uri, _PLACE, FILLED_PLACES)
        documents = documents.unionByName(stale_parts(stored, documents))
    upload_to_mongo(
        documents, db_name, collection_name, uri, document_batch, mode, replace_on=[KEY, "part"])


_PLACE = T.StructType([DOCUMENTS[name] for name in (KEY, "part")])
#: What the document store runs itself: key and part of the documents that have entries.
FILLED_PLACES = json.dumps([
    {"$match": {"date.0": {"$exists": True}}},
    {"$project": {"_id": 0, **{field.name: 1 for field in _PLACE}}},
])


def stale_parts(stored: DataFrame, documents: DataFrame) -> DataFrame:
    """A blank document for each key and part of `stored` that `documents` lack.

    An empty collection read without a schema has no columns, and nothing is stale.
    """
    if KEY not in stored.columns:
        return documents.where(F.lit(False))
    place = F.struct(F.col(KEY), F.col("part").cast("long").alias("part"))
    gone = stored.select(place.alias("place")).join(documents.select(place.alias("place")), "place", "left_anti")
    empty = {f.name: F.array().cast(f.dataType) if isinstance(f.dataType, T.ArrayType) else F.lit(None).cast(f.dataType) for f in DOCUMENTS}
    return gone.select("place.*", *[c.alias(n) for n, c in empty.items() if n not in (KEY, "part")]).select(*documents.columns)
