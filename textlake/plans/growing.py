"""Article documents that grow with each load of pageviews, instead of being built anew.

The table is a log: every load adds a folder ``version=N`` with the parts that it changed,
and the newest version of a part counts. A history is sorted, so a load changes a
document's parts from the first one on whose last entry lies behind the load's first entry;
mostly that is the last part alone. Parts before it, and documents without new entries,
are neither written nor moved.

Beside its arrays a part has its number of entries and its last entry: where a load
begins is found from these columns alone. Full parts lie in folders ``open=false``,
which a load that only adds later days does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.operators import article_histories, df_join
from textlake.operators.histories import ENTRY, MAX_ENTRIES
from textlake.schemas import DOCUMENTS, KEY
from textlake.workspace import folders, land

_LAST = T.StructType([T.StructField(name, DOCUMENTS[name].dataType.elementType) for name in ENTRY])
_STORED = T.StructType([*DOCUMENTS, T.StructField("n_entries", T.LongType()), T.StructField("last", _LAST),
                        T.StructField("version", T.LongType()), T.StructField("open", T.BooleanType())])
_PLACE = ["key", "part", "version"]


def _key() -> Column:
    """The key as a struct: as such, two NULL keys are equal."""
    return F.struct(F.col(KEY).alias("name")).alias("key")


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.removeprefix("version=")) for name in folders(spark, path) if name.startswith("version="))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    if not _versions(spark, path):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).parquet(path)


def _places(stored: DataFrame) -> DataFrame:
    """(key, part, version, n_entries, last) of each part's newest version."""
    own = F.struct("version", "n_entries", "last")
    newest = stored.select(_key(), "part", own.alias("own")).groupBy("key", "part").agg(F.max_by("own", "own.version").alias("own"))
    return newest.select("key", "part", "own.*")


def first_changed_parts(pageviews: DataFrame, stored: DataFrame, max_entries: int) -> DataFrame:
    """(key, start, full) of every key of `pageviews`: the first part that they change.

    That is the first part whose last entry comes after the key's first new one; if there
    is none, the last part if it has room, else a new one. `full` says that the parts
    from there on include a full one that is stored.
    """
    news = pageviews.groupBy(_key()).agg(F.min(F.struct(*ENTRY)).alias("first"))
    found = news.join(_places(stored), "key", "left")
    last = F.max(F.struct("part", "n_entries")).alias("end")
    changed = F.min(F.when(F.col("first") < F.col("last"), F.col("part"))).alias("changed")
    filled = F.max(F.when(F.col("n_entries") >= max_entries, F.col("part"))).alias("filled")
    ends = found.groupBy("key").agg(changed, last, filled)
    after = F.when(F.col("end.n_entries") < max_entries, F.col("end.part")).otherwise(F.col("end.part") + 1)
    start = F.coalesce("changed", after, F.lit(0)).cast("long")
    return ends.select("key", start.alias("start"), F.coalesce(F.col("filled") >= start, F.lit(False)).alias("full"))


def append_documents(
    spark: SparkSession, path: str, pageviews: DataFrame, articles: DataFrame, max_entries: int = MAX_ENTRIES
) -> None:
    """Add a load of pageviews to the documents below `path`, which may be empty yet.

    `pageviews` is read more than once, so give a stored table; `articles` has one row
    per key, the texts of the changed parts. All loads of a table must have the same
    `max_entries`. A load that fails leaves no version; one that is repeated adds its
    entries again, as `sinks` do when they append.
    """
    stored = _stored(spark, path)
    starts = land(first_changed_parts(pageviews, stored, max_entries), "first-changed-parts")
    if starts.isEmpty():
        return
    read = stored.where("open") if starts.where("full").isEmpty() else stored
    current = _places(stored).select(*_PLACE)
    changed = read.withColumn("key", _key()).join(starts.select("key", "start"), "key").where("part >= start").join(current, _PLACE, "left_semi")
    entry = F.explode(F.arrays_zip(*ENTRY)).alias("entry")
    old = changed.select(KEY, entry).select(KEY, *[f"entry.{c}" for c in ENTRY])
    entries = old.unionByName(pageviews.select(KEY, *ENTRY))
    # its parts are numbered from 0 on, those before `start` are full
    built = article_histories(entries, KEY, max_entries).withColumn("key", _key()).join(starts, "key")
    built = built.withColumn("part", F.col("part") + F.col("start"))
    documents = df_join(built.select(KEY, "part", *ENTRY), articles.select(KEY, "description", "url", "abstract"), [KEY])
    _write(documents.select(*DOCUMENTS.names), path, max([-1, *_versions(spark, path)]) + 1, max_entries)


def _write(documents: DataFrame, path: str, version: int, max_entries: int) -> None:
    last = F.element_at(F.arrays_zip(*ENTRY), -1).cast(_LAST)
    rows = documents.withColumns({"n_entries": F.size("date").cast("long"), "last": last, "open": F.size("date") < max_entries})
    rows.sortWithinPartitions("open", KEY, "part").write.partitionBy("open").parquet(f"{path.rstrip('/')}/version={version}")


def current_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents as `plans.article_documents` would build them from all loads at once.

    Parts that a later load changed are left out by an anti join; there are as many of
    these as parts changed since the table was last compacted, so Catalyst broadcasts them
    while they are few. A condition on the key reaches the scan.
    """
    stored = _stored(spark, path)
    # only what is stored more than once can be out of date
    several = stored.select(_key(), "part", "version").groupBy("key", "part").agg(F.count("*").alias("n"), F.max("version").alias("newest")).where("n > 1").drop("n")
    stale = land(stored.select(_key(), "part", "version").join(several, ["key", "part"]).where("version < newest").select(*_PLACE), "stale-parts")
    return stored.withColumn("key", _key()).join(stale, _PLACE, "left_anti").select(*DOCUMENTS.names)


def compact_documents(spark: SparkSession, path: str, target: str, max_entries: int = MAX_ENTRIES) -> None:
    """Write the current documents to a new table, as its only version."""
    _write(current_documents(spark, path), target, 0, max_entries)
