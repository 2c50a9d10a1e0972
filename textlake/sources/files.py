"""CSV, JSON and JSON-lines scans over a file or a folder of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake import schemas

# Format and reader options for each accepted file type.
_READERS = {
    "csv": ("csv", {"header": True}),
    "json": ("json", {"multiLine": True}),
    "jsonl": ("json", {"multiLine": False}),
}


def ingest_data(
    spark: SparkSession,
    filepath: str | list[str],
    filetype: str,
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Read `filepath` as csv, json (one value per file) or jsonl (one per line).

    Without a schema the types are inferred, which reads the input twice. With
    one, the input is read once and unused fields are never materialised; a CSV
    header must then name its columns in their order (`read_pageviews` goes by
    name). Further
    keyword arguments are passed to the Spark reader, e.g. ``escape='"'`` for
    CSV files that double their quotes. A json file is one task and is parsed as
    a whole, so keep such files small; the other types are split.
    """
    kind = filetype.lower()
    if kind not in _READERS:
        raise ValueError(f"cannot read file type {filetype!r}: use one of {sorted(_READERS)}")
    source, defaults = _READERS[kind]
    reader = spark.read.format(source).options(**defaults)
    if schema is not None:
        reader = reader.schema(schema)
        if kind == "csv":
            # a header in another order is an error instead of values in wrong columns
            reader = reader.option("enforceSchema", False)
    elif kind == "csv":
        reader = reader.option("inferSchema", True)
    return reader.options(**options).load(filepath)


def read_pageviews(
    spark: SparkSession,
    filepath: str | list[str],
    flags: bool = False,
    recover: bool = False,
    file: bool = False,
    **options,
) -> DataFrame:
    """Daily view counts from CSV in the layout of `schemas.PAGEVIEWS`.

    Columns are found by header name, in any order: reading them all as text
    needs only the header line, where inference would scan the files. Files of
    one folder must have the same header; another one is an error. A value that
    does not fit its type becomes NULL; `flags` adds bad_date and bad_rank, which
    say that there was one. `file` adds the path of the file that a row is from.

    With `recover`, a line that does not have as many fields as the header is parsed once
    more, alone, with the other way to write a quote in a quoted field (doubled instead
    of behind a backslash, or the reverse), so that one file may have both. `flags` then
    adds recovered and lost: lines that fit so, and those that fit neither way.
    """
    text_options = {"inferSchema": False, "enforceSchema": False, **options}
    text = ingest_data(spark, filepath, "csv", **text_options)
    also = [F.col("_metadata.file_path").alias("file")] if file else []
    if recover:
        text = _recovered(spark, filepath, text.schema, text_options, also)
        also = ["file"] if file else []
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.PAGEVIEWS]
    bad = [
        (F.col(c).isNotNull() & F.col(c).try_cast(schemas.PAGEVIEWS[c].dataType).isNull()).alias(f"bad_{c}")
        for c in ("date", "rank") if flags
    ]
    return text.select(*typed, *bad, *(["recovered", "lost"] if flags and recover else []), *also)


def _recovered(spark: SparkSession, filepath: str | list[str], header: T.StructType, options: dict, also: list) -> DataFrame:
    """The lines as text columns, with recovered, lost and the columns `also`."""
    schema = T.StructType([*header, T.StructField(schemas.CORRUPT, T.StringType())])
    # all columns, as a line is known to be broken by its number of fields
    whole = {**options, "columnNameOfCorruptRecord": schemas.CORRUPT, "columnPruning": False}
    lines = spark.read.format("csv").options(**{**_READERS["csv"][1], **whole}).schema(schema).load(filepath)
    other = "\\" if options.get("escape") == '"' else '"'
    again = {k: str(v) for k, v in options.items() if k not in ("inferSchema", "enforceSchema", "header")}
    again |= {"escape": other, "columnNameOfCorruptRecord": schemas.CORRUPT}
    ddl = ", ".join(f"`{name.replace('`', '``')}` string" for name in schema.names)
    broken = F.col(schemas.CORRUPT).isNotNull()
    parsed = F.when(broken, F.from_csv(schemas.CORRUPT, ddl, again))
    lines = lines.select("*", *also, parsed.alias("again"))
    fits = broken & F.col(f"again.{schemas.CORRUPT}").isNull()
    columns = [F.when(fits, F.col(f"again.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in header.names]
    also_names = [c for c in lines.columns if c not in (*schema.names, "again")]
    return lines.select(*columns, fits.alias("recovered"), (broken & ~fits).alias("lost"), *also_names)


def read_articles(
    spark: SparkSession,
    filepath: str | list[str],
    filetype: str = "jsonl",
    schema: T.StructType = schemas.ARTICLES,
    file: bool = False,
    **options,
) -> DataFrame:
    """The article corpus with `schema` plus the text of unreadable records.

    An unreadable record is a row with NULL fields and `_corrupt_record` set, so
    that it can be counted before it is dropped. `file` adds the path of the file that
    a record is from.
    """
    with_corrupt = T.StructType(list(schema) + [T.StructField(schemas.CORRUPT, T.StringType())])
    records = ingest_data(
        spark, filepath, filetype, with_corrupt,
        **{"columnNameOfCorruptRecord": schemas.CORRUPT, **options},
    )
    return records.select("*", F.col("_metadata.file_path").alias("file")) if file else records
