"""Writes to a relational database and to a document store.

Both run on the executors through a Spark data source; no row passes the driver.
The PostgreSQL JDBC driver and the MongoDB Spark connector are not part of Spark:
put them on the classpath (``spark.jars.packages``) of a session that uses them.
"""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlake.workspace import land

_ROW_NUMBER = "load_row"

# Rows of an insert into the document and into the relational store.
INSERT_BATCH, RELATIONAL_BATCH = 500, 1000

# SQL column types whose name means something else in Spark, or nothing.
# FLOAT is double precision in PostgreSQL, and a Spark string becomes TEXT there.
RELATIONAL_TYPES = {
    "TEXT": "string",
    "FLOAT": "double",
    "DOUBLE PRECISION": "double",
}


def jdbc_options(db_config: dict, table_name: str) -> dict:
    """JDBC options from connection parameters.

    `db_config` has ``host``, ``port`` and ``dbname``, or a complete ``url``; all
    its other entries (``user``, ``password``, ``driver``) are passed through.
    """
    rest = dict(db_config)
    host, port, name = rest.pop("host", "localhost"), rest.pop("port", 5432), rest.pop("dbname", "")
    url = rest.pop("url", None) or f"jdbc:postgresql://{host}:{port}/{name}"
    return {"url": url, "dbtable": table_name, **rest}


def collection_options(db_name: str, collection_name: str, uri: str) -> dict:
    return {"connection.uri": uri, "database": db_name, "collection": collection_name}


def _spark_type(sql_type: str) -> str:
    """The Spark type that a SQL type is sent as; text for those that Spark does not have."""
    name = RELATIONAL_TYPES.get(sql_type.upper(), sql_type)
    try:
        return T.DataType.fromDDL(name).simpleString()
    except ParseException:
        return "string"


def relational_rows(records: DataFrame, columns: list[str], column_types: dict) -> DataFrame:
    """`columns` in order, cast to the Spark types of their SQL types.

    Any SQL type goes. One that Spark does not have (UUID, JSONB) is sent as text, and so
    a created table has it: fill the table by `stage_for_postgres`, which casts.
    """
    return records.select(*[F.col(c).cast(_spark_type(column_types[c])).alias(c) for c in columns])


def created_types(columns: list[str], column_types: dict) -> str:
    """The column types of a table that the writer creates, for its option `createTableColumnTypes`.

    Lengths, precisions and narrow types (VARCHAR(20), NUMERIC(12,2), SMALLINT) go there as
    asked. Left out is what the option cannot carry: those types that the writer chooses
    itself (TEXT for a string, DOUBLE PRECISION for a double), and those that Spark does
    not have (UUID, JSONB), which a created table gets as TEXT.
    """
    def known(sql_type: str) -> bool:
        try:
            T.DataType.fromDDL(sql_type)
        except ParseException:
            return False
        return sql_type.upper() not in ("STRING", "DOUBLE")

    return ", ".join(f"`{c}` {column_types[c]}" for c in columns if known(column_types[c]))


def load_to_postgres(
    records: DataFrame,
    columns: list[str],
    column_types: dict,
    db_config: dict,
    table_name: str,
    batch_size: int = RELATIONAL_BATCH,
    mode: str = "append",
    max_connections: int = 16,
) -> None:
    """Insert `records`, creating the table with their SQL types if it is missing (`created_types`).

    Each partition is one transaction on one connection; at most `max_connections`
    run at a time. A partition that is rerun after its commit is inserted twice:
    use `stage_for_postgres` where that must not happen.
    """
    rows = relational_rows(records, columns, column_types)
    _write_jdbc(rows, db_config, table_name, batch_size, mode, max_connections, created_types(columns, column_types))


def stage_for_postgres(
    records: DataFrame,
    columns: list[str],
    column_types: dict,
    db_config: dict,
    table_name: str,
    batch_size: int = RELATIONAL_BATCH,
    max_connections: int = 16,
) -> list[str]:
    """Fill ``<table_name>_staging`` and return the SQL that publishes it.

    Run the statements in one transaction of the database: readers then see all
    rows or none. Rows are numbered by their place in a landed copy, so a task that
    runs again writes the same numbers, and publishing takes each number once.
    """
    rows = land(relational_rows(records, columns, column_types), "relational")
    numbered = rows.select(F.monotonically_increasing_id().alias(_ROW_NUMBER), "*")
    staging = f"{table_name}_staging"
    _write_jdbc(numbered, db_config, staging, batch_size, "overwrite", max_connections)
    return publish_statements(columns, column_types, staging, table_name)


def publish_statements(
    columns: list[str], column_types: dict, staging: str, table_name: str
) -> list[str]:
    listed = ", ".join(columns)
    typed = ", ".join(f"{c} {column_types[c]}" for c in columns)
    cast = ", ".join(f"CAST({c} AS {column_types[c]})" for c in columns)
    return [
        f"CREATE TABLE IF NOT EXISTS {table_name} ({typed})",
        f"INSERT INTO {table_name} ({listed}) SELECT {cast} FROM "
        f"(SELECT DISTINCT {_ROW_NUMBER}, {listed} FROM {staging}) AS numbered",
        f"DROP TABLE {staging}",
    ]


def _write_jdbc(rows, db_config, table_name, batch_size, mode, max_connections, types="") -> None:
    created = {"createTableColumnTypes": types} if types else {}
    # Overwriting empties the table instead of dropping it.
    rows.write.format("jdbc").options(
        **jdbc_options(db_config, table_name),
        batchsize=batch_size,
        numPartitions=max_connections,
        truncate=True,
        **created,
    ).mode(mode).save()


def upload_to_mongo(
    data: DataFrame,
    db_name: str,
    collection_name: str,
    uri: str,
    batch_size: int = INSERT_BATCH,
    mode: str = "append",
    replace_on: list[str] | None = None,
) -> None:
    """Insert one document per row in batches of `batch_size`.

    With `replace_on` (e.g. ``["article_name", "part"]``) a document replaces the
    stored one with the same fields, so reruns and task retries do not duplicate.
    """
    options = {**collection_options(db_name, collection_name, uri), "maxBatchSize": batch_size}
    if replace_on:
        options.update(operationType="replace", idFieldList=",".join(replace_on))
    data.write.format("mongodb").options(**options).mode(mode).save()
