"""Reads from the stores that the sinks write to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from textlake.sinks.stores import collection_options, jdbc_options


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table written by `textlake.sinks`."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_relational(
    spark: SparkSession,
    db_config: dict,
    table_name: str,
    split_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A relational table over JDBC; filters on it run in the database.

    Give `split_column` with its bounds and `num_partitions` to read a large
    table as parallel ranges of that column (numeric, date or timestamp).
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(db_config, table_name))
    if split_column is not None:
        reader = reader.options(
            partitionColumn=split_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions,
        )
    return reader.load()


def read_collection(
    spark: SparkSession,
    db_name: str,
    collection_name: str,
    uri: str,
    schema: T.StructType | None = None,
    aggregation: str | None = None,
) -> DataFrame:
    """A document collection through the MongoDB Spark connector.

    `aggregation`, a JSON array of stages, runs in the store before anything is sent.
    """
    options = collection_options(db_name, collection_name, uri)
    if aggregation is not None:
        options["aggregation.pipeline"] = aggregation
    reader = spark.read.format("mongodb").options(**options)
    return (reader if schema is None else reader.schema(schema)).load()
