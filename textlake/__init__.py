"""Popularity time series and the text corpora they refer to, on Spark."""

from textlake.operators import (
    add_column,
    basic_preprocessing,
    deduplicate_df,
    df_join,
    groupby_expr,
)
from textlake.sinks import load_to_postgres, upload_to_mongo
from textlake.sources import ingest_data

__all__ = [
    "add_column",
    "basic_preprocessing",
    "deduplicate_df",
    "df_join",
    "groupby_expr",
    "ingest_data",
    "load_to_postgres",
    "upload_to_mongo",
]
