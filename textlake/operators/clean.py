"""Column subset, corrupt-row filter and join key, as one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textlake.functions import is_view_count, title_key


def basic_preprocessing(
    df: DataFrame,
    columns_to_select: list[str],
    column_to_standardise: str,
    new_column_name: str,
) -> DataFrame:
    """Keep some columns and add the normalised key of one of them.

    If ``views`` is among the kept columns, rows whose views are not a run of
    digits (NULL included) are dropped. The original title stays.
    """
    kept = df.select(*columns_to_select)
    if "views" in kept.columns:
        kept = kept.where(is_view_count("views"))
    return kept.withColumn(new_column_name, title_key(column_to_standardise))
