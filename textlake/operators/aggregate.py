"""Grouped aggregation from SQL expression strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def groupby_expr(df: DataFrame, group_col: str | list[str], expr_list: list[str]) -> DataFrame:
    """One row per group with one column per SQL aggregate in `expr_list`.

    Sums, extremes, means and distinct counts are combined before the shuffle,
    so a group of any size is safe. Lists are not: collect histories with
    `article_histories`, which splits large groups.
    """
    keys = [group_col] if isinstance(group_col, str) else list(group_col)
    return df.groupBy(*keys).agg(*map(F.expr, expr_list))
