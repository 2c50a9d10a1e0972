"""Computed and constant columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def add_column(
    df: DataFrame,
    column_name: str,
    expression: Column | str | None = None,
    default_value=None,
    data_type: T.DataType | str | None = None,
) -> DataFrame:
    """Add a column from a SQL string or a Column, else a constant, else NULL.

    A constant is ignored next to an expression. `data_type` casts the result;
    give it for NULL columns, as few writers accept the untyped NULL.
    """
    if expression is None:
        value = F.lit(default_value)
    else:
        value = F.expr(expression) if isinstance(expression, str) else expression
    return df.withColumn(column_name, value if data_type is None else value.cast(data_type))
