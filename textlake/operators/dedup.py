"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_POSITION = "__position_in_key"


def deduplicate_df(
    df: DataFrame,
    subset_columns: Sequence[str],
    order_by_column: str | None = None,
    keep: str = "first",
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per distinct value of `subset_columns`.

    Without an order any row may stay. With `order_by_column` it is the smallest
    (``keep="first"``, a NULL counts as smallest) or the largest (``"last"``);
    rows that tie are told apart by `tie_breakers`, ascending, NULL first.

    The position filter becomes a limit per key that runs before the shuffle, so
    each task sends at most one row per key, however many copies it holds.
    """
    keys = list(subset_columns)
    if order_by_column is None:
        return df.dropDuplicates(keys)
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    main = F.asc_nulls_first if keep == "first" else F.desc_nulls_last
    order = [main(order_by_column), *map(F.asc_nulls_first, tie_breakers)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_POSITION, position).where(F.col(_POSITION) == 1).drop(_POSITION)
