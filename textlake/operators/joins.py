"""Equi-joins by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.workspace import land

_RIGHT = {"right", "rightouter"}
_FULL = {"full", "outer", "fullouter"}


def df_join(
    left_df: DataFrame,
    right_df: DataFrame,
    join_columns: Sequence[str],
    join_type: str = "left",
) -> DataFrame:
    """Join on equal columns; the keys come first and once. NULL matches nothing.

    Any Spark join type is accepted. Adaptive execution splits a hot key on the
    left of inner, left, semi and anti joins, but cannot do so where the right
    side must keep its unmatched rows. A right or full join is therefore made of
    an inner or left join plus the right rows whose key the left does not have;
    for the second part only the distinct left keys are shuffled. The left side
    is read twice, so it is written to the shared folder at once.
    """
    keys = list(join_columns)
    if not keys:
        raise ValueError("give at least one join column")
    for side, df in (("left", left_df), ("right", right_df)):
        missing = [c for c in keys if c not in df.columns]
        if missing:
            raise ValueError(f"no column {', '.join(map(repr, missing))} in the {side} DataFrame")

    kind = join_type.lower().replace("_", "")
    if kind not in _RIGHT | _FULL:
        return left_df.join(right_df, on=keys, how=join_type)

    left_df = land(left_df, "join-left")
    matched = left_df.join(right_df, on=keys, how="inner" if kind in _RIGHT else "left")
    unmatched = right_df.join(left_df.select(*keys).distinct(), on=keys, how="left_anti")
    absent = [F.lit(None).cast(f.dataType).alias(f.name)
              for f in left_df.schema if f.name not in keys]
    rest = [c for c in right_df.columns if c not in keys]
    return matched.union(unmatched.select(*keys, *absent, *rest))


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key occurs in `keys`.

    Cuts a corpus down before it is deduplicated or joined. Give landed keys: Catalyst
    knows their size and broadcasts them only below its threshold.
    """
    return df.join(keys.select(*on), on=list(on), how="left_semi")
