from textlake.operators.aggregate import groupby_expr
from textlake.operators.clean import basic_preprocessing
from textlake.operators.columns import add_column
from textlake.operators.dedup import deduplicate_df
from textlake.operators.histories import article_histories
from textlake.operators.joins import df_join, keep_matching

__all__ = [
    "add_column",
    "article_histories",
    "basic_preprocessing",
    "deduplicate_df",
    "df_join",
    "groupby_expr",
    "keep_matching",
]
