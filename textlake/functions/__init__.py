from textlake.functions.titles import (
    counted_views,
    is_view_count,
    popularity_bucket,
    title_key,
)

__all__ = ["counted_views", "is_view_count", "popularity_bucket", "title_key"]
