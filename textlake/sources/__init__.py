from textlake.sources.files import ingest_data, read_articles, read_pageviews
from textlake.sources.stores import read_collection, read_relational, read_table

__all__ = [
    "ingest_data",
    "read_articles",
    "read_collection",
    "read_pageviews",
    "read_relational",
    "read_table",
]
