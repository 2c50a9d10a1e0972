from textlake.sinks.stores import load_to_postgres, stage_for_postgres, upload_to_mongo
from textlake.sinks.tables import REPLACE_YEARS, write_analytics, write_documents, write_months, write_rankings

__all__ = [
    "REPLACE_YEARS",
    "load_to_postgres",
    "stage_for_postgres",
    "upload_to_mongo",
    "write_analytics",
    "write_documents",
    "write_months",
    "write_rankings",
]
