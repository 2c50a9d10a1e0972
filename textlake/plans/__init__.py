from textlake.plans.arrivals import add_arrival, winners_of_arrivals
from textlake.plans.build import BuildReport, build_tables, load_stores, open_tables
from textlake.plans.growing import append_documents, compact_documents, current_documents
from textlake.plans.lookup import lookup_analytics, lookup_document, preview, sample_document
from textlake.plans.months import (
    analytics_of_months,
    merge_months,
    month_totals,
    top_of_month,
    top_of_months,
    top_of_year,
    top_of_years,
)
from textlake.plans.quality import (
    article_files,
    corpus_counts,
    corrupt_records,
    pageview_files,
    pageview_quality,
)
from textlake.plans.tables import (
    analytics,
    article_documents,
    clean_articles,
    clean_pageviews,
    rankings,
    unique_articles,
    viewed_keys,
)
from textlake.plans.top import (
    top_article_of_day,
    top_article_of_month,
    top_article_of_year,
    top_articles_by_day,
    top_articles_by_month,
    top_articles_by_year,
)
from textlake.plans.update import (
    add_corpus_file,
    add_pageviews,
    known_articles,
    open_updated,
    replace_years,
)

__all__ = [
    "BuildReport",
    "add_arrival",
    "add_corpus_file",
    "add_pageviews",
    "analytics",
    "analytics_of_months",
    "append_documents",
    "article_documents",
    "article_files",
    "build_tables",
    "clean_articles",
    "clean_pageviews",
    "compact_documents",
    "corpus_counts",
    "corrupt_records",
    "current_documents",
    "known_articles",
    "load_stores",
    "lookup_analytics",
    "lookup_document",
    "merge_months",
    "month_totals",
    "open_tables",
    "open_updated",
    "pageview_files",
    "pageview_quality",
    "preview",
    "rankings",
    "replace_years",
    "sample_document",
    "top_article_of_day",
    "top_article_of_month",
    "top_article_of_year",
    "top_articles_by_day",
    "top_articles_by_month",
    "top_articles_by_year",
    "top_of_month",
    "top_of_months",
    "top_of_year",
    "top_of_years",
    "unique_articles",
    "viewed_keys",
    "winners_of_arrivals",
]
