"""The stored tables kept up to date: corpus files and loads of pageviews as they come.

Where `build_tables` reads everything, these cost what a file or a load costs: winners
of a corpus file are kept beside those of earlier ones, pageviews are appended to
rankings and to the roll-up by month, documents get new versions of their changed parts.
Only the statistics are written anew, from the roll-up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textlake.operators import keep_matching
from textlake.operators.histories import MAX_ENTRIES
from textlake.plans.arrivals import add_arrival, winners_of_arrivals
from textlake.plans.growing import append_documents, current_documents
from textlake.plans.months import analytics_of_months, month_totals
from textlake.plans.tables import ARTICLE_ORDER, clean_articles, clean_pageviews, rankings, viewed_keys
from textlake.schemas import ANALYTICS, ARTICLES, KEY, MONTHS
from textlake.sinks import REPLACE_YEARS, write_analytics, write_months, write_rankings
from textlake.sources import read_articles, read_pageviews, read_table
from textlake.workspace import folders, land, temporary

_RULE = ([KEY], "url", "first", ARTICLE_ORDER)
_WINNER = ", ".join(f"{name} string" for name in ("name", "description", "url", "abstract", KEY))


def _path(target: str, name: str) -> str:
    return f"{target.rstrip('/')}/{name}"


def add_corpus_file(spark: SparkSession, articles_path: str, target: str, arrival: str, articles_filetype: str = "jsonl", **options) -> None:
    """Keep the first article of each key of a corpus file (or folder), named `arrival`.

    A file may come again under its name, which replaces what it left the first time.
    Articles that nobody has viewed yet are kept too.
    """
    articles = clean_articles(read_articles(spark, articles_path, articles_filetype, **options))
    add_arrival(articles, _path(target, "corpus_winners"), arrival, *_RULE)


def known_articles(spark: SparkSession, target: str) -> DataFrame:
    """One article per key of all corpus files that have come."""
    path = _path(target, "corpus_winners")
    if not folders(spark, path):
        return spark.createDataFrame([], _WINNER)
    return winners_of_arrivals(spark, path, *_RULE)


def add_pageviews(spark: SparkSession, pageviews_path: str, target: str, max_entries: int = MAX_ENTRIES, **options) -> None:
    """Add a load of pageviews to the tables below `target`.

    The texts of a document's parts are those known when the part is written. A load that
    comes again adds its rows again: correct a year with `replace_years`.
    """
    with temporary(spark):
        pageviews = land(clean_pageviews(read_pageviews(spark, pageviews_path, **options)), "pageviews")
        articles = land(keep_matching(known_articles(spark, target), viewed_keys(pageviews), [KEY]), "articles")
        write_rankings(rankings(pageviews), _path(target, "article_rankings"), landed=True)
        write_months(month_totals(pageviews), _path(target, "article_months"))
        append_documents(spark, _path(target, "article_documents"), pageviews, articles, max_entries)
        _write_statistics(spark, target)


def replace_years(spark: SparkSession, pageviews_path: str, target: str, **options) -> None:
    """Give all pageviews of some years, which take the place of what is stored of these years.

    Rankings, the roll-up and the statistics are corrected; running it twice is running it once.
    Documents keep the entries they have: build them anew where they must follow.
    """
    with temporary(spark):
        pageviews = land(clean_pageviews(read_pageviews(spark, pageviews_path, **options)), "pageviews")
        write_rankings(rankings(pageviews), _path(target, "article_rankings"), REPLACE_YEARS, landed=True)
        write_months(month_totals(pageviews), _path(target, "article_months"), REPLACE_YEARS)
        _write_statistics(spark, target)


def _write_statistics(spark: SparkSession, target: str) -> None:
    months = read_table(spark, _path(target, "article_months"), MONTHS)
    write_analytics(analytics_of_months(months), _path(target, "article_analytics"), "overwrite")


def open_updated(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The tables below `target` by name, also as temporary views for SQL text."""
    tables = {
        "article_rankings": read_table(spark, _path(target, "article_rankings")),
        "article_months": read_table(spark, _path(target, "article_months"), MONTHS),
        "article_analytics": read_table(spark, _path(target, "article_analytics"), ANALYTICS),
        "article_documents": current_documents(spark, _path(target, "article_documents")),
    }
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables
