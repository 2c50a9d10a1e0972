"""The same queries as DuckDB SQL over the test tables."""

from __future__ import annotations

from checks.queries import SEED, SPLIT_AT
from textlake.operators.histories import MAX_ENTRIES

KEY_SQL = "trim(translate(translate(lower({0}), '_', ' '), ':,.!?\"''()[]{{}}\\/ -', ''))"

VIEWS = rf"""
WITH pv_raw AS (
  SELECT article, dt AS date,
         CASE WHEN bad > 0 THEN 'n/a' ELSE CAST(v AS VARCHAR) END AS views,
         CAST(ROW_NUMBER() OVER (PARTITION BY dt ORDER BY v DESC, article) AS INT) AS rank
  FROM (SELECT replace(upper(p_name), ' ', '_') AS article,
               CAST(l_shipdate AS DATE) AS dt,
               CAST(SUM(l_quantity * 1000) AS BIGINT) AS v,
               SUM(CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END) AS bad
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) g),
pageviews AS (
  SELECT article, CAST(views AS BIGINT) AS views, date, rank,
         {KEY_SQL.format("article")} AS article_name
  FROM pv_raw WHERE regexp_matches(views, '^[0-9]+$')),
art_raw AS (
  SELECT p_partkey AS id,
         CASE p_partkey % 3 WHEN 0 THEN concat(upper(title), '!')
                            WHEN 1 THEN concat('"', title, '"')
                            ELSE replace(title, ' ', ' - ') END AS name,
         p_type AS description,
         concat('https://example.org/part/', CAST(p_partkey AS VARCHAR)) AS url,
         p_brand AS abstract
  FROM (SELECT *, CASE WHEN p_name LIKE 'hot %' THEN 'never ' || p_name ELSE p_name END AS title FROM part) t),
art AS (SELECT *, {KEY_SQL.format("name")} AS article_name FROM art_raw),
articles AS (
  SELECT article_name, name, description, url, abstract, id
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY article_name ORDER BY id) AS rn FROM art) z
  WHERE rn = 1),
by_url AS (
  SELECT article_name, name, description, url, abstract
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY article_name ORDER BY url, name, description, abstract) AS rn
        FROM art) z
  WHERE rn = 1),
articles_last AS (
  SELECT article_name, name, description, url, abstract, id
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY article_name ORDER BY id DESC) AS rn FROM art) z
  WHERE rn = 1),
ranked AS (
  SELECT article_name, views,
         CASE WHEN views < 10000 THEN 'low' WHEN views < 100000 THEN 'medium' ELSE 'high' END
           AS popularity_bucket,
         date, rank
  FROM pageviews),
analytics AS (
  SELECT article_name, AVG(views) AS avg_views, MAX(views) AS max_views,
         MIN(rank) AS best_rank, COUNT(DISTINCT date) AS total_days_ranked
  FROM pageviews GROUP BY 1)
"""

ORDER_VIEWS = rf"""
WITH pv_raw AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_orderstatus = 'F' THEN upper(c_name)
              WHEN o_orderstatus = 'O' THEN replace(c_name, '#', '_#_')
              ELSE c_name END AS article,
         CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_totalprice > 490000 THEN 'n/a'
              ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS views,
         CAST(substr(o_orderpriority, 1, 1) AS INT) AS rank
  FROM orders JOIN customer ON o_custkey = c_custkey),
pageviews AS (
  SELECT article, CAST(views AS BIGINT) AS views, date, rank,
         {KEY_SQL.format("article")} AS article_name
  FROM pv_raw WHERE regexp_matches(views, '^[0-9]+$')),
named AS (
  SELECT *, CASE WHEN c_custkey % 50 = 0 THEN NULL
                 WHEN c_mktsegment = 'MACHINERY' THEN 'former ' || c_name ELSE c_name END AS title
  FROM customer),
art_raw AS (
  SELECT title AS name, c_mktsegment AS description,
         concat('https://example.org/customer/', CAST(c_custkey AS VARCHAR), '/b') AS url,
         CAST(c_nationkey AS VARCHAR) AS abstract
  FROM named
  UNION ALL
  SELECT upper(title) || '!', c_mktsegment,
         concat('https://example.org/customer/', CAST(c_custkey AS VARCHAR), '/a'),
         CAST(c_nationkey AS VARCHAR)
  FROM named),
art AS (SELECT *, {KEY_SQL.format("name")} AS article_name FROM art_raw),
articles AS (
  SELECT article_name, name, description, url, abstract
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY article_name ORDER BY url, name) AS rn
        FROM art) z
  WHERE rn = 1)
"""


HISTORY_ORDER = "date NULLS FIRST, rank NULLS FIRST, views NULLS FIRST"


def _history(entries: int) -> str:
    """article_name, part and the three arrays as text."""
    column = "string_agg(CAST({0} AS VARCHAR), ',' ORDER BY " + HISTORY_ORDER + ") AS {1}"
    lists = ", ".join(
        column.format(c, name)
        for c, name in (("date", "dates"), ("views", "views"), ("rank", "ranks")))
    return f"""
(SELECT article_name, part, {lists}
 FROM (SELECT *, (ROW_NUMBER() OVER (PARTITION BY article_name ORDER BY {HISTORY_ORDER}) - 1)
                 // {entries} AS part FROM pageviews) numbered
 GROUP BY article_name, part)"""


def _document(entries: int = MAX_ENTRIES) -> str:
    return f"""
SELECT h.article_name, h.part, h.dates, h.views, h.ranks, a.description, a.url, a.abstract
FROM {_history(entries)} h LEFT JOIN articles a ON h.article_name = a.article_name"""


DOCUMENT = _document()

DRAWN = f"""
(SELECT article_name FROM (SELECT DISTINCT article_name FROM pageviews) k
 ORDER BY md5(concat_ws(':', '{SEED}', coalesce(article_name, ''))), article_name LIMIT 1)"""


YEAR_OF, MONTH_OF = "CAST(EXTRACT(YEAR FROM date) AS INT)", "CAST(EXTRACT(MONTH FROM date) AS INT)"


def _top_by(periods: dict[str, str], source: str = "ranked", where: str = "", huge: bool = False) -> str:
    """The most viewed article of each period."""
    views = "CAST(9223372036854775807 AS HUGEINT) - rank" if huge else "views"
    named, names = ", ".join(f"{sql} AS {name}" for name, sql in periods.items()), ", ".join(periods)
    return f"""
SELECT {names}, article_name, CAST(n AS {"VARCHAR" if huge else "BIGINT"}) AS total_views
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {names} ORDER BY n DESC, article_name) AS rn
      FROM (SELECT {named}, article_name, SUM({views}) AS n FROM {source} {where} GROUP BY {names}, article_name) t
      WHERE n IS NOT NULL) u
WHERE rn = 1"""


EVERY_MONTH, EVERY_YEAR = {"year": YEAR_OF, "month": MONTH_OF}, {"year": YEAR_OF}
ONE_MONTH, ONE_YEAR = "WHERE date BETWEEN DATE '1997-09-01' AND DATE '1997-09-30'", "WHERE date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"

TOP_YEAR = """
SELECT 1997 AS year, article_name, CAST(SUM(views) AS BIGINT) AS total_views
FROM ranked WHERE date >= DATE '1997-01-01' AND date < DATE '1998-01-01'
GROUP BY article_name ORDER BY total_views DESC, article_name LIMIT 1"""

QUALITY = """
SELECT (SELECT COUNT(*) FROM pv_raw) AS raw_rows, COUNT(*) AS kept_rows,
       (SELECT COUNT(*) FROM pv_raw WHERE NOT regexp_matches(views, '^[0-9]+$')) AS corrupt_rows,
       COUNT(*) FILTER (views IS NULL) AS overflow_rows, 0 AS bad_date_rows, 0 AS bad_rank_rows,
       COUNT(*) FILTER (article_name = '') AS empty_key_rows,
       COUNT(DISTINCT article) AS distinct_titles,
       COUNT(DISTINCT article_name) AS distinct_keys
FROM pageviews"""

def _all_rows(articles: str) -> str:
    """The rows of the three tables that a build makes."""
    said = "concat_ws('|', {0})".format
    parts = {
        "article_rankings": (["views", "CASE WHEN views < 10000 THEN 'low' WHEN views < 100000 THEN 'medium' ELSE 'high' END", "date", "rank"], "pageviews"),
        "article_analytics": (["CAST(ROUND(AVG(views), 3) AS DECIMAL(30,3))", "MAX(views)", "MIN(rank)", "COUNT(DISTINCT date)"], "pageviews GROUP BY article_name"),
        "article_documents": (["h.part", "h.dates", "h.views", "h.ranks", "a.description", "a.url", "a.abstract"],
                              f"{_history(MAX_ENTRIES)} h LEFT JOIN {articles} a ON h.article_name = a.article_name"),
    }
    selects = []
    for name, (columns, source) in parts.items():
        key = "h.article_name" if name == "article_documents" else "article_name"
        listed = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
        selects.append(f"SELECT '{name}' AS table_name, {key} AS article_name, {said(listed)} AS said FROM {source}")
    return " UNION ALL ".join(selects)


SELECTS = {
    "scan_csv": "SELECT article, date, views, rank FROM pv_raw",
    "scan_csv_inferred": "SELECT article, date, views, rank FROM pv_raw",
    "scan_jsonl": "SELECT id, name, description, url, abstract FROM art_raw",
    "scan_jsonl_inferred": "SELECT id, name, description, url, abstract FROM art_raw",
    "scan_json": "SELECT id, name, description, url, abstract FROM art_raw",
    "standardise": "SELECT article, views, date, rank, article_name FROM pageviews",
    "standardise_texts":
        f"SELECT doc_id, {KEY_SQL.format('text')} AS text_key FROM documents",
    "row_count_drop": """
SELECT (SELECT COUNT(*) FROM pv_raw) AS raw_rows, (SELECT COUNT(*) FROM pageviews) AS kept_rows""",
    "distinct_count": "SELECT COUNT(DISTINCT article_name) AS n FROM pageviews",
    "bucket": "SELECT popularity_bucket, COUNT(*) AS n FROM ranked GROUP BY 1",
    "rankings": "SELECT article_name, views, popularity_bucket, date, rank FROM ranked",
    "add_column": """
SELECT article_name, date, views * 2 AS doubled, rank + 1 AS next_rank, 'x' AS const,
       CAST(NULL AS VARCHAR) AS empty
FROM pageviews""",
    "preview": "SELECT article_name, views, date, rank FROM pageviews ORDER BY date, rank LIMIT 5",
    "dedup_first": "SELECT article_name, name, description, url, abstract, id FROM articles",
    "dedup_last": "SELECT article_name, name, description, url, abstract, id FROM articles_last",
    "dedup_any": "SELECT DISTINCT article_name FROM art",
    "dedup_counts": """
SELECT (SELECT COUNT(*) FROM art) AS before_rows, (SELECT COUNT(*) FROM articles) AS after_rows""",
    "dedup_texts": f"""
SELECT doc_id, lang, source, n_chars
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEY_SQL.format("text")} ORDER BY doc_id) AS rn
      FROM documents) t
WHERE rn = 1""",
    "join_left": """
SELECT p.article_name, p.article, p.views, p.date, p.rank, a.name, a.description, a.url, a.abstract
FROM pageviews p LEFT JOIN articles a ON p.article_name = a.article_name""",
    "join_inner": """
SELECT p.article_name, p.views, p.date, p.rank, a.url
FROM pageviews p JOIN articles a ON p.article_name = a.article_name""",
    "join_right": """
SELECT a.article_name, p.views, p.date, p.rank, a.url
FROM pageviews p RIGHT JOIN articles a ON p.article_name = a.article_name""",
    "join_full": """
SELECT coalesce(p.article_name, a.article_name) AS article_name, p.views, p.date, p.rank, a.url
FROM pageviews p FULL JOIN articles a ON p.article_name = a.article_name""",
    "join_semi": """
SELECT article_name, views, date, rank FROM pageviews p
WHERE EXISTS (SELECT 1 FROM articles a WHERE a.article_name = p.article_name)""",
    "join_anti": """
SELECT article_name, views, date, rank FROM pageviews p
WHERE NOT EXISTS (SELECT 1 FROM articles a WHERE a.article_name = p.article_name)""",
    "analytics": """
SELECT article_name, avg_views, max_views, best_rank, total_days_ranked FROM analytics""",
    "documents": DOCUMENT,
    "documents_split": _document(SPLIT_AT),
    "sample_split": f"{_document(SPLIT_AT)} WHERE h.article_name = {DRAWN}",
    "lookup_split": f"{_document(SPLIT_AT)} WHERE h.article_name = 'smallring'",
    "lookup_document": f"{DOCUMENT} WHERE h.article_name = 'smallring'",
    "sample_document": f"{DOCUMENT} WHERE h.article_name = {DRAWN}",
    "lookup_analytics": """
SELECT article_name, avg_views, max_views, best_rank, total_days_ranked AS total_days_tracked
FROM analytics WHERE article_name = 'smallring'""",
    "top_day": """
SELECT article_name, views, rank FROM ranked WHERE date = DATE '1997-09-21' AND rank = 1""",
    "top_month": """
SELECT 1997 AS year, 9 AS month, article_name, CAST(SUM(views) AS BIGINT) AS total_views
FROM ranked WHERE date >= DATE '1997-09-01' AND date < DATE '1997-10-01'
GROUP BY article_name ORDER BY total_views DESC, article_name LIMIT 1""",
    "top_year": TOP_YEAR,
    "top_year_sql": TOP_YEAR,
    "top_every_day": "SELECT date, article_name, views, rank FROM ranked WHERE rank = 1",
    "top_every_month": _top_by(EVERY_MONTH),
    "top_every_year": _top_by(EVERY_YEAR),
    "huge_top_month": _top_by(EVERY_MONTH, where=ONE_MONTH, huge=True),
    "huge_top_year": _top_by(EVERY_YEAR, where=ONE_YEAR, huge=True),
    "huge_top_every_month": _top_by(EVERY_MONTH, huge=True),
    "huge_top_every_year": _top_by(EVERY_YEAR, huge=True),
    "stored_top_day": """
SELECT article_name, views, rank FROM ranked WHERE date = DATE '1997-09-21' AND rank = 1""",
    "stored_top_month": _top_by(EVERY_MONTH, where=ONE_MONTH),
    "stored_top_year": TOP_YEAR,
    "stored_lookup_analytics": """
SELECT article_name, avg_views, max_views, best_rank, total_days_ranked AS total_days_tracked
FROM analytics WHERE article_name = 'smallring'""",
    "write_rankings": "SELECT article_name, views, popularity_bucket, date, rank FROM ranked",
    "write_analytics": """
SELECT article_name, avg_views, max_views, best_rank, total_days_ranked FROM analytics""",
    "write_documents": """
SELECT p.article_name, COUNT(*) AS n_days, CAST(SUM(p.views) AS BIGINT) AS total_views,
       min(a.url) AS url
FROM pageviews p LEFT JOIN articles a ON p.article_name = a.article_name GROUP BY 1""",
    "end_to_end": _all_rows("by_url"),
    "months_analytics": """
SELECT article_name, avg_views, max_views, best_rank, total_days_ranked FROM analytics""",
    "months_lookup_analytics": """
SELECT article_name, avg_views, max_views, best_rank, total_days_ranked AS total_days_tracked
FROM analytics WHERE article_name = 'smallring'""",
    "months_top_month": _top_by(EVERY_MONTH, where=ONE_MONTH),
    "months_top_year": TOP_YEAR,
    "huge_months_top_month": _top_by(EVERY_MONTH, where=ONE_MONTH, huge=True),
    "huge_months_top_every_month": _top_by(EVERY_MONTH, huge=True),
    "huge_months_top_every_year": _top_by(EVERY_YEAR, huge=True),
    "grown_documents": _document(SPLIT_AT),
    "grown_lookup": f"{_document(SPLIT_AT)} WHERE h.article_name = 'smallring'",
    "reloaded_rankings": "SELECT article_name, views, popularity_bucket, date, rank FROM ranked",
}

RANKED = """
SELECT article_name, views, CASE WHEN views < 10000 THEN 'low' WHEN views < 100000 THEN 'medium' ELSE 'high' END AS popularity_bucket,
       date, rank
FROM pageviews"""
ANALYTICS_OF = """
SELECT article_name, AVG(views) AS avg_views, MAX(views) AS max_views, MIN(rank) AS best_rank,
       COUNT(DISTINCT date) AS total_days_ranked
FROM pageviews GROUP BY 1"""

ORDER_SELECTS = {
    "orders_quality": QUALITY,
    "orders_analytics": ANALYTICS_OF,
    "orders_dedup": "SELECT article_name, name, description, url, abstract FROM articles",
    "orders_join_left": """
SELECT p.article_name, p.views, p.date, p.rank, a.name, a.url
FROM pageviews p LEFT JOIN articles a ON p.article_name = a.article_name""",
    "orders_join_inner": """
SELECT p.article_name, p.views, p.date, p.rank, a.name, a.url
FROM pageviews p JOIN art a ON p.article_name = a.article_name""",
    "orders_join_right": """
SELECT a.article_name, p.views, p.date, p.rank, a.name, a.url
FROM pageviews p RIGHT JOIN art a ON p.article_name = a.article_name""",
    "orders_join_full": """
SELECT coalesce(p.article_name, a.article_name) AS article_name, p.views, p.date, p.rank,
       a.name, a.url
FROM pageviews p FULL JOIN art a ON p.article_name = a.article_name""",
    "orders_join_semi": """
SELECT article_name, views, date, rank FROM pageviews p
WHERE EXISTS (SELECT 1 FROM art a WHERE a.article_name = p.article_name)""",
    "orders_join_anti": """
SELECT article_name, views, date, rank FROM pageviews p
WHERE NOT EXISTS (SELECT 1 FROM art a WHERE a.article_name = p.article_name)""",
    "orders_rankings": RANKED,
    "orders_write_rankings": RANKED,
    "orders_write_analytics": ANALYTICS_OF,
    "orders_write_documents": DOCUMENT,
    "orders_documents": DOCUMENT,
    "orders_top_every_month": _top_by(EVERY_MONTH, "pageviews"),
    "orders_top_every_year": _top_by(EVERY_YEAR, "pageviews"),
    "arrivals_orders_dedup": "SELECT article_name, name, description, url, abstract FROM articles",
    "orders_grown_documents": DOCUMENT,
    "orders_months_analytics": ANALYTICS_OF,
    "orders_reloaded_analytics": ANALYTICS_OF,
    "orders_reloaded_rankings": RANKED,
    "orders_months_top_every_month": _top_by(EVERY_MONTH, "pageviews"),
    "orders_months_top_every_year": _top_by(EVERY_YEAR, "pageviews"),
    "months_merged": f"""
SELECT article_name, {YEAR_OF} AS year, {MONTH_OF} AS month, CAST(SUM(views) AS BIGINT) AS total_views,
       COUNT(views) AS n_views, MAX(views) AS max_views, MIN(rank) AS best_rank, COUNT(DISTINCT date) AS n_days
FROM pageviews GROUP BY 1, 2, 3""",
    "orders_top_every_day": """
SELECT date, article_name, rank
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY article_name NULLS FIRST) AS rn
      FROM pageviews WHERE rank = 1) t
WHERE rn = 1""",
}

# Files with faults: text that is typed again when it is read
DIRTY = rf"""{ORDER_VIEWS.split("pageviews AS (")[0].replace("SELECT CASE", "SELECT o_orderkey, CASE", 1)}
dirty AS (
  SELECT CASE WHEN o_orderkey % 73 = 0 THEN '?!' ELSE article END AS article,
         CASE WHEN o_orderkey % 79 = 0 THEN '99999999999999999999' ELSE views END AS text_views,
         CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE date END AS date, o_orderkey % 83 = 0 AS bad_date,
         CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE rank END AS rank, o_orderkey % 89 = 0 AS bad_rank
  FROM pv_raw),
pageviews AS (
  SELECT article, TRY_CAST(text_views AS BIGINT) AS views, date, rank,
         {KEY_SQL.format("article")} AS article_name
  FROM dirty WHERE regexp_matches(text_views, '^[0-9]+$')),
named AS ({ORDER_VIEWS.split("named AS (")[1].split("art AS (")[0]}
readable AS (
  SELECT *, {KEY_SQL.format("name")} AS article_name FROM art_raw
  WHERE NOT (CAST(regexp_extract(url, '([0-9]+)/', 1) AS INT) % 37 = 0 AND ends_with(url, '/b'))),
articles AS (
  SELECT article_name, name, description, url, abstract
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY article_name ORDER BY url, name, description, abstract) AS rn
        FROM readable) z
  WHERE rn = 1)
"""

DIRTY_SELECTS = {
    "quality_report": """
SELECT (SELECT COUNT(*) FROM dirty) AS raw_rows, COUNT(*) AS kept_rows,
       (SELECT COUNT(*) FROM dirty WHERE NOT regexp_matches(text_views, '^[0-9]+$')) AS corrupt_rows,
       COUNT(*) FILTER (views IS NULL) AS overflow_rows,
       (SELECT COUNT(*) FILTER (bad_date) FROM dirty) AS bad_date_rows,
       (SELECT COUNT(*) FILTER (bad_rank) FROM dirty) AS bad_rank_rows,
       COUNT(*) FILTER (article_name = '') AS empty_key_rows,
       COUNT(DISTINCT article) AS distinct_titles,
       COUNT(DISTINCT article_name) AS distinct_keys
FROM pageviews""",
    "corpus_quality": """
SELECT (SELECT COUNT(*) FROM art_raw) AS total_rows,
       (SELECT COUNT(*) FROM art_raw) - (SELECT COUNT(*) FROM readable) AS corrupt_rows,
       (SELECT COUNT(*) FROM readable) AS before_rows, (SELECT COUNT(*) FROM articles) AS after_rows""",
    "build_report": """
SELECT (SELECT COUNT(*) FROM dirty) AS raw_pageviews, (SELECT COUNT(*) FROM pageviews) AS kept_pageviews,
       (SELECT COUNT(*) FILTER (bad_date) FROM dirty) AS bad_dates,
       (SELECT COUNT(*) FILTER (bad_rank) FROM dirty) AS bad_ranks,
       (SELECT COUNT(*) FROM pageviews WHERE views IS NULL) AS overflowed_views,
       (SELECT COUNT(*) FROM art_raw) AS raw_articles,
       (SELECT COUNT(*) FROM art_raw) - (SELECT COUNT(*) FROM readable) AS unreadable_articles,
       (SELECT COUNT(*) FROM readable WHERE article_name IN (SELECT article_name FROM pageviews)) AS viewed_articles,
       (SELECT COUNT(*) FROM articles WHERE article_name IN (SELECT article_name FROM pageviews)) AS unique_articles,
       (SELECT COUNT(*) FROM (SELECT DISTINCT article_name FROM pageviews) k) AS documents""",
    "orders_end_to_end": _all_rows("articles"),
}

SELECTS["updated_tables"] = SELECTS["end_to_end"]
SELECTS["arrivals_dedup_texts"] = SELECTS["dedup_texts"]

# Titles with quotes and commas, in files that write a quote in two ways
QUOTED = rf"""{ORDER_VIEWS.split("pageviews AS (")[0].replace("SELECT CASE", "SELECT o_orderkey, CASE", 1)}
quoted AS (
  SELECT 'The "' || coalesce(article, '?') || '", live' AS article, date, views, rank,
         o_orderkey % 2 = 0 AS recovered, o_orderkey % 61 = 0 AS lost, o_orderkey % 5 AS slot
  FROM pv_raw),
pageviews AS (
  SELECT article, CAST(views AS BIGINT) AS views, date, rank, {KEY_SQL.format("article")} AS article_name
  FROM quoted WHERE NOT lost AND regexp_matches(views, '^[0-9]+$'))
"""

QUOTED_SELECTS = {
    "recovered_rows": "SELECT article, date, views, rank, recovered FROM quoted WHERE NOT lost",
    "recovered_rankings": RANKED,
    "pageview_files": """
SELECT slot, COUNT(*) AS raw_rows, COUNT(*) FILTER (NOT lost AND regexp_matches(views, '^[0-9]+$')) AS kept_rows,
       COUNT(*) FILTER (lost OR NOT regexp_matches(views, '^[0-9]+$')) AS corrupt_rows,
       COUNT(*) FILTER (lost) AS bad_date_rows, COUNT(*) FILTER (lost) AS bad_rank_rows,
       COUNT(*) FILTER (recovered AND NOT lost) AS recovered_rows, COUNT(*) FILTER (lost) AS lost_rows
FROM quoted GROUP BY slot""",
}

DIRTY_SELECTS["article_files"] = """
SELECT CASE WHEN CAST(regexp_extract(url, '([0-9]+)/', 1) AS INT) % 37 = 0 AND ends_with(url, '/b') THEN 'unreadable' ELSE description END AS slot,
       COUNT(*) AS total_rows,
       COUNT(*) FILTER (CAST(regexp_extract(url, '([0-9]+)/', 1) AS INT) % 37 = 0 AND ends_with(url, '/b')) AS corrupt_rows
FROM art_raw GROUP BY 1"""

ORACLE_SQL = {name: VIEWS + sql for name, sql in SELECTS.items()}
ORACLE_SQL.update((name, ORDER_VIEWS + sql) for name, sql in ORDER_SELECTS.items())
ORACLE_SQL.update((name, DIRTY + sql) for name, sql in DIRTY_SELECTS.items())
ORACLE_SQL.update((name, QUOTED + sql) for name, sql in QUOTED_SELECTS.items())
