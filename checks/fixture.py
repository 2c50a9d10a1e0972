"""Raw pageviews and a raw article corpus, derived from the test tables.

Parts: a part name plays the title and its line items the daily views; a day's
line items of an order number divisible by 97 make that title's count unreadable.
The corpus has one record per part, so that few titles repeat often; records of the
names starting with `hot ` have another title there, which nobody views.

Orders: a customer name, written in three ways, plays the title and each order one
count of views, unreadable above a price, without a title where the order number
is divisible by 101. The corpus has two records per customer; in one market segment
they have titles that nobody views, and every 50th customer's have none. Titles grow
with the tables here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlake.operators import deduplicate_df
from textlake.plans import clean_articles, clean_pageviews, rankings
from textlake.schemas import KEY

CORPUS_COLUMNS = ("name", "description", "url", "abstract", "id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article, date, views (text, some of it corrupt), rank.

    The line items are summed per title and day before anything else sees them,
    so the ranking of a day sorts one row per title.
    """
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity",
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_orderkey") % 97 == 0).alias("bad"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.translate(F.upper("p_name"), " ", "_").alias("article"),
    )
    daily = items.join(parts, "l_partkey").groupBy("article", "date").agg(
        F.sum(F.col("l_quantity") * 1000).cast("bigint").alias("n"),
        F.bool_or("bad").alias("bad"),
    )
    in_day = Window.partitionBy("date").orderBy(F.desc("n"), "article")
    return daily.select(
        "article", "date",
        F.when(F.col("bad"), "n/a").otherwise(F.col("n").cast("string")).alias("views"),
        F.row_number().over(in_day).alias("rank"),
    )


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, description, url, abstract; one record per part."""
    name, key = F.col("title"), F.col("p_partkey")
    style = key % 3
    title = F.when(F.col("p_name").startswith("hot "), F.concat(F.lit("never "), F.col("p_name"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").withColumn("title", title).select(
        key.alias("id"),
        F.when(style == 0, F.concat(F.upper(name), F.lit("!")))
        .when(style == 1, F.concat(F.lit('"'), name, F.lit('"')))
        .otherwise(F.replace(name, F.lit(" "), F.lit(" - "))).alias("name"),
        F.col("p_type").alias("description"),
        F.concat(F.lit("https://example.org/part/"), key.cast("string")).alias("url"),
        F.col("p_brand").alias("abstract"),
    )


def pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pageviews(raw_pageviews(spark, sf_dir))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the corpus with its key."""
    return clean_articles(raw_articles(spark, sf_dir), CORPUS_COLUMNS)


def articles(spark: SparkSession, sf_dir: str, keep: str = "first") -> DataFrame:
    """The record with the smallest (or largest) id of every key."""
    kept = deduplicate_df(corpus(spark, sf_dir), [KEY], "id", keep)
    return kept.select(KEY, *CORPUS_COLUMNS)


def raw_order_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article, date, views (text, some of it corrupt), rank; one row per order."""
    return _order_rows(spark, sf_dir).drop("o_orderkey")


def dirty_order_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as text, with dates and ranks that cannot be read, counts longer than a
    long and titles of punctuation."""
    key = F.col("o_orderkey")

    def spoilt(every: int, value: str, name: str):
        return F.when(key % every == 0, value).otherwise(F.col(name).cast("string")).alias(name)

    return _order_rows(spark, sf_dir).select(
        spoilt(73, "?!", "article"), spoilt(83, "bad", "date"),
        spoilt(79, "99999999999999999999", "views"), spoilt(89, "x", "rank"),
    )


def dirty_customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer corpus as JSON lines, one record of every 37th customer cut off."""
    record = F.to_json(F.struct("name", "description", "url", "abstract"))
    broken = (F.col("id") % 37 == 0) & F.col("url").endswith("/b")
    return raw_customers(spark, sf_dir).select(
        F.when(broken, F.substring(record, 1, 12)).otherwise(record).alias("value"))


HEADER = "article,date,views,rank"


def quoted_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines (named as their header) of titles with quotes and commas, and `slot`, 0 to 4.

    Half of the titles have their quotes doubled, half behind a backslash; a line of every
    61st order has too many fields to be either.
    """
    key, rows = F.col("o_orderkey"), _order_rows(spark, sf_dir)
    quote = F.when(key % 2 == 0, '""').otherwise('\\"')
    title = F.concat(F.lit('"The '), quote, F.coalesce("article", F.lit("?")), quote, F.lit(', live"'))
    rest = F.concat_ws(",", F.col("date").cast("string"), "views", F.col("rank").cast("string"))
    line = F.when(key % 61 == 0, F.concat(F.lit("a,b,c,"), rest)).otherwise(F.concat_ws(",", title, rest))
    return rows.select(line.alias(HEADER), (key % 5).alias("slot"))


def huge_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings whose counts are so near the largest long that no two of them fit one."""
    views = F.lit(9_223_372_036_854_775_807) - F.col("rank")
    return rankings(pageviews(spark, sf_dir)).withColumn("views", views)


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    name, price = F.col("c_name"), F.col("o_totalprice")
    return orders.join(customers, "c_custkey").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 101 == 0, F.lit(None))
        .when(F.col("o_orderstatus") == "F", F.upper(name))
        .when(F.col("o_orderstatus") == "O", F.replace(name, F.lit("#"), F.lit("_#_")))
        .otherwise(name).alias("article"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(price > 490_000, "n/a")
        .otherwise(F.floor(price).cast("string")).alias("views"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rank"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, description, url, abstract; two records per customer."""
    name = F.when(F.col("c_custkey") % 50 == 0, F.lit(None)).when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("former "), F.col("c_name"))).otherwise(F.col("c_name"))
    customers = table(spark, sf_dir, "customer").withColumn("c_name", name)
    url = F.concat(F.lit("https://example.org/customer/"), F.col("c_custkey").cast("string"))
    return customers.select(
        F.col("c_custkey").alias("id"),
        F.explode(F.array(
            F.struct(F.col("c_name").alias("name"), F.concat(url, F.lit("/b")).alias("url")),
            F.struct(F.concat(F.upper("c_name"), F.lit("!")).alias("name"),
                     F.concat(url, F.lit("/a")).alias("url")),
        )).alias("record"),
        F.col("c_mktsegment").alias("description"),
        F.col("c_nationkey").cast("string").alias("abstract"),
    ).select("id", "record.name", "description", "record.url", "abstract")


def order_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_pageviews(raw_order_views(spark, sf_dir))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the customer corpus with its key."""
    return clean_articles(raw_customers(spark, sf_dir))
