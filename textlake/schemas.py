"""Column layouts of the logical tables, as explicit Spark schemas.

Reading with a schema avoids the extra pass that inference takes, and keeps the
types from depending on whether a corrupt row happens to be in the input.
"""

from pyspark.sql import types as T

KEY = "article_name"
CORRUPT = "_corrupt_record"

# `views` stays text until the corrupt-row filter has run.
PAGEVIEWS = T.StructType([
    T.StructField("article", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("views", T.StringType()),
    T.StructField("rank", T.IntegerType()),
])

ARTICLES = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("description", T.StringType()),
])

RANKINGS = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("popularity_bucket", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("rank", T.IntegerType()),
])

# The SQL column types of the two relational tables.
RANKINGS_SQL = {
    KEY: "TEXT",
    "views": "BIGINT",
    "popularity_bucket": "TEXT",
    "date": "DATE",
    "rank": "INT",
}
ANALYTICS_SQL = {
    KEY: "TEXT",
    "avg_views": "FLOAT",
    "max_views": "FLOAT",
    "best_rank": "INT",
    "total_days_ranked": "INT",
}

ANALYTICS = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("avg_views", T.DoubleType()),
    T.StructField("max_views", T.LongType()),
    T.StructField("best_rank", T.IntegerType()),
    T.StructField("total_days_ranked", T.LongType()),
])

# `days` has a bit for each day of the month, the first day's lowest.
MONTHS = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("total_views", T.DecimalType(38, 0)),
    T.StructField("n_views", T.LongType()),
    T.StructField("max_views", T.LongType()),
    T.StructField("best_rank", T.IntegerType()),
    T.StructField("days", T.IntegerType()),
])

DOCUMENTS = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("part", T.LongType()),
    T.StructField("date", T.ArrayType(T.DateType())),
    T.StructField("views", T.ArrayType(T.LongType())),
    T.StructField("rank", T.ArrayType(T.IntegerType())),
    T.StructField("description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("abstract", T.StringType()),
])
