"""Times queries of the titles on inputs larger than the test tables.

    python -m checks.scale FACTOR [query ...]

The line items of sf0.1 are repeated FACTOR times, a third of them on one part, and
the parts get 50,000 titles; the tables go to a new folder of their own. Prints the
seconds of each query's second run.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks.queries import QUERIES

SOURCE = "/root/testdata/sf0.1"
TITLES = 50_000
CHOSEN = ["distinct_count", "analytics", "join_left", "documents", "write_rankings"]


def make(spark: SparkSession, folder: str, factor: int) -> None:
    parts = spark.read.parquet(f"{SOURCE}/part.parquet")
    n_parts = parts.count()
    copies = -(-TITLES // n_parts)
    parts = parts.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    parts = parts.withColumns({
        "p_partkey": F.col("p_partkey") + F.col("copy") * n_parts,
        "p_name": F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"), F.col("copy").cast("string")),
    }).drop("copy")
    parts.write.parquet(f"{folder}/part.parquet")
    items = spark.read.parquet(f"{SOURCE}/lineitem.parquet").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(factor))))
    spread = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "copy"), F.lit(n_parts * copies)) + 1
    hot = F.pmod(F.xxhash64("copy", "l_orderkey", F.col("l_quantity")), F.lit(3)) == 0
    items.withColumn("l_partkey", F.when(hot, F.lit(1)).otherwise(spread)).drop("copy").write.parquet(f"{folder}/lineitem.parquet")


def main() -> None:
    factor, chosen = int(sys.argv[1]), sys.argv[2:] or CHOSEN
    folder = tempfile.mkdtemp(prefix="scale-")
    spark = (
        SparkSession.builder.master("local[8]").appName("scale")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "16")
        .config("spark.checkpoint.dir", os.path.join(folder, "shared"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    make(spark, folder, factor)
    for name in chosen:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
        print(f"{name}: {seconds:.1f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
