"""Build the tables from raw files.

    python -m textlake views.csv corpus/ warehouse/ --mode overwrite
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession

from textlake.plans import build_tables


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="textlake", description="Build the three tables.")
    parser.add_argument("pageviews", help="CSV file or folder")
    parser.add_argument("articles", help="JSON lines (or JSON) file or folder")
    parser.add_argument("target", help="folder of the tables")
    parser.add_argument("--mode", default="append", choices=["append", "overwrite"])
    parser.add_argument("--articles-filetype", default="jsonl", choices=["json", "jsonl"])
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("textlake").getOrCreate()
    report = build_tables(
        spark, args.pageviews, args.articles, args.target, args.mode, args.articles_filetype)
    print(json.dumps(dataclasses.asdict(report), indent=2))


if __name__ == "__main__":
    main()
