"""Every registered query against DuckDB on the same tables."""

import datetime
import glob
import math
import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SCALES = os.environ.get("ORACLE_SF", "sf0.001,sf0.01").split(",")


def _value(v):
    if isinstance(v, float):
        return ("f", "nan") if math.isnan(v) else ("f", v)
    if isinstance(v, datetime.date):
        return ("d", v.isoformat())
    if v is None:
        return ("n",)
    return (type(v).__name__, v)


def multiset(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def databases():
    made = {}
    for sf in SCALES:
        con = duckdb.connect()
        for path in glob.glob(f"/root/testdata/{sf}/*.parquet"):
            name = os.path.basename(path).removesuffix(".parquet")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
        made[sf] = con
    return made


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("sf", SCALES)
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, databases, name, sf):
    ours = QUERIES[name](spark, f"/root/testdata/{sf}")
    ours_rows = multiset(ours.collect(), ours.columns)
    cursor = databases[sf].execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    oracle_rows = multiset(cursor.fetchall(), columns)
    assert sorted(ours.columns) == sorted(columns)
    assert oracle_rows, "the oracle is empty"
    assert ours_rows == oracle_rows


def test_entry(spark):
    assert contract.entry(spark).count() == 62


def test_corpus_queries_are_optional():
    """Without the corpus package, or a library that only it needs, the others are registered."""
    code = """
import sys, warnings
warnings.simplefilter("ignore")
sys.modules[sys.argv[1]] = None
import __spark_entry__ as contract
names = set(contract.queries())
assert names == set(contract.oracle_sql()) and "analytics" in names and not any(n.startswith("op") for n in names), names
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for missing in ("textlake.llm", "corpus_pipeline", "public_tokenizers"):
        subprocess.run([sys.executable, "-c", code, missing], cwd=root, check=True, timeout=300)
