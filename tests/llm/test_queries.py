"""The registered corpus queries against DuckDB, and the pipeline against plain versions."""

import os
import zlib

import brute
import duckdb
import numpy as np
import pytest
from test_packing import check

import __spark_entry__ as contract
import corpus_pipeline
from textlake.llm.oracle import ORACLE_SQL
from textlake.llm.queries import QUERIES

TABLES = "documents pages benchmark conversations embeddings".split()


def values(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(str([row[k] for k in order]) for row in rows)


@pytest.mark.parametrize("sf", os.environ.get("ORACLE_SF", "sf0.001,sf0.01").split(","))
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/{sf}/{t}.parquet'")
    ours = QUERIES[name](spark, f"/root/testdata/{sf}")
    cursor = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(ours.columns) == sorted(columns)
    assert values(ours.collect(), ours.columns) == values(cursor.fetchall(), columns)


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


def test_held_out_rows(spark):
    rows = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.lang_pred in {"en", "de", "fr", "es"} and 0 <= r.score <= 1 for r in rows)


def test_near_fingerprints_of_query_rows(spark):
    rows = QUERIES["op10_fingerprints"](spark, "/root/testdata/sf0.01").collect()
    for r in rows:
        if r.doc_id % 100:
            assert r.n_near is None
        else:
            x = int(r.fingerprint, 16)
            assert r.n_near == sum(bin(x ^ int(o.fingerprint, 16)).count("1") <= 4 for o in rows) - 1


def test_pipeline_stages(spark, documents):
    """Each stage on what the last one kept, with rows that it must judge."""
    sf = "/root/testdata/sf0.001"
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    extra = documents((9001, "1234 !!", "en", "x"), (9002, None, "en", "x"), (9003, f"before {item} after", "en", "x"), (9004, 'token = "Zq81aLm2Xc77"', "en", "x"), (9004, 'token = "Zq81aLm2Xc77"', "en", "x"))
    docs = docs.select(*columns).unionByName(extra)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "near-dedup", "decontamination", "secrets", "packing"]
    stages = [f for _, f in corpus_pipeline.STAGES]
    known = stages[0](spark, docs, sf)
    assert known.columns == columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in known.collect()} == {9001, 9002}
    once = stages[1](spark, known, sf)
    texts = {r.doc_id: r.text for r in known.collect()}
    kept = {i for i, (_, c) in brute.near_duplicates(texts).items() if i == c}
    rows = once.collect()
    assert once.columns == columns and sorted(r.doc_id for r in rows) == sorted(kept)
    clean = stages[2](spark, once, sf)
    items = [brute.shingle_set(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    fine = {r.doc_id for r in rows if not any(100 * len(s & brute.shingle_set(r.text)) >= 75 * len(s) for s in items)}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == fine and 9003 not in fine
    masked = stages[3](spark, clean, sf)
    after = {r.doc_id: r for r in masked.collect()}
    assert masked.columns == columns and set(after) == fine and after[9004].text == 'token = "[SECRET]"'
    assert all(r.n_chars == len(r.text) for r in after.values())
    pieces = stages[4](spark, masked, sf).collect()
    check([(i, r.text) for i, r in after.items()], pieces)


def test_stages_keep_columns_of_any_name(spark, documents):
    """Columns that operators use, a name with a dot, and no rows at all."""
    sf = "/root/testdata/sf0.001"
    names = ["score", "spans", "lang_pred", "at", "row", "number", "place", "count", "a.b", "kept", "clean", "cuts"]
    text = "the house on the hill is old and the road to it is long"
    rows = documents(*[(i, f"{text} word{i} and that is all there is to say of number {i}", "en", "s") for i in (1, 1, 2, 2, 3)], (4, "der alte Mann ging am Abend noch in das Dorf hinunter", "de", "s"))
    docs = rows.select("*", *[(rows.doc_id * 100 + k).alias(c) for k, c in enumerate(names)])
    for docs in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            for frame in (docs, docs.where("false")):
                out = stage(spark, frame, sf)
                assert out.schema.names == frame.schema.names and out.schema.simpleString() == frame.schema.simpleString()
                for r in out.collect():
                    assert [r[c] for c in names] == [r["doc_id"] * 100 + k for k in range(len(names))]
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()


def test_languages_stage_keeps_mixed_texts(spark, documents):
    """A third of each of three learned languages."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang in ('en', 'de', 'fr')").groupBy("lang").agg({"text": "max"}).collect()
    assert len(rows) == 3
    mixed = " ".join(r[1][:400] for r in rows) * 3
    out = corpus_pipeline.language_stage(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").unionByName(documents((77777, mixed), (77778, "12 ... 3"), (77779, ""))), "/root/testdata/sf0.001")
    assert {r.doc_id for r in out.where("doc_id >= 77777").collect()} == {77777}


def test_near_dedup_stage_with_repeated_ids(spark, documents):
    """Each row of an id is judged by itself; equal rows and near copies go, other texts stay."""
    words = [f"w{i}" for i in range(60)]
    a, near, b, c = " ".join(words), " ".join([*words[:59], "x"]), " ".join(words[::-1]), " ".join(words[::7] * 3)
    rows = [(1, a), (1, b), (1, a), (2, near), (0, c), (5, c), (5, c), (7, "  "), (7, "  "), (None, a), (None, a), (9, None), (9, b)]
    out = corpus_pipeline.near_dedup_stage(spark, documents(*rows).repartition(3), "").collect()
    got = sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in out)
    assert got == sorted([(1, a), (1, b), (0, c), (7, "  "), (7, "  "), (-1, a), (-1, a), (9, "")])


def test_stages_on_long_texts(spark, documents):
    """Texts above the bytes that are handled at once pass whole."""
    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    rnd = np.random.default_rng(1)
    plain = " ".join(f"word{x} of the" for x in rnd.integers(0, 10**6, 90_000))
    other = " ".join(f"note{x} on the" for x in rnd.integers(0, 10**6, 90_000))
    assert min(len(plain), len(other)) > 1 << 20
    docs = documents((1, plain, "en", "s"), (2, plain[:-200], "en", "s"), (3, f"{other} {item}", "en", "s"), (4, f'{other} token = "Zq81aLm2Xc77"', "en", "s"))
    kept = corpus_pipeline.language_stage(spark, docs, sf)
    assert kept.count() == 4
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, kept, sf).collect()) == [1, 3]
    assert sorted(r.doc_id for r in corpus_pipeline.decontamination_stage(spark, kept, sf).collect()) == [1, 2, 4]
    masked = {r.doc_id: r.text for r in corpus_pipeline.secrets_stage(spark, kept, sf).collect()}
    assert masked[4] == f'{other} token = "[SECRET]"' and masked[1] == plain
    pieces = corpus_pipeline.packing_stage(spark, docs.where("doc_id = 1"), sf).collect()
    check([(1, plain)], pieces)


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    lengths = np.array([r.length for r in rows])
    assert len(rows) > 100 and lengths.min() > 0 and corpus_pipeline.ORACLE_SQL is None
