"""Table writes, and the options handed to the external stores.

No database is started here: the JDBC and document-store writers are checked up
to the call that Spark would execute.
"""

import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from textlake import schemas, sinks, sources
from textlake.__main__ import main
from textlake.plans import build, build_tables, load_stores, lookup_analytics, top_article_of_month
from textlake.sinks.stores import created_types, jdbc_options, relational_rows
from textlake.workspace import fresh_path, land, shared_dir, temporary


@pytest.fixture
def ranked(spark):
    day = dt.date(2019, 12, 30)
    return spark.createDataFrame(
        [(f"t{i % 7}", i, "low", day + dt.timedelta(i // 5), i % 5 + 1) for i in range(60)],
        schemas.RANKINGS)


def test_rankings_append_and_overwrite(spark, ranked, tmp_path):
    path = str(tmp_path / "rankings")
    for mode, rows in (("append", 60), ("append", 120), ("overwrite", 60)):
        sinks.write_rankings(ranked, path, mode)
        stored = sources.read_table(spark, path)
        assert stored.count() == rows
    assert sorted(stored.select(*schemas.RANKINGS.names).collect()) == sorted(ranked.collect())
    assert {r.year for r in stored.collect()} == {2019, 2020}


def test_rankings_files_are_sorted_by_date(spark, ranked, tmp_path):
    path = str(tmp_path / "rankings")
    sinks.write_rankings(ranked.repartition(5), path)
    stored = sources.read_table(spark, path).withColumn("file", F.input_file_name()).collect()
    by_file = {}
    for r in stored:
        by_file.setdefault(r.file, []).append((r.date, r["rank"], r.article_name))
    assert all(rows == sorted(rows) for rows in by_file.values())


def test_documents_as_json_and_parquet(spark, tmp_path):
    day = dt.date(2020, 1, 1)
    documents = spark.createDataFrame(
        [("a", 0, [day], [5], [1], "d", "u", "x"), ("b", 0, [], [], [], None, None, None)],
        schemas.DOCUMENTS)
    for source in ("json", "parquet"):
        path = str(tmp_path / source)
        sinks.write_documents(documents, path, source=source)
        sinks.write_documents(documents, path, source=source)
        stored = spark.read.schema(schemas.DOCUMENTS).format(source).load(path)
        assert sorted(stored.distinct().collect()) == sorted(documents.collect())
        assert stored.count() == 4


@pytest.mark.parametrize("landed", [False, True])
def test_tables_by_key_have_a_range_of_keys_in_each_file(spark, tmp_path, landed):
    """Statistics of a file rule it out for all keys but those in its range."""
    keys = [f"key{i * 7919 % 4000:05}" for i in range(4000)]
    stats = spark.createDataFrame([(k, 1.5, 2, 1, 3) for k in keys], schemas.ANALYTICS).repartition(6)
    documents = spark.createDataFrame(
        [(k, part, [], [], [], "d" * 50, None, None) for k in keys for part in (0, 1)], schemas.DOCUMENTS).repartition(6)
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sinks.write_analytics(stats, str(tmp_path / "analytics"), landed=landed)
        sinks.write_documents(documents, str(tmp_path / "documents"), landed=landed)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    for name, n in (("analytics", 4000), ("documents", 8000)):
        files = sorted(tuple(r) for r in sources.read_table(spark, str(tmp_path / name)).groupBy(F.input_file_name()).agg(
            F.min("article_name"), F.max("article_name"), F.count("*")).drop("input_file_name()").collect())
        assert len(files) > 3 and sum(rows for *_, rows in files) == n
        assert all(last <= first for (_, last, _), (first, _, _) in zip(files, files[1:], strict=False))


def test_what_makes_the_rows_of_a_table_runs_once(spark, ranked, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        made.add(1)
        return n

    sinks.write_rankings(ranked.withColumn("views", counted("views")), str(tmp_path / "rankings"))
    assert made.value == 60


@pytest.fixture
def calls(monkeypatch):
    made = []

    def save(self, *args, **kwargs):
        made.append(self)

    monkeypatch.setattr(DataFrameWriter, "save", save)
    return made


def recorded(monkeypatch, cls):
    seen = {"format": None, "options": {}, "mode": None}
    monkeypatch.setattr(cls, "format", lambda self, f: seen.update(format=f) or self)
    monkeypatch.setattr(cls, "options", lambda self, **o: seen["options"].update(o) or self)
    if cls is DataFrameWriter:
        monkeypatch.setattr(cls, "mode", lambda self, m: seen.update(mode=m) or self)
    return seen


def test_relational_write(spark, ranked, calls, monkeypatch):
    seen = recorded(monkeypatch, DataFrameWriter)
    sinks.load_to_postgres(
        ranked, ["date", "views"], {"date": "DATE", "views": "float"},
        {"host": "db", "port": 5433, "dbname": "x", "user": "me"}, "article_rankings")
    assert len(calls) == 1 and seen["format"] == "jdbc" and seen["mode"] == "append"
    assert seen["options"] == {
        "url": "jdbc:postgresql://db:5433/x", "user": "me", "dbtable": "article_rankings",
        "batchsize": 1000, "numPartitions": 16, "truncate": True,
        "createTableColumnTypes": "`date` DATE, `views` float"}


def test_staged_rows_are_published_once(spark, ranked, monkeypatch):
    seen, staged = recorded(monkeypatch, DataFrameWriter), []
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: staged.extend(self._df.collect()))
    types = {"date": "DATE", "views": "FLOAT", "rank": "INT"}
    twice = ranked.select(*types).union(ranked.select(*types))
    statements = sinks.stage_for_postgres(twice, list(types), types, {"dbname": "x"}, "t")
    assert (seen["options"]["dbtable"], seen["mode"]) == ("t_staging", "overwrite")

    con = duckdb.connect()
    con.execute("CREATE TABLE t_staging (load_row BIGINT, date DATE, views FLOAT, rank INT)")
    rerun = staged[30:70]
    con.executemany("INSERT INTO t_staging VALUES (?, ?, ?, ?)", [list(r) for r in staged + rerun])
    for statement in statements:
        con.execute(statement)
    published = con.execute("SELECT * FROM t").fetchall()
    assert sorted(published) == sorted(map(tuple, twice.collect()))


def test_relational_rows_are_typed_and_ordered(ranked):
    got = relational_rows(ranked, ["rank", "article_name", "views"],
                          {"rank": "INT", "article_name": "TEXT", "views": "FLOAT"})
    assert got.dtypes == [("rank", "int"), ("article_name", "string"), ("views", "double")]
    types = {"rank": "NUMERIC(10,2)", "views": "varchar(20)", "date": "TIMESTAMP", "article_name": "JSONB"}
    assert relational_rows(ranked, list(types), types).dtypes == [
        ("rank", "decimal(10,2)"), ("views", "string"), ("date", "timestamp"), ("article_name", "string")]
    assert relational_rows(ranked, ["rank"], {"rank": "SMALLINT"}).dtypes == [("rank", "smallint")]


def test_jdbc_url_may_be_given():
    config = {"url": "jdbc:other:x", "driver": "d"}
    assert jdbc_options(config, "t") == {"url": "jdbc:other:x", "dbtable": "t", "driver": "d"}
    assert jdbc_options({}, "t")["url"] == "jdbc:postgresql://localhost:5432/"


def test_document_store_write(spark, ranked, calls, monkeypatch):
    seen = recorded(monkeypatch, DataFrameWriter)
    sinks.upload_to_mongo(ranked, "db", "c", "mongodb://h/", replace_on=["article_name", "part"])
    assert len(calls) == 1 and seen["format"] == "mongodb" and seen["mode"] == "append"
    assert seen["options"] == {
        "connection.uri": "mongodb://h/", "database": "db", "collection": "c",
        "maxBatchSize": 500, "operationType": "replace", "idFieldList": "article_name,part"}


def test_store_reads(spark, monkeypatch):
    seen = recorded(monkeypatch, DataFrameReader)
    monkeypatch.setattr(DataFrameReader, "load", lambda self: "loaded")
    config = {"host": "h", "dbname": "x"}
    assert sources.read_relational(spark, config, "t", "date", "2016-01-01", "2026-01-01", 10) == "loaded"
    assert seen["format"] == "jdbc"
    assert seen["options"] == {
        "url": "jdbc:postgresql://h:5432/x", "dbtable": "t", "partitionColumn": "date",
        "lowerBound": "2016-01-01", "upperBound": "2026-01-01", "numPartitions": 10}
    assert sources.read_collection(spark, "db", "c", "mongodb://h/") == "loaded"
    assert seen["format"] == "mongodb" and "aggregation.pipeline" not in seen["options"]
    sources.read_collection(spark, "db", "c", "mongodb://h/", aggregation="[]")
    assert seen["options"]["aggregation.pipeline"] == "[]"


def test_load_stores(spark, ranked, tmp_path, monkeypatch):
    stats = spark.createDataFrame([("a", 1.5, 2, 1, 3)], schemas.ANALYTICS)
    documents = spark.createDataFrame([("a", 0, [], [], [], None, None, None)], schemas.DOCUMENTS)
    paths = {n: str(tmp_path / n)
             for n in ("article_rankings", "article_analytics", "article_documents")}
    sinks.write_rankings(ranked, paths["article_rankings"])
    sinks.write_analytics(stats, paths["article_analytics"])
    sinks.write_documents(documents, paths["article_documents"])

    saved, create = [], DataFrameWriter.__init__
    seen = recorded(monkeypatch, DataFrameWriter)
    monkeypatch.setattr(DataFrameWriter, "__init__",
                        lambda self, df: (seen["options"].clear(), create(self, df))[1])
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: saved.append(
        (seen["format"], dict(seen["options"]), self._df.dtypes, self._df)))
    stored = documents.unionByName(documents.withColumn("part", F.lit(3).cast("long"))).select("article_name", "part", "url")
    asked = []
    monkeypatch.setattr(build, "read_collection", lambda *args: asked.append(args) or stored)
    load_stores(spark, paths, {"host": "h", "dbname": "x"}, "mongodb://h/", "articles", batch_size=7, max_connections=3)
    (f1, o1, t1, _), (f2, o2, t2, _), (f3, o3, t3, sent) = saved
    assert (o1["batchsize"], o1["numPartitions"], o3["maxBatchSize"]) == (7, 3, 500)
    # the store sends places only, and none of the blanks it has
    ((*_, schema, stages),) = asked
    assert schema.names == ["article_name", "part"]
    assert json.loads(stages) == [{"$match": {"date.0": {"$exists": True}}}, {"$project": {"_id": 0, "article_name": 1, "part": 1}}]
    # part 3 is in the store only: it becomes a blank
    assert sorted((r.article_name, r.part, r.date) for r in sent.collect()) == [("a", 0, []), ("a", 3, [])]
    assert (f1, o1["dbtable"], f2, o2["dbtable"]) == (
        "jdbc", "article_rankings", "jdbc", "article_analytics")
    assert t1 == [("article_name", "string"), ("views", "bigint"),
                  ("popularity_bucket", "string"), ("date", "date"), ("rank", "int")]
    assert t2 == [("article_name", "string"), ("avg_views", "double"), ("max_views", "double"),
                  ("best_rank", "int"), ("total_days_ranked", "int")]
    assert (f3, o3["idFieldList"]) == ("mongodb", "article_name,part")
    assert [name for name, _ in t3] == schemas.DOCUMENTS.names


# Workspace

def exists(spark, path):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def test_land_and_temporary(spark):
    with temporary(spark):
        path = fresh_path(spark, "kept")
        landed = land(spark.range(3), "rows")
        (folder,) = {f.rsplit("/", 1)[0] for f in landed.inputFiles()}
        assert landed.count() == 3 and exists(spark, folder)
        assert folder.removeprefix("file://").startswith(shared_dir(spark).removeprefix("file:"))
    assert not exists(spark, folder) and not exists(spark, path)
    outside = land(spark.range(2), "rows")
    assert outside.count() == 2


def test_the_shared_folder_is_the_sessions():
    class Session:
        def __init__(self, **conf):
            self.conf = conf

    warehouse = {"spark.sql.warehouse.dir": "hdfs:///warehouse"}
    assert shared_dir(Session(**warehouse)) == "hdfs:///warehouse"
    assert shared_dir(Session(**warehouse, **{"spark.checkpoint.dir": "hdfs:///scratch/"})) == "hdfs:///scratch"


# End to end

def test_build_tables(spark, tmp_path, capsys):
    (tmp_path / "views.csv").write_text(
        "rank,article,views,date\n"
        "1,Main_Page,20,2016-12-02\n2,AC/DC,oops,2016-12-02\n"
        "1,AC/DC,200000,2016-12-03\n2,main page,7,2016-12-03\n", encoding="utf-8")
    corpus = tmp_path / "corpus"
    corpus.mkdir()
    for i, name in enumerate(["Main Page", "MAIN-PAGE", "Unseen"]):
        line = json.dumps({"name": name, "url": f"u{i}", "abstract": "x", "description": "d"})
        (corpus / f"{i}.jsonl").write_text(line + "\nbroken\n", encoding="utf-8")
    target = str(tmp_path / "tables")

    before = set(child.name for child in _children(spark))
    report = build_tables(spark, str(tmp_path / "views.csv"), str(corpus), target)
    assert set(child.name for child in _children(spark)) == before
    assert (report.raw_pageviews, report.kept_pageviews, report.documents) == (4, 3, 2)
    assert (report.raw_articles, report.unreadable_articles) == (6, 3)
    assert (report.viewed_articles, report.unique_articles) == (2, 1)
    assert (report.bad_dates, report.bad_ranks, report.overflowed_views) == (0, 0, 0)

    stored = {n: sources.read_table(spark, p) for n, p in report.paths.items()}
    documents = {r.article_name: r for r in stored["article_documents"].collect()}
    assert set(documents) == {"mainpage", "acdc"}
    first = documents["mainpage"]
    assert (first.views, first["rank"], first.url) == ([20, 7], [1, 2], "u0")
    assert first.date == [dt.date(2016, 12, 2), dt.date(2016, 12, 3)]
    assert documents["acdc"].url is None
    stats = lookup_analytics(stored["article_analytics"], "Main Page").first()
    assert stats == ("mainpage", 13.5, 20, 1, 2)
    top = top_article_of_month(stored["article_rankings"], 2016, 12).first()
    assert top == (2016, 12, "acdc", 200000)

    main([str(tmp_path / "views.csv"), str(corpus), target, "--mode", "overwrite"])
    assert json.loads(capsys.readouterr().out)["kept_pageviews"] == 3
    assert sources.read_table(spark, report.paths["article_analytics"]).count() == 2
    build_tables(spark, str(tmp_path / "views.csv"), str(corpus), target)
    assert sources.read_table(spark, report.paths["article_analytics"]).count() == 4


def _children(spark):
    import pathlib
    folder = pathlib.Path(shared_dir(spark)) / "textlake" / spark.conf.get("spark.app.id")
    return list(folder.iterdir()) if folder.exists() else []


def test_a_created_table_has_the_types_that_were_asked_for(spark, monkeypatch, calls):
    columns = ["id", "name", "price", "note", "mean", "n", "when", "exact"]
    types = dict(zip(columns, ["UUID", "VARCHAR(20)", "NUMERIC(12,2)", "TEXT", "FLOAT", "SMALLINT", "TIMESTAMP", "DOUBLE PRECISION"]))
    assert created_types(columns, types) == "`name` VARCHAR(20), `price` NUMERIC(12,2), `mean` FLOAT, `n` SMALLINT, `when` TIMESTAMP"
    seen = recorded(monkeypatch, DataFrameWriter)
    rows = spark.createDataFrame([("0", "x", 1.5, "t", 2.0, 1, "2020-01-01 00:00:00", 0.5)], columns)
    sinks.load_to_postgres(rows, columns, types, {"host": "h", "dbname": "d"}, "t")
    assert seen["options"]["createTableColumnTypes"] == created_types(columns, types)
    # Spark takes them: it parses the option as a list of columns
    parsed = T.StructType.fromDDL(created_types(columns, types))
    assert [f.dataType.simpleString() for f in parsed] == ["varchar(20)", "decimal(12,2)", "float", "smallint", "timestamp"]
    # of the table's own: all but the text
    assert created_types(list(schemas.RANKINGS_SQL), schemas.RANKINGS_SQL) == "`views` BIGINT, `date` DATE, `rank` INT"
    seen["options"].clear()
    sinks.load_to_postgres(rows.select("note"), ["note"], {"note": "TEXT"}, {"host": "h", "dbname": "d"}, "t")
    assert "createTableColumnTypes" not in seen["options"]
