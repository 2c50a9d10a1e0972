"""Scans of hand-written files."""

import datetime as dt
import json

import pytest

from textlake import schemas
from textlake.plans import article_files, clean_articles, clean_pageviews, corrupt_records, pageview_quality
from textlake.sources import ingest_data, read_articles, read_pageviews

DAY = dt.date(2016, 12, 2)

PLAIN = "rank,article,views,date\n1,Main_Page,20,2016-12-02\n3,\"\"\"Heroes\"\"\",13,2016-12-02\n"
SHIFTED = PLAIN + "2,\"\"\"Awaken,_My_Love!\"\"\",12,2016-12-02\n"


@pytest.fixture
def csv(tmp_path):
    def write(text, name="pageviews.csv"):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)
    return write


def test_inferred_types_depend_on_a_corrupt_row(spark, csv):
    types = dict(ingest_data(spark, csv(PLAIN), "csv").dtypes)
    assert (types["views"], types["date"]) == ("int", "date")
    types = dict(ingest_data(spark, csv(SHIFTED), "csv").dtypes)
    assert (types["views"], types["date"]) == ("string", "string")


def test_declared_types_do_not(spark, csv):
    for text in (PLAIN, SHIFTED):
        assert read_pageviews(spark, csv(text)).dtypes == [
            ("article", "string"), ("date", "date"), ("views", "string"), ("rank", "int")]


def test_quoted_title_with_a_comma(spark, csv):
    kept = clean_pageviews(read_pageviews(spark, csv(SHIFTED)))
    assert {r.article_name for r in kept.collect()} == {"mainpage", "heroes"}
    assert '"' in {r.article_name: r.article for r in kept.collect()}["heroes"]
    kept = clean_pageviews(read_pageviews(spark, csv(SHIFTED), escape='"')).collect()
    assert {r.article_name for r in kept} == {"mainpage", "heroes", "awakenmylove"}
    assert {r.views for r in kept} == {20, 13, 12}


def test_columns_are_found_by_name(spark, csv):
    one = csv("views,extra,date,rank,article\n5,x,2016-12-02,1,A\n")
    assert read_pageviews(spark, one).collect() == [("A", DAY, "5", 1)]


def test_a_schema_does_not_fill_wrong_columns(spark, csv):
    path = csv("rank,article\n1,A\n")
    assert ingest_data(spark, path, "csv", "rank int, article string").collect() == [(1, "A")]
    with pytest.raises(Exception, match="CSV header does not conform"):
        ingest_data(spark, path, "csv", "article string, rank int").collect()


def test_unreadable_dates_and_ranks_are_flagged(spark, csv):
    path = csv("rank,article,views,date\n1,A,5,bad\nx,B,6,2016-12-02\n,C,7,\n")
    rows = {r.article: (r.date, r["rank"], r.bad_date, r.bad_rank) for r in read_pageviews(spark, path, flags=True).collect()}
    assert rows == {"A": (None, 1, True, False), "B": (DAY, None, False, True), "C": (None, None, False, False)}
    figures = pageview_quality(read_pageviews(spark, path, flags=True)).first()
    assert (figures.kept_rows, figures.bad_date_rows, figures.bad_rank_rows) == (3, 1, 1)


def test_file_type_is_checked_and_case_insensitive(spark, csv):
    assert ingest_data(spark, csv(PLAIN), "CSV").count() == 2
    with pytest.raises(ValueError, match="parquet"):
        ingest_data(spark, "anywhere", "parquet")


def test_folder_of_files(spark, csv, tmp_path):
    csv(PLAIN, "a.csv")
    csv(PLAIN, "b.csv")
    assert read_pageviews(spark, str(tmp_path)).count() == 4


def test_files_of_a_folder_must_agree_on_their_header(spark, csv, tmp_path):
    csv(PLAIN, "a.csv")
    csv("article,rank,views,date\nA,1,5,2016-12-02\n", "b.csv")
    with pytest.raises(Exception, match="header"):
        read_pageviews(spark, str(tmp_path)).collect()


ARTICLE = {"name": "A b", "url": "u", "abstract": "x", "description": "d", "extra": {"n": 1}}


def test_jsonl_with_an_unreadable_line(spark, csv):
    line = json.dumps(ARTICLE)
    path = csv(f"{line}\nnot json\n{line}\n", "articles.jsonl")
    articles = read_articles(spark, path)
    assert corrupt_records(articles).first() == (3, 1)
    assert clean_articles(articles).collect() == [("A b", "d", "u", "x", "ab")] * 2
    inferred = ingest_data(spark, path, "jsonl")
    assert inferred.count() == 3 and "extra" in inferred.columns


def test_json_document_and_array(spark, csv, tmp_path):
    csv(json.dumps(ARTICLE, indent=2), "one.json")
    csv(json.dumps([ARTICLE, ARTICLE], indent=2), "two.json")
    assert clean_articles(read_articles(spark, str(tmp_path), "json")).count() == 3
    assert ingest_data(spark, str(tmp_path), "json").count() == 3


def test_multi_line_file_read_as_lines_is_all_corrupt(spark, csv):
    path = csv(json.dumps(ARTICLE, indent=2), "one.json")
    total, corrupt = corrupt_records(read_articles(spark, path, "jsonl")).first()
    assert total == corrupt > 1


def test_both_ways_to_write_a_quote(spark, tmp_path):
    """Lines broken by the other way are read again; the others are not touched."""
    path = tmp_path / "views.csv"
    path.write_text(
        "rank,article,views,date\n"
        '1,"""Awaken,_My_Love!""",500,2017-01-01\n'
        '2,"say \\"hi\\", you",7,2017-01-02\n'
        "3,plain,8,2017-01-03\n"
        "4,a,b,c,d,e\n"
        "5,short\n"
        '6,"""Awaken""",9,2017-01-06\n')
    rows = {r["rank"]: r for r in read_pageviews(spark, str(path), flags=True, recover=True, file=True).collect()}
    assert (rows[1].article, rows[1].views, rows[1].recovered, rows[1].lost) == ('"Awaken,_My_Love!"', "500", True, False)
    assert (rows[2].article, rows[2].views, rows[2].recovered) == ('say "hi", you', "7", False)
    assert (rows[3].article, rows[3].recovered, rows[3].lost) == ("plain", False, False)
    assert rows[4].lost and rows[5].lost and not rows[4].recovered
    assert rows[6].views == "9" and not rows[6].lost
    assert {r.file.rsplit("/", 1)[1] for r in rows.values()} == {"views.csv"}
    # the reverse, where quotes are said to be doubled
    other = {r["rank"]: r for r in read_pageviews(spark, str(path), flags=True, recover=True, escape='"').collect()}
    assert (other[1].article, other[1].recovered) == ('"Awaken,_My_Love!"', False)
    assert (other[2].article, other[2].views, other[2].recovered) == ('say "hi", you', "7", True)
    # without it, the row is shifted as before
    plain = {r["rank"]: r for r in read_pageviews(spark, str(path)).collect()}
    assert plain[1].views != "500" and plain[3].views == "8"
    assert read_pageviews(spark, str(path), recover=True).columns == schemas.PAGEVIEWS.names


def test_files_are_told_apart(spark, tmp_path):
    for name, lines in (("a.jsonl", ['{"name": "x"}', "{broken", '{"name": "y"}']), ("b.jsonl", ["{broken"]), ("c.jsonl", [])):
        (tmp_path / name).write_text("".join(line + "\n" for line in lines))
    files = article_files(read_articles(spark, str(tmp_path), file=True))
    assert sorted((r.file.rsplit("/", 1)[1], r.total_rows, r.corrupt_rows) for r in files.collect()) == [("a.jsonl", 3, 1), ("b.jsonl", 1, 1)]
