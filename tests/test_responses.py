import json

import pytest
from conftest import values
from pyspark.sql import functions as F

from rankhouse.plans import responses
from rankhouse.sources.staging import fresh_path

BOOK = {"book_id": "1", "title": "t", "is_over": "1", "number": "5", "unit": "万"}


def test_rank_lists(spark):
    bodies = [
        (1, json.dumps({"data": {"table_data": [BOOK, {"book_id": "2", "words_num": None}]}})),
        (2, json.dumps({"data": {"table_data": []}})),
        (3, json.dumps({"msg": "busy"})),
        (4, json.dumps({"data": {}})),
        (5, "not json"),
        (6, None),
    ]
    df = spark.createDataFrame(bodies, "request int, body string")
    flat = responses.flatten_rank_lists(df)
    assert values(flat, "request", "book_id", "title", "status", "number", "words_num", "intro") == [
        (1, "1", "t", "1", "5", "", ""),
        (1, "2", "", "", "", "", ""),
    ]
    assert "is_over" not in flat.columns and "body" not in flat.columns
    assert values(responses.rejected_rank_lists(df), "request", "reason") == [(3, "busy"), (4, ""), (5, ""), (6, "")]


def test_details(spark):
    pages = [
        (1, '<span class="score">分</span><span> 9.2 </span><em>12.5</em>'),
        (2, "<em>  </em>"),
        (3, None),
    ]
    patterns = {"score": "</span><span>([^<]*)</span>", "read_count": "<em>([^<]*)</em>"}
    result = responses.extract_details(spark.createDataFrame(pages, "id int, html string"), patterns)
    assert values(result, "id", "score", "read_count", "error", "error_msg") == [
        (1, "9.2", "12.5", False, ""),
        (2, "未找到", "未找到", False, ""),
        (3, "请求失败", "请求失败", True, "no response"),
    ]


def test_upsert(spark):
    schema = "gender string, book_id string, rank_name string, date_month string, arrival int, score string"
    stored = spark.createDataFrame([("男生", "1", "大热", "202310", 1, "old"), ("男生", "2", "大热", "202310", 1, "kept")], schema)
    arrived = [("男生", "1", "大热", "202310", 2, "new"), ("女生", "1", "大热", "202310", 2, "other channel"), ("男生", "1", "新书", "202310", 2, "added")]
    merged = responses.upsert_latest(stored, spark.createDataFrame(arrived, schema))
    assert sorted(r.score for r in merged.collect()) == ["added", "kept", "new", "other channel"]


def test_stored_upsert_touches_only_the_months_that_arrive(spark):
    schema = "gender string, book_id string, rank_name string, date_month string, arrival int, score string"
    path = fresh_path(spark, "upsert_months")
    first = [("男生", "1", "大热", "202310", 1, "old"), ("男生", "2", "大热", "202311", 1, "untouched"), ("男生", "3", "收藏", "", 1, "undated")]
    assert responses.store_upsert(path, spark.createDataFrame(first, schema)) == 3
    names = lambda: {f for f in responses.stored_items(spark, path, frame.schema).where("month <> '202310'").inputFiles() if "202310" not in f}
    frame = spark.createDataFrame([("男生", "1", "大热", "202310", 2, "new"), ("女生", "1", "大热", "202310", 2, "added")], schema)
    before = names()
    assert responses.store_upsert(path, frame) == 2
    assert names() == before
    rows = responses.stored_items(spark, path, frame.schema)
    assert sorted((r.month, r.score) for r in rows.collect()) == [("202310", "added"), ("202310", "new"), ("202311", "untouched"), ("undated", "undated")]
    with pytest.raises(ValueError):
        responses.store_upsert(path, frame, keys=["book_id"])


def test_lists_are_parsed_once(spark):
    df = spark.createDataFrame([(1, json.dumps({"data": {"table_data": [BOOK]}})), (2, "x")], "request int, body string")
    books, rejects = responses.split_rank_lists(df)
    assert values(books, "request", "book_id") == [(1, "1")] and values(rejects, "request", "reason") == [(2, "")]
    assert "from_json" not in books._jdf.queryExecution().executedPlan().toString()


def test_unify(spark):
    male = spark.createDataFrame([("1", "202310")], "book_id string, date_month string")
    female = spark.createDataFrame([("202311", "2"), ("", "3")], "date_month string, book_id string")
    unified = responses.unify_genders(male, female).withColumn("rank_date", F.col("rank_date").cast("string"))
    assert values(unified, "book_id", "gender_type", "rank_date") == [("1", "male", "2023-10-01"), ("2", "female", "2023-11-01"), ("3", "female", None)]


def test_crawl_grid(spark):
    grid = responses.expected_requests(spark)
    assert grid.count() == 770
    assert grid.where("date_month <> ''").agg(F.min("date_month"), F.max("date_month")).first()[:] == ("202310", "202510")
    seen = grid.where("page < 5").unionByName(grid.where("page = 1"))
    assert responses.coverage_gaps(grid, seen).count() == 154


def test_crawl_stats(spark):
    items = [("男生", True), ("男生", False), ("女生", False), ("?", None)]
    row = responses.crawl_stats(spark.createDataFrame(items, "gender string, error boolean")).first()
    assert row[:] == (2, 1, 3, 1)
    assert responses.known_channels(spark.createDataFrame(items, "gender string, error boolean")).count() == 3
