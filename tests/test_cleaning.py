from datetime import datetime

from conftest import values
from pyspark.sql import Observation, functions as F

from rankhouse.operators import cleaning
from rankhouse.schema import METRICS

RAW = (
    "book_id string, title string, author string, category1_name string, category2_name string, words_num string, image_link string, "
    "status string, number string, unit string, rank_name string, rank_date string, score string, read_count string, popularity string, "
    "gender_type string, created_at timestamp, updated_at timestamp"
)
GOOD = {
    "book_id": "b1",
    "title": "t",
    "author": "a",
    "category1_name": "c",
    "category2_name": "s",
    "words_num": "10万字",
    "image_link": None,
    "status": "0",
    "number": "1",
    "unit": "万",
    "rank_name": "大热",
    "rank_date": "2024-01-01",
    "score": "8.0",
    "read_count": "1万",
    "popularity": "2万",
    "gender_type": "male",
    "created_at": datetime(2024, 1, 1),
    "updated_at": datetime(2024, 1, 2),
}


def raw(spark, *partials):
    return spark.createDataFrame([tuple((GOOD | p).values()) for p in partials], RAW)


def test_drop_empty_columns_keeps_needed_ones(spark):
    df = raw(spark, {"status": None}, {"status": None})
    kept = cleaning.drop_empty_columns(df).columns
    assert "image_link" not in kept and "status" in kept and "unit" in kept
    assert "status" not in cleaning.drop_empty_columns(df, protected=()).columns
    empty = df.where("false")
    assert set(cleaning.drop_empty_columns(empty).columns) == set(df.columns) - {"image_link"}


def test_key_filters(spark):
    df = raw(
        spark,
        {"book_id": "ok"},
        {"book_id": "https://x/1"},
        {"book_id": None},
        {"book_id": "bad date", "rank_date": "2024/01/01"},
        {"book_id": "no such day", "rank_date": "2024-02-30"},
        {"book_id": "no date", "rank_date": None},
    )
    removed = Observation()
    assert values(cleaning.drop_bad_keys(df, removed=removed), "book_id") == [("ok",)]
    assert removed.get["removed_rows"] == 5
    dated = df.where("book_id = 'ok'").withColumn("rank_date", F.to_date("rank_date"))
    assert cleaning.drop_bad_keys(dated).count() == 1
    nothing = raw(spark, {"book_id": None, "title": None, "author": None}, {"book_id": None, "title": None})
    assert cleaning.keep_any_key(nothing).count() == 1
    titles = raw(spark, {"title": "0"}, {"title": "1"}, {"title": None}, {"title": "01"})
    assert values(cleaning.drop_invalid_titles(titles), "title") == [("01",)]


def test_text_columns(spark):
    df = raw(spark, {"title": "a\nb\r\nc", "status": "1"}, {"title": "x", "status": "停更", "rank_name": None, "gender_type": None})
    assert values(cleaning.replace_newlines(df), "title") == [("a b  c",), ("x",)]
    assert values(cleaning.decode_status(df), "status") == [("停更",), ("已完结",)]
    assert values(cleaning.fill_labels(df), "rank_name", "gender_type") == [("大热", "male"), ("未知", "unknown")]
    assert "intro" not in cleaning.drop_column(df.withColumn("intro", F.lit("x"))).columns


def test_newest_row_wins_whatever_the_input_order(spark):
    later, earlier = datetime(2024, 1, 5), datetime(2024, 1, 3)
    df = raw(
        spark,
        {"updated_at": earlier, "number": "old"},
        {"updated_at": later, "created_at": earlier, "number": "b"},
        {"updated_at": later, "created_at": earlier, "number": "a"},
        {"updated_at": later, "created_at": None, "number": "no creation"},
        {"updated_at": None, "number": "no update"},
    )
    for order in ("number", F.desc("number")):
        assert values(cleaning.keep_latest(df.orderBy(order).repartition(3)), "number") == [("a",)]


def test_fill_strategies(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (4.0, None), (10.0, None), (None, None)], "v double, none double")
    for strategy, expected in (("mean", 4.0), ("median", 2.5), ("mode", 1.0)):
        result = cleaning.fill_numbers(df, ["v", "none"], strategy)
        assert sorted(r.v for r in result.collect()) == sorted([1.0, 1.0, 4.0, 10.0, expected])
        assert {r.none for r in result.collect()} == {0.0}


def test_outliers_become_the_median(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 1000, -1000]], "v double")
    assert sorted(r.v for r in cleaning.cap_outliers(df, ["v"]).collect()) == [1, 2, 3, 4, 4.5, 4.5, 5, 6, 7, 8]
    assert cleaning.cap_outliers(df.where("false"), ["v"]).count() == 0


def test_quality_scores(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, None, 1.0), (None, None, None)], "numeric_popularity double, numeric_read_count double, numeric_score double")
    assert values(cleaning.score_quality(df), "data_quality_score") == [(0.5,), (0.5,), (1.0,)]
    assert [round(v[0], 6) for v in values(cleaning.score_quality_weighted(df), "data_quality_score")] == [0.0, 0.7, 1.0]


def messy(spark):
    return raw(
        spark,
        {},
        {"number": "duplicate"},
        {"book_id": "b2", "popularity": "未找到", "score": "获取失败", "words_num": "120万", "category1_name": None},
        {"book_id": "b3", "popularity": "4万", "read_count": "请求失败", "status": "1", "rank_date": "2024-02-01"},
        {"book_id": "http://x", "title": "0"},
    )


def test_clean_all(spark):
    cleaned = cleaning.clean_all(messy(spark))
    assert values(cleaned, "book_id", *METRICS, "category1_name", "data_quality_score") == [
        ("b1", 20000.0, 10000.0, 8.0, 100000.0, "c", 1.0),
        ("b2", 30000.0, 10000.0, 8.0, 100000.0, "未知", 1.0),
        ("b3", 40000.0, 10000.0, 8.0, 100000.0, "c", 1.0),
    ]
    assert dict(cleaned.dtypes)["rank_date"] == "date" and "image_link" not in cleaned.columns
    scored = cleaning.clean_all(messy(spark), score_before_filling=True)
    assert values(scored, "book_id", "data_quality_score") == [("b1", 1.0), ("b2", 0.5), ("b3", 0.5)]


def test_clean_all_does_not_depend_on_the_order_of_rows(spark):
    first, second = (cleaning.clean_all(df) for df in (messy(spark), messy(spark).orderBy(F.desc("number"), "book_id").repartition(5)))
    assert values(first, *sorted(first.columns)) == values(second, *sorted(first.columns))


def test_clean_all_of_nothing(spark):
    assert cleaning.clean_all(messy(spark).where("false")).count() == 0
