"""What the plans must look like at scale."""

import random
import re
from datetime import date, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from checks.layers import CHECKED_FEATURES, dwd, newest, ods
from checks.observations import TIE_BREAKERS
from checks.queries import QUERIES, settle
from rankhouse.operators import cleaning, stats, windows
from rankhouse.plans import features
from rankhouse.sources.staging import fresh_path, materialize
from rankhouse.sources.tables import write_layer


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_feature(spark, small):
    for name, feature in features.FEATURES.items():
        text = plan(feature(dwd(spark, small)))
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text, name


@pytest.mark.parametrize("name", ["ads_platform_ranking_trend", "ads_author_attenuation_effect", "ads_user_avoid_pitfalls", "ads_capital_ltv", "ads_capital_future_purchasing_power"])
def test_book_features_do_not_shuffle(spark, small, name):
    assert "Exchange" not in plan(features.FEATURES[name](dwd(spark, small)))


def sorts(text):
    return [line.strip() for line in text.splitlines() if re.search(r"^[ :+-]*(\*\(\d+\) )?Sort \[", line)]


@pytest.mark.parametrize("name", ["ads_author_attenuation_effect", "ads_user_avoid_pitfalls", "ads_capital_ltv", "ads_capital_future_purchasing_power"])
def test_book_features_do_not_sort(spark, small, name):
    """The layer's files are sorted by book and date, and the scan passes this order on."""
    layer = newest if name in features.OVER_NEWEST else dwd
    text = plan(features.FEATURES[name](layer(spark, small)))
    assert not sorts(text) and ("Window [" in text or "HashAggregate" in text)


def test_histories_do_not_sort(spark, small):
    for rows in (features.heat_momentum(dwd(spark, small)), features.reading_growth(dwd(spark, small)), windows.newest_per_book(dwd(spark, small))):
        text = plan(rows)
        assert "Window [" in text and not sorts(text) and "Exchange" not in text
    trend = plan(features.platform_ranking_trend(dwd(spark, small)))
    assert len(sorts(trend)) == 1 and "rank_name" in sorts(trend)[0]  # for the newest row of each list; none for the history


def test_one_scan_gives_the_totals_of_three_features(spark, small):
    text = plan(features.book_totals(dwd(spark, small)))
    assert scans(text) == 1 and "Exchange" not in text and not sorts(text)
    name = f"totals_{fresh_path(spark, 'x').split('/')[-2]}"
    write_layer(features.book_totals(dwd(spark, small)), name, path=fresh_path(spark, "totals"), bucket_by="book_id")
    totals = spark.table(name)
    for feature, over in features.OVER_TOTALS.items():
        text = plan(over(totals))
        assert scans(text) == 1 and "Exchange" not in text
        got, want = over(totals), features.FEATURES[feature](dwd(spark, small))
        assert got.dtypes == want.dtypes
        assert values(settle(got), *want.columns) == values(settle(want), *want.columns)


def test_reason_shuffles_only_partial_aggregates(spark, small):
    text = plan(features.author_reason(dwd(spark, small)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text


def scans(text):
    return text.count("FileScan parquet")


def test_heat_walks_the_history_once_without_a_shuffle(spark, small):
    walked = []

    def stage(df, label):
        walked.append(plan(df))
        return materialize(df, label)

    heat = features.platform_heat(dwd(spark, small), stage=stage)
    assert len(walked) == 1 and scans(walked[0]) == 1 and "Exchange" not in walked[0]
    assert not [line for line in sorts(walked[0]) if "rank_date" in line]  # the files have this order
    assert all("heat_walk" in file for file in heat.inputFiles()) and "Window [avg(" not in plan(heat)


def test_heat_walk_carries_only_newest_rows_whole(spark, facts):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(6)]
    changed = [{"rank_date": d, "category1_name": None if i > 3 else "xy"[i % 2], "numeric_popularity": 100.0 * (i + 1)} for i, d in enumerate(days)]
    rows = facts(*changed, {"book_id": "b2", "rank_date": days[2]})
    walked = features.heat_walk(rows)
    found = {(r["book_id"], r["category1_name"]): r for r in walked.collect()}
    assert {key: r["steps"] for key, r in found.items()} == {("b1", "x"): 2, ("b1", "y"): 2, ("b1", None): 2, ("b2", "c"): 1}
    newest = {key: r["newest"]["rank_date"] for key, r in found.items() if r["newest"] is not None}
    assert newest == {("b1", None): days[5], ("b2", "c"): days[2]}
    assert found["b1", "x"]["growth"] == 50.0 and round(found["b1", None]["growth"], 9) == 45.0
    assert sorted(r["book_id"] for r in features.platform_heat(rows).collect()) == ["b1", "b2"]


def test_three_features_read_the_newest_rows_only(spark, small):
    """One full scan of the cleaned layer, when the newest rows are written, serves all three."""
    for name in sorted(features.OVER_NEWEST):
        files = CHECKED_FEATURES[name](newest(spark, small)).inputFiles()
        layers = {file.split("/")[-2] for file in files} - {"rank_counts", "ranks"}  # these are counts of the newest rows
        assert layers == {"dwd_newest_facts"}, name
    assert scans(plan(windows.latest_per_book(dwd(spark, small)))) == 1


def test_cleaning_reads_the_unique_rows_twice(spark, small):
    staged = []

    def stage(df, label):
        staged.append((label, plan(df)))
        return materialize(df, label)

    text = plan(cleaning.clean_all(ods(spark, small), tie_breakers=TIE_BREAKERS, stage=stage))
    assert [label for label, _ in staged] == ["unique_facts", "value_counts"]
    assert scans(staged[1][1]) == 1  # the counts
    assert len([line for line in text.splitlines() if "FileScan parquet" in line and "book_id" in line]) == 1  # the rows themselves


def test_duplicates_are_cut_before_the_shuffle(spark, small):
    text = plan(cleaning.keep_latest(ods(spark, small), tie_breakers=TIE_BREAKERS))
    final, exchange, partial = (text.index(part) for part in ("row_number(), 1, Final", "Exchange hashpartitioning(book_id", "row_number(), 1, Partial"))
    assert final < exchange < partial


def test_scans_read_only_what_a_feature_needs(spark, small):
    text = plan(features.heat_momentum(dwd(spark, small)).select("book_id", "popularity_diff"))
    schema = text[text.rindex("ReadSchema") :]
    assert "words" not in schema and "title" not in schema
    pushed = plan(windows.latest_per_book(dwd(spark, small).where("gender_type = 'male'")))
    assert "EqualTo(gender_type,male)" in pushed


def test_reports_take_the_top_without_a_full_sort(spark, small):
    assert "TakeOrderedAndProject" in plan(QUERIES["q_ip_value_top"](spark, small))


@pytest.fixture(scope="module")
def skewed(spark):
    """One book with a third of all raw rows, one category and one value with most of the books."""
    rng = random.Random(1)
    rows = []
    for i in range(6000):
        book = "hot" if i % 3 == 0 else f"b{rng.randrange(800)}"
        day = date(2020, 1, 1) + timedelta(days=rng.randrange(400))
        rows.append((book, str(day), "big" if rng.random() < 0.9 or book == "hot" else "small", float(rng.choice([7, 7, rng.randrange(10**6)])), i))
    schema = "book_id string, day string, category1_name string, numeric_popularity double, i int"
    return spark.createDataFrame(rows, schema).withColumn("rank_date", F.to_date("day")).repartition(8)


def test_one_hot_book_is_cut_to_its_days(skewed):
    unique = windows.latest(skewed, ["book_id", "rank_date"], ["i"])
    assert unique.where("book_id = 'hot'").count() <= 400
    expected = skewed.groupBy("book_id", "rank_date").agg(F.max("i").alias("i"))
    assert values(unique, "book_id", "i") == values(expected, "book_id", "i")


def test_ranks_in_a_hot_category(spark, skewed):
    ranked = stats.with_dense_rank(skewed, ["category1_name"], "numeric_popularity", "rank")
    skewed.createOrReplaceTempView("skewed_input")
    expected = spark.sql("SELECT i, dense_rank() OVER (PARTITION BY category1_name ORDER BY numeric_popularity DESC) AS rank FROM skewed_input")
    assert values(ranked, "i", "rank") == values(expected, "i", "rank")


def test_no_window_holds_a_whole_category(spark, small):
    """Every window of the ranking is partitioned by book, by band, or runs over the bands of a group."""
    staged = []

    def stage(df, label):
        staged.append(plan(df))
        return materialize(df, label)

    text = plan(features.user_layered_recommendation(dwd(spark, small), stage=stage)) + "".join(staged)
    assert "dense_rank" not in text and "Window [avg(" not in text
    assert "_place" in text


def test_recommendation_reads_the_newest_rows_twice(spark, small):
    """Once for the counts of both levels, once when ranks and averages are joined; all else comes from the counts."""
    staged = []

    def stage(df, label):
        staged.append((label, plan(df)))
        return materialize(df, label)

    text = plan(features.user_layered_recommendation(newest(spark, small), stage=stage))
    assert [label for label, _ in staged] == ["rank_counts", "ranks"]
    reads = [part.count("dwd_newest_facts[") for part in (*(text for _, text in staged), text)]
    assert reads == [1, 0, 1]
    assert "Expand" in staged[0][1] and staged[1][1].count("Window [") <= 4  # one pass over the values of both levels


def test_ranks_of_several_levels(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["x", None, "z"]), rng.choice([None, 7.0, float(rng.randrange(50))])) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, g string, h string, v double").repartition(4)
    ranked = stats.with_dense_ranks(df, {"all": [], "one": ["g"], "two": ["h", "g"]}, "v", averages={"one": "mean", "two": "finer"}, bands=9)
    df.createOrReplaceTempView("levels_input")
    expected = spark.sql(
        "SELECT *, dense_rank() OVER (ORDER BY v DESC NULLS LAST) AS all, dense_rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS one, "
        "dense_rank() OVER (PARTITION BY g, h ORDER BY v DESC NULLS LAST) AS two, avg(v) OVER (PARTITION BY g) AS mean, avg(v) OVER (PARTITION BY g, h) AS finer "
        "FROM levels_input"
    )
    columns = ["i", "g", "h", "v", "all", "one", "two"]
    assert values(ranked, *columns) == values(expected, *columns)
    rounded = [F.round(c, 9).alias(c) for c in ("mean", "finer")]
    assert values(ranked.select("i", *rounded), "i", "mean", "finer") == values(expected.select("i", *rounded), "i", "mean", "finer")
    with pytest.raises(ValueError):
        stats.with_dense_ranks(df, {"one": ["g"], "two": ["h"]}, "v")


def test_a_value_that_half_of_the_rows_share_is_split(spark):
    """The join that brings the ranks back deals such a value out, also without adaptive execution."""
    rows = spark.range(8000).select("id", F.lit("g").alias("g"), F.when(F.col("id") % 2 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("v"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        ranked = stats.with_dense_rank(rows, ["g"], "v", "rank", bands=64)
        largest = ranked.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        found = values(ranked, "id", "rank")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert largest < 8000 / 10
    rows.createOrReplaceTempView("half_shared")
    assert found == values(spark.sql("SELECT id, dense_rank() OVER (PARTITION BY g ORDER BY v DESC) AS rank FROM half_shared"), "id", "rank")
