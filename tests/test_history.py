"""Windows carried from load to load against windows over the whole history."""

import random
from datetime import date, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from rankhouse.plans import history
from rankhouse.plans.features import heat_momentum
from rankhouse.plans.history import BookHistory, advance, walk
from rankhouse.operators.windows import lifetime, peak_date
from rankhouse.sources.staging import exists, fresh_path

COLUMNS = ("book_id", "rank_date", "value", "previous", "diff", "growth_rate", "previous_diff", "acceleration", "peak", "peak_date")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    found = {}
    for _ in range(3000):
        day = date(2024, 1, 1) + timedelta(days=rng.randrange(120))
        book = "hot" if rng.random() < 0.3 else f"b{rng.randrange(60)}"
        found[book, day] = rng.choice([None, 0.0, 5.0, float(rng.randrange(100))])
    found["empty", date(2024, 1, 5)] = found["empty", date(2024, 3, 5)] = None
    found["once", date(2024, 2, 1)] = 3.0
    return spark.createDataFrame([(*k, v) for k, v in found.items()], "book_id string, rank_date date, numeric_popularity double").repartition(4)


def whole(rows):
    extra = {"created_at": "timestamp", "numeric_read_count": "double", "numeric_score": "double", "numeric_words": "double"}
    full = heat_momentum(rows.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in extra.items())))
    full = full.withColumn("peak", F.max("numeric_popularity").over(lifetime())).withColumn("peak_date", peak_date("numeric_popularity", lifetime()))
    names = ["numeric_popularity", "prev_day_popularity", "popularity_diff", "popularity_growth_rate", "prev_popularity_diff", "popularity_acceleration"]
    return full.select("book_id", "rank_date", *(F.col(a).alias(b) for a, b in zip(names, COLUMNS[2:8])), "peak", "peak_date")


def stored(spark):
    path = fresh_path(spark, "history")
    return BookHistory(spark, f"history_{path.split('/')[-2]}", path, buckets=3)


@pytest.mark.parametrize("cuts", [[], ["2024-02-01"], ["2024-01-02", "2024-01-03", "2024-03-20"]])
def test_appended_loads_equal_the_whole_history(spark, rows, cuts):
    kept, low = stored(spark), "2000-01-01"
    for high in [*cuts, "2100-01-01"]:
        part = rows.where(F.col("rank_date").between(low, F.date_sub(F.lit(high).cast("date"), 1)))
        assert kept.append(part) == part.count()
        low = high
    assert values(kept.read(), *COLUMNS) == values(whole(rows), *COLUMNS)
    state = {r.book_id: r for r in kept.state().collect()}
    totals = {r.book_id: r for r in rows.groupBy("book_id").agg(F.sum("numeric_popularity").alias("s"), F.count("numeric_popularity").alias("n"), F.count("*").alias("rows"), F.min("rank_date").alias("first"), F.max("rank_date").alias("last")).collect()}
    assert state.keys() == totals.keys()
    for book, r in totals.items():
        assert (state[book].total, state[book].n_values, state[book].n_rows, state[book].first_date, state[book].last_date) == (r.s, r.n, r.rows, r.first, r.last)


def test_a_load_reads_state_and_its_rows_only(spark, rows):
    kept = stored(spark)
    kept.append(rows.where("rank_date < '2024-02-01'"))
    arrived = rows.where("rank_date >= '2024-02-01'").withColumnRenamed("numeric_popularity", "value")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        walking = plan(walk(arrived, kept.state(), 3))
        moving = plan(advance(kept.state(), spark.table(kept._table("walk", 1))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert walking.count("_state_1[") == 1 and "_walk_1[" not in walking
    assert walking.count("Exchange hashpartitioning") == 1  # the arriving rows
    assert "Exchange" not in moving  # neither state nor walk


def test_earlier_dates_need_a_rebuild(spark, rows):
    kept = stored(spark)
    kept.append(rows.where("rank_date >= '2024-02-01'"))
    with pytest.raises(ValueError, match="rebuild"):
        kept.append(rows.where("rank_date < '2024-02-10'"))
    assert kept.append(rows.where("false")) == 0
    kept.rebuild(rows)
    assert values(kept.read(), *COLUMNS) == values(whole(rows), *COLUMNS)
    kept.append(rows.limit(1).select("book_id", F.lit("2030-01-01").cast("date").alias("rank_date"), "numeric_popularity"))
    assert kept.read().count() == rows.count() + 1


def test_a_load_that_broke_off_is_not_read(spark, rows, monkeypatch):
    kept = stored(spark)
    kept.append(rows.where("rank_date < '2024-02-01'"))
    with monkeypatch.context() as broken:
        broken.setattr(history, "advance", lambda state, walked: (_ for _ in ()).throw(RuntimeError("executor lost")))
        with pytest.raises(RuntimeError):
            kept.append(rows.where("rank_date >= '2024-02-01'"))
    assert kept.read().count() == rows.where("rank_date < '2024-02-01'").count()
    kept.append(rows.where("rank_date >= '2024-02-01'"))
    assert values(kept.read(), *COLUMNS) == values(whole(rows), *COLUMNS)
    assert not exists(spark, kept._path("state", 1)) and exists(spark, kept._path("state", 2))
