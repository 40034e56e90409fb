"""The store that only appends: the newest record of each key whatever the loads were, arriving records alone shuffled."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from rankhouse.plans.responses import UPSERT_KEYS, upsert_latest
from rankhouse.plans.upserts import UpsertStore
from rankhouse.sources.staging import exists, fresh_path

COLUMNS = (*UPSERT_KEYS, "arrival", "score")


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(2)
    rows = []
    for i in range(4000):
        book = "1" if rng.random() < 0.3 else str(rng.randrange(200))
        month = rng.choice(["202310", "202311", "", None])
        rows.append((rng.choice(["男生", "女生"]), book, rng.choice(["大热", "新书"]), month, rng.randrange(40), str(i)))
    return spark.createDataFrame(rows, "gender string, book_id string, rank_name string, date_month string, arrival int, score string").repartition(4)


@pytest.fixture()
def store(spark, records):
    path = fresh_path(spark, "upserts")
    return UpsertStore(spark, f"upserts_{path.split('/')[-2]}", path, records.schema, tie_breakers=["score"], buckets=3)


def expected(records):
    return values(upsert_latest(records.where("false"), records, tie_breakers=["score"]), *COLUMNS)


def test_any_loads_give_the_newest_records(records, store):
    for condition in ("arrival % 3 = 1", "arrival % 3 = 0", "arrival < 20", "arrival % 3 = 2"):  # out of order, some again
        part = records.where(condition)
        assert store.load(part) == part.count()
    assert values(store.read(), *COLUMNS) == expected(records)


def test_compaction_keeps_the_result(spark, records, store):
    store.load(records.where("arrival < 20"))
    store.load(records.where("arrival < 30"))
    before, kept = store.stored().count(), store.compact()
    assert kept == store.stored().count() < before and store.versions() == [2]
    assert not exists(spark, f"{store.path}/v1")
    store.load(records.where("arrival >= 30"))
    assert values(store.read(), *COLUMNS) == expected(records)


def test_only_arriving_records_are_shuffled_and_written(spark, records, store):
    store.load(records.where("arrival < 20"))
    files = set(store.stored().inputFiles())
    store.load(records.where("arrival >= 20"))
    assert files < set(store.stored().inputFiles())  # the stored ones are as they were
    plan = store.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    pushed = store.read().where("date_month = '202310'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(date_month,202310)" in pushed


def test_a_new_session_finds_the_store(spark, records, store):
    store.load(records.where("arrival < 20"))
    spark.sql(f"DROP TABLE {store.name}_v1")  # the catalog forgets, the files stay
    again = UpsertStore(spark, store.name, store.path, records.schema, tie_breakers=["score"], buckets=17)
    again.load(records.where("arrival >= 20"))
    assert values(again.read(), *COLUMNS) == expected(records)
    assert "Exchange" not in again.read()._jdf.queryExecution().executedPlan().toString()


def test_a_compaction_that_broke_off_is_ignored(spark, records, store):
    store.load(records)
    records.limit(5).write.parquet(f"{store.path}/v2/part")  # no _SUCCESS of its own
    assert store.versions() == [1]
    store.compact()
    assert store.versions() == [2] and values(store.read(), *COLUMNS) == expected(records)


def test_repeated_load_changes_nothing(records, store):
    store.load(records)
    once = values(store.read(), *COLUMNS)
    store.load(records)
    assert values(store.read(), *COLUMNS) == once


def test_columns_beside_the_schema_are_left_out(records, store):
    store.load(records.withColumn("extra", F.lit(1)).select("extra", *reversed(records.columns)))
    assert store.read().columns == records.columns
