"""Layers kept by month: what a load touches, and that any order of loads gives what one run over all rows gives."""

import os
import re

import pytest
from conftest import values
from pyspark.sql import functions as F

from checks.layers import new_warehouse, ods
from rankhouse.plans.layers import Warehouse, run_layers
from rankhouse.plans.monthly import MONTH, MonthlyFacts
from rankhouse.schema import METRICS
from rankhouse.sources.staging import fresh_path


@pytest.fixture()
def warehouse(spark, small):
    path = fresh_path(spark, "monthly")
    made = new_warehouse(spark, small, f"monthly_{path.split('/')[-2]}", append=True, buckets=3)
    made.everything = made.source
    return made


def load(warehouse, condition, change=lambda df: df):
    warehouse.source = lambda: change(warehouse.everything().where(condition))
    outcome = {r.layer: r for r in run_layers(warehouse, ["ods", "dwd"]).collect()}
    assert all(r.ok for r in outcome.values()), outcome
    return outcome


def whole(spark, small, source):
    """The same rows through one full run."""
    path = fresh_path(spark, "whole")
    full = new_warehouse(spark, small, f"whole_{path.split('/')[-2]}")
    full.source = source
    outcome = {r.layer: r for r in run_layers(full, ["ods", "dwd"]).collect()}
    return full, outcome


def same(spark, warehouse, full):
    for layer in ("dwd_rank_facts", "dwd_newest_facts"):
        got, want = warehouse.layer(layer), full.layer(layer)
        assert sorted(got.columns) == sorted(want.columns)
        columns = sorted(c for c in want.columns if c not in METRICS)
        numbers = [F.round(c, 6).alias(c) for c in METRICS]
        assert values(got.select(*columns, *numbers), *columns, *METRICS) == values(want.select(*columns, *numbers), *columns, *METRICS)


def files(warehouse):
    folder = re.sub("^file:(//)?", "", warehouse._path("dwd_month_facts"))
    found = {}
    for top, _, names in os.walk(folder):
        for name in names:
            month = re.search(f"{MONTH}=([^/]+)", top)
            if month and name.endswith(".parquet"):
                found.setdefault(month[1], set()).add((name, os.stat(os.path.join(top, name)).st_mtime_ns))
    return found


def test_appended_run_equals_a_full_run(spark, small, warehouse):
    load(warehouse, "date_month >= '199503' AND date_month < '199707'")
    load(warehouse, "date_month < '199504'")  # an earlier part, and a month again
    outcome = load(warehouse, "date_month >= '199707'")
    full, by_layer = whole(spark, small, warehouse.everything)
    same(spark, warehouse, full)
    assert outcome["dwd_rank_facts"].rows == by_layer["dwd_rank_facts"].rows == warehouse.layer("dwd_rank_facts").count()


def test_a_load_touches_its_months_only(spark, small, warehouse):
    load(warehouse, "date_month < '199506'")
    before = files(warehouse)
    outcome = load(warehouse, "date_month >= '199505' AND date_month < '199507'")
    after = files(warehouse)
    assert set(after) - set(before) == {"199506"}
    assert {month for month in before if after[month] != before[month]} == {"199505"}
    assert outcome["dwd_rank_facts"].removed_bad_date is not None
    unchanged = files(warehouse)
    assert {r.layer: r.rows for r in run_layers(warehouse, ["dwd"]).collect()}["dwd_rank_facts"] == outcome["dwd_rank_facts"].rows
    assert files(warehouse) == unchanged  # nothing arrived


def test_replaced_and_emptied_months(spark, small, warehouse):
    load(warehouse, "date_month < '199506'")
    changed = lambda df: df.withColumn("popularity", F.lit("7万")).withColumn("image_link", F.lit("x"))
    load(warehouse, "date_month = '199503'", changed)
    nothing_valid = lambda df: df.withColumn("book_id", F.lit("http://x"))
    load(warehouse, "date_month = '199504'", nothing_valid)
    assert "199504" not in files(warehouse)

    def source():
        rows = warehouse.everything().where("date_month < '199506'")
        parts = [rows.where("date_month NOT IN ('199503', '199504')").withColumn("image_link", F.col("image_link").cast("string"))]
        return parts[0].unionByName(changed(rows.where("date_month = '199503'"))).unionByName(nothing_valid(rows.where("date_month = '199504'")))

    full, _ = whole(spark, small, source)
    assert "image_link" in full.layer("dwd_rank_facts").columns  # one month has a value now
    same(spark, warehouse, full)


def test_only_arriving_months_are_read_for_cleaning(spark, small, warehouse, monkeypatch):
    load(warehouse, "date_month < '199506'")
    read = []
    replace = MonthlyFacts.replace

    def watched(self, raw, months):
        read.extend(raw.where(F.col(MONTH).isin(*months)).inputFiles())
        return replace(self, raw, months)

    monkeypatch.setattr(MonthlyFacts, "replace", watched)
    load(warehouse, "date_month = '199506'")
    plan = warehouse._raw_months().stored().where(F.col(MONTH) == "199506")._jdf.queryExecution().executedPlan().toString()
    assert read and "PartitionFilters: [isnotnull(load_month" in plan


def test_a_run_that_broke_off_is_made_good(spark, small, warehouse, monkeypatch):
    load(warehouse, "date_month < '199601'")
    warehouse.source = lambda: warehouse.everything().where("date_month >= '199601'")
    fail = lambda self, arrived, months: (_ for _ in ()).throw(RuntimeError("executor lost"))
    with monkeypatch.context() as broken:
        broken.setattr(MonthlyFacts, "_count", fail)
        assert not [r for r in run_layers(warehouse, ["ods", "dwd"]).collect() if r.layer == "dwd_rank_facts"][0].ok
    assert all(r.ok for r in run_layers(warehouse, ["dwd"]).collect())
    full, _ = whole(spark, small, warehouse.everything)
    same(spark, warehouse, full)


def test_a_new_session_finds_the_months(spark, small, warehouse):
    load(warehouse, "date_month < '199601'")
    spark.sql(f"DROP TABLE {warehouse.table('dwd_month_facts')}")  # the catalog forgets, the files stay
    again = Warehouse(spark, source=warehouse.everything, database=warehouse.database, location=warehouse.location, append=True, clean_options=warehouse.clean_options)
    again.everything = warehouse.everything
    load(again, "date_month >= '199601'")
    full, _ = whole(spark, small, warehouse.everything)
    same(spark, again, full)


def test_features_do_not_shuffle_the_months(spark, small, warehouse):
    from rankhouse.plans import features

    load(warehouse, "date_month < '199506'")
    plan = features.capital_ltv(warehouse.layer("dwd_rank_facts"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rows_belong_to_the_month_of_their_date(spark, facts):
    rows = spark.createDataFrame(
        [("2024-01-31", "202312"), ("bad", "202312"), (None, ""), ("2024-13-01", None)], "rank_date string, date_month string"
    )
    from rankhouse.plans.monthly import _month_of

    assert values(rows.select(_month_of("rank_date", "date_month").alias("m")), "m") == [("202312",), ("202401",), ("undated",), ("undated",)]


def test_nothing_loaded_yet(spark, warehouse):
    warehouse.source = lambda: warehouse.everything().where("false")
    ods, dwd, newest = run_layers(warehouse, ["ods", "dwd"]).collect()
    assert (ods.ok, ods.rows) == (dwd.ok, dwd.rows) == (True, 0) and "no month" in newest.error


def test_append_needs_a_location(spark):
    with pytest.raises(ValueError):
        Warehouse(spark, source=lambda: None, append=True)


def test_raw_rows_come_back(spark, small, warehouse):
    load(warehouse, "true")
    raw = warehouse.raw()
    assert sorted(raw.columns) == sorted(ods(spark, small).columns) and raw.count() == ods(spark, small).count()
