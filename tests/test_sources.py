import json
import os
import re

import pytest
from conftest import values
from pyspark.sql import functions as F, types as T

from rankhouse.plans.features import FEATURES
from rankhouse.plans.layers import resolve_step, run_layers
from rankhouse.schema import as_observations
from rankhouse.sources import items, jdbc, staging, tables
from checks.layers import new_warehouse
from checks.queries import QUERIES


def test_write_layer_replaces_and_counts(spark):
    path = staging.fresh_path(spark, "replaced")
    name = "replaced_" + path.split("/")[-2]
    assert tables.write_layer(spark.range(10), name, path=path) == 10
    assert tables.write_layer(spark.range(3), name, path=path) == 3
    assert tables.read_layer(spark, name).count() == 3


def test_bucketed_layer_needs_no_shuffle_for_its_key(spark):
    path = staging.fresh_path(spark, "bucketed")
    name = "bucketed_" + path.split("/")[-2]
    rows = spark.range(1000).select((F.col("id") % 50).cast("string").alias("book_id"), "id")
    tables.write_layer(rows, name, path=path, bucket_by="book_id", buckets=4)
    counts = tables.read_layer(spark, name).groupBy("book_id").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.where("count = 20").count() == 50


def test_append_and_replace_partitions(spark):
    path = staging.fresh_path(spark, "appended")
    january = spark.createDataFrame([("202401", 1)], "date_month string, v int")
    february = spark.createDataFrame([("202402", 2)], "date_month string, v int")
    tables.append_layer(january, path)
    tables.append_layer(february, path)
    tables.append_layer(january, path)
    read = lambda: values(spark.read.schema("v int, date_month string").parquet(path), "date_month", "v")
    assert read() == [("202401", 1), ("202401", 1), ("202402", 2)]
    tables.append_layer(january, path, replace_partitions=True)
    assert read() == [("202401", 1), ("202402", 2)]


def test_verify(spark):
    result = tables.verify(spark.range(7).withColumn("x", F.lit("a")), columns=1)
    assert values(result, *result.columns) == [(1, "id", "bigint", 7)]


def test_samples(spark):
    df = spark.range(20000).withColumn("k", F.col("id") % 2000)
    keyed = tables.sample(df, 0.1, keys=["k"])
    assert 1000 < keyed.count() < 3000
    assert keyed.groupBy("k").count().where("count <> 10").count() == 0  # whole keys
    assert keyed.count() == tables.sample(df.repartition(3), 0.1, keys=["k"]).count()
    assert 1000 < tables.sample(df, 0.1, seed=3).count() < 3000


def test_a_small_fraction_of_many_keys(spark):
    assert 1 <= tables.sample(spark.range(2_000_000), 0.00001, keys=["id"]).count() <= 60


def test_buckets_are_a_choice_of_layout(spark):
    path = staging.fresh_path(spark, "layout")
    name = "layout_" + path.split("/")[-2]
    tables.write_layer(spark.range(100), name, path=path, bucket_by="id", buckets=3)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Num Buckets"] == "3"


def test_json_items(spark):
    schema = T.StructType([T.StructField("book_id", T.StringType()), T.StructField("title", T.StringType())])
    df = spark.createDataFrame([("1", "引\"号\n"), ("2", None)], schema)
    path = staging.fresh_path(spark, "items")
    items.write_lines(df, path)
    assert all("title" in json.loads(r.value) for r in spark.read.text(path).collect())
    assert values(items.read_lines(spark, path, schema), "book_id", "title") == values(df, "book_id", "title")


def test_shared_folder_is_the_configured_one(spark):
    assert staging.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_no_shared_folder_is_an_error():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="checkpoint"):
        staging.shared_folder(Session)


def test_scratch_is_removed(spark):
    scratch = staging.Scratch(spark)
    rows = scratch.write(spark.range(3))
    path = scratch.paths[0]
    assert rows.count() == 3 and staging.exists(spark, path)
    scratch.remove()
    assert not staging.exists(spark, path) and not staging.remove(spark, path)


def _shared(spark):
    """All files in the shared folder."""
    folder = re.sub("^file:(//)?", "", staging.shared_folder(spark))
    return {os.path.join(top, name) for top, _, names in os.walk(folder) for name in names}


def test_a_run_leaves_nothing_but_its_layers(spark, small):
    """Unique rows, value counts, ranks, walks and shared totals are gone, and so are the folders made for them."""
    path = staging.fresh_path(spark, "tidy")
    warehouse = new_warehouse(spark, small, "tidy_" + path.split("/")[-2])
    before = _shared(spark)
    outcome = run_layers(warehouse, ["ods", "dwd", "ads"])
    layers = {row.layer for row in outcome.collect()}
    left = {f.split(f"{warehouse.location.split('/')[-1]}/")[1].split("/")[0] for f in _shared(spark) - before}
    assert left == layers
    assert not [t.name for t in spark.catalog.listTables(warehouse.database) if t.name.startswith("book_totals")]


def test_staged_tables_are_removed_also_after_a_failure(spark):
    before = _shared(spark)
    with pytest.raises(ZeroDivisionError):
        with staging.owned(spark) as outer:
            staging.materialize(spark.range(3), "outer")
            with staging.owned(spark):
                inner = staging.materialize(spark.range(4), "inner")
                assert inner.count() == 4
            assert len(_shared(spark) - before) > 0 and len(outer.paths) == 1
            raise ZeroDivisionError
    assert _shared(spark) == before


def test_features_leave_nothing_when_owned(spark, small):
    before = _shared(spark)
    for name in ("ads_platform_heat", "ads_user_layered_recommendation", "clean_all", "x_ranklist_flatten"):
        with staging.owned(spark):
            rows = QUERIES[name](spark, small)
            assert rows.count() > 0
    assert all("/rankhouse_" in f and "dwd_" in f or "ods_" in f for f in _shared(spark) - before)  # the layers that the queries share


def test_jdbc_options():
    """Without a database: only what is handed to Spark's JDBC source."""
    connection = {"url": "jdbc:mysql://host/db", "user": "u", "fetchsize": "50"}
    plain = jdbc.read_options(connection, "t")
    assert plain == {"url": "jdbc:mysql://host/db", "user": "u", "fetchsize": "50", "dbtable": "t"}
    split = jdbc.read_options({}, "t", partition_column="id", lower=0, upper=100, partitions=4)
    assert split == {"fetchsize": "1000", "dbtable": "t", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    with pytest.raises(ValueError):
        jdbc.read_options({}, "t", partition_column="id")
    assert jdbc.write_options({"url": "x"}, "t", partitions=2) == {"batchsize": "1000", "url": "x", "dbtable": "t", "numPartitions": "2"}


def test_steps_by_name_and_number():
    assert [resolve_step(s) for s in (1, "2", "ADS", "export")] == ["ods", "dwd", "ads", "export"]
    for bad in ("0", "5", "all"):
        with pytest.raises(ValueError):
            resolve_step(bad)


def test_layers_run_on_after_a_failure(spark, small):
    path = staging.fresh_path(spark, "failing")
    warehouse = new_warehouse(spark, small, "failing_" + path.split("/")[-2])

    def broken(df):
        raise RuntimeError("broken on purpose" + "!" * 2000)

    warehouse.features = {"broken": broken, "ads_capital_ltv": FEATURES["ads_capital_ltv"]}
    outcome = run_layers(warehouse)
    by_layer = {r.layer: r for r in outcome.collect()}
    assert list(by_layer) == ["ods_rank_facts", "dwd_rank_facts", "dwd_newest_facts", "broken", "ads_capital_ltv", "export:broken", "export:ads_capital_ltv"]
    assert not by_layer["broken"].ok and by_layer["broken"].error.endswith("!" * 2000)
    assert by_layer["ads_capital_ltv"].ok and by_layer["ads_capital_ltv"].rows > 0
    assert not by_layer["export:ads_capital_ltv"].ok  # nowhere to export to
    assert by_layer["ods_rank_facts"].rows == 6000


def test_other_tables_as_observations(spark):
    df = spark.createDataFrame([("u", "2024-01-01", 5)], "user string, d string, amount int")
    row = as_observations(df, {"book_id": "user", "rank_date": "d", "numeric_popularity": "amount"}, {"status": "x"}).first()
    assert (row.book_id, str(row.rank_date), row.numeric_popularity, row.status, row.title) == ("u", "2024-01-01", 5.0, "x", None)
    with pytest.raises(ValueError):
        as_observations(df, {"unknown": "d"})
