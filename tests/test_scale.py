"""The layers at size: rows are shuffled once, in parts that a task sorts in memory, whatever the session's shuffle partitions."""

import uuid
from collections import Counter

from pyspark.sql import functions as F

from rankhouse.operators import cleaning, windows
from rankhouse.plans.layers import Warehouse, run_layers
from rankhouse.sources.staging import fresh_path, materialize, owned
from rankhouse.sources.tables import pass_order, read_layer, write_layer


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def raw(spark, rows=40, books=4):
    text = {c: F.lit(c) for c in "title author category1_name category2_name image_link unit rank_name date_type gender_type number".split()}
    days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    return spark.range(rows).select(
        F.concat(F.lit("B"), (F.col("id") % books).cast("string")).alias("book_id"),
        days.cast("string").alias("rank_date"),
        F.date_format(days, "yyyyMM").alias("date_month"),
        *(v.alias(c) for c, v in text.items()),
        F.lit("1").alias("status"),
        F.lit("9.0").alias("score"),
        F.lit("3万").alias("words_num"),
        F.col("id").cast("string").alias("popularity"),
        F.col("id").cast("string").alias("read_count"),
        F.lit("2024-02-01").cast("timestamp").alias("created_at"),
        F.timestamp_seconds(F.col("id")).alias("updated_at"),
    )


def test_parts_follow_the_rows(spark):
    assert windows.parts_for(spark, 0) == windows.parts_for(spark, 1000) == 4
    assert windows.parts_for(spark, 100 * windows.ROWS_AT_ONCE + 1) == 101


def test_crowded_entities_are_found_and_cut_down_first(spark):
    rows = spark.range(600).select(F.when(F.col("id") < 300, "hot").otherwise(F.col("id").cast("string")).alias("book_id"), (F.col("id") % 7).alias("day"), "id")
    total, crowded = windows.crowds(rows, "book_id", at_once=50)
    assert total == 600 and len(crowded) == 1
    keys = ["book_id", "day"]
    once = windows.latest(rows, keys, ["id"])
    dealt = windows.latest_by_entity(rows, "book_id", keys, ["id"], [], 3, crowded)
    assert sorted(dealt.collect()) == sorted(once.collect())
    assert dealt.count() == 307
    assert windows.crowds(rows.where("book_id = 'none'"), "book_id") == (0, [])


def test_rows_stay_dealt_by_book_after_the_newest_are_kept(spark):
    rows = materialize(raw(spark))
    kept = cleaning.numeric_rows(rows, parts=6)
    text = plan(kept)
    assert text.count("Exchange hashpartitioning") == 1 and ", 6), REPARTITION_BY_NUM" in text


def test_ids_that_are_removed_make_no_crowd(spark):
    """Rows without a usable id go before any are dealt: however many there are, the raw rows are read and tested once."""
    good = raw(spark)
    many = spark.range(2 * windows.ROWS_AT_ONCE + 2)
    bad = F.when(F.col("id") % 2 == 0, "http://bad/1")  # else NULL
    rows = good.unionByName(many.select(*((bad if c == "book_id" else F.lit(None).cast(good.schema[c].dataType)).alias(c) for c in good.columns)))
    rows = materialize(rows)
    assert len(windows.crowds(rows, "book_id")[1]) == 2
    kept = cleaning.numeric_rows(rows, parts=6)
    assert "Union" not in plan(kept) and plan(kept).count("Scan parquet") == 1
    assert sorted(kept.collect(), key=str) == sorted(cleaning.numeric_rows(materialize(good), parts=6).collect(), key=str)


def test_placed_rows_are_written_by_bucket_without_a_shuffle(spark):
    pass_order(spark)
    name, other = (f"placed_{uuid.uuid4().hex}" for _ in range(2))
    rows = raw(spark).select("book_id", "rank_date", "popularity")
    options = {"bucket_by": "book_id", "buckets": 3, "sort_by": ["rank_date"]}
    write_layer(rows, name, path=fresh_path(spark, name), **options)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert write_layer(read_layer(spark, name), other, path=fresh_path(spark, other), placed=True, **options) == 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    written = read_layer(spark, other)
    files = Counter(row["f"].rsplit("_", 1)[-1].split(".")[0] for row in written.select(F.input_file_name().alias("f")).distinct().collect())
    assert set(files.values()) == {1}  # one file for each bucket that has rows
    assert sorted(written.collect()) == sorted(rows.collect())
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"


def test_layers_by_book_and_by_month_hold_the_newest_rows(spark):
    results = []
    for append in (False, True):
        name = f"scale_{uuid.uuid4().hex}"
        warehouse = Warehouse(spark, lambda: raw(spark), name, fresh_path(spark, name), buckets=3, append=append)
        outcome = {row["layer"]: row for row in run_layers(warehouse, ["ods", "dwd"]).collect()}
        assert all(row["ok"] for row in outcome.values()) or append
        assert outcome["dwd_rank_facts"]["rows"] == 20 and outcome["dwd_rank_facts"]["removed_duplicate"] == 20
        facts = warehouse.layer("dwd_rank_facts")
        results.append(sorted((r["book_id"], str(r["rank_date"]), r["popularity"], r["numeric_popularity"]) for r in facts.collect()))
        assert [t.name for t in spark.catalog.listTables(name) if t.name.startswith("unique_")] == []
    assert results[0] == results[1] and len(results[0]) == 20


def test_unique_rows_are_staged_as_they_come(spark):
    """Only the cleaned layer is sorted within its buckets; before, the staged rows were sorted whole once more."""
    name = f"staged_{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, lambda: raw(spark), name, fresh_path(spark, name), buckets=3)
    run_layers(warehouse, ["ods"])
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with owned(spark) as scratch:
        rows = cleaning.numeric_rows(warehouse.raw(), parts=3).sortWithinPartitions(F.desc("popularity"))
        staged = warehouse._stage_by_book(scratch, 3)(rows, "unique_facts")
        table = next(t.name for t in spark.catalog.listTables(name) if t.name.startswith("unique_facts"))
        told = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {name}.{table}").collect()}
        assert told["Num Buckets"] == "3" and told.get("Sort Columns", "[]") == "[]"
        ordered = staged.select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "popularity").orderBy("i").collect()
        by_file = {}
        for row in ordered:
            by_file.setdefault(row["f"], []).append(row["popularity"])
        assert sum(map(len, by_file.values())) == 20 and all(texts == sorted(texts, reverse=True) for texts in by_file.values())
        codes = {f.rsplit("_", 1)[-1].split(".")[0] for f in by_file}
        assert len(codes) == len(by_file)  # one file for each bucket that has rows
    assert spark.conf.get(key) == before
