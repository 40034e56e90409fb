import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from rankhouse.operators import stats
from rankhouse.operators.windows import history, is_newest, latest, lifetime, peak_date, previous


def quantile(data, q):
    position = (len(data) - 1) * q
    low = int(position)
    high = min(low + 1, len(data) - 1)
    return data[low] + (data[high] - data[low]) * (position - low)


@pytest.mark.parametrize("size, distinct", [(1, 1), (2, 2), (7, 3), (5000, 40), (5000, 5000)])
def test_exact_quantiles_against_sorting(spark, size, distinct):
    rng = random.Random(size + distinct)
    pool = [rng.uniform(-1e6, 1e6) for _ in range(distinct)]
    hot = pool[0]  # a third of the rows share one value
    data = [(hot if i % 3 == 0 else rng.choice(pool), float(i % 4) if i % 5 else None) for i in range(size)]
    df = spark.createDataFrame([*data, (None, None)], "x double, y double").repartition(4)
    found = {r.metric: r.quantiles for r in stats.exact_quantiles(df, ["x", "y"], [0, 0.25, 0.5, 0.75, 1]).collect()}
    for name, column in (("x", 0), ("y", 1)):
        ordered = sorted(row[column] for row in data if row[column] is not None)
        if ordered:
            assert found[name] == pytest.approx([quantile(ordered, q) for q in (0, 0.25, 0.5, 0.75, 1)], rel=1e-12)
        else:
            assert name not in found


def test_approximate_quantiles(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert stats.quantiles(df, ["x"], [0.25, 0.5], "approx").first().quantiles == pytest.approx([250, 500], abs=2)
    with pytest.raises(ValueError):
        stats.quantiles(df, ["x"], [0.5], "guess")


def test_dense_rank_equals_the_window(spark):
    rng = random.Random(5)
    groups = ["hot"] * 2000 + [rng.choice(["a", "b", None]) for _ in range(1500)]
    rows = [(i, g, rng.choice([None, 7.0, round(rng.uniform(-50, 5000), 1)])) for i, g in enumerate(groups)]
    df = spark.createDataFrame(rows, "i int, g string, v double").repartition(4)
    ranked = stats.with_dense_rank(df, ["g"], "v", "rank")
    df.createOrReplaceTempView("ranked_input")
    expected = spark.sql("SELECT i, g, v, dense_rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS rank FROM ranked_input")
    assert values(ranked, "i", "g", "v", "rank") == values(expected, "i", "g", "v", "rank")


def test_group_stats_treat_null_as_a_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0)], "g string, v double")
    result = stats.with_group_stats(df, ["g"], {"mean": F.avg("v")})
    assert values(result, "g", "v", "mean") == [("a", 1.0, 2.0), ("a", 3.0, 2.0), (None, 5.0, 6.0), (None, 7.0, 6.0)]
    assert result.columns == ["g", "v", "mean"]


def test_mode_prefers_the_smaller_of_equals(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (1.0,), (1.0,), (9.0,), (None,)], "v double")
    assert stats.mode(df, "v").first().v == 1.0


def test_modes_of_all_columns_from_one_pass(spark):
    rng, nan = random.Random(3), float("nan")
    data = [(rng.choice([None, nan, -0.0, 0.0, 1.5, 7.0]), rng.randint(-2, 2), None, rng.choice("xy") * (i % 3)) for i in range(400)]
    df = spark.createDataFrame(data, "a double, b int, c double, d string").repartition(5)
    found, columns = stats.modes(df, df.columns), df.columns
    assert found.columns == columns and [f.dataType for f in found.schema] == [f.dataType for f in df.schema]
    one = [stats.mode(df, c).first() for c in columns]
    assert repr(list(found.first())) == repr([row and row[0] for row in one])
    ties = spark.createDataFrame([(nan, 2), (nan, 1), (4.0, 1), (4.0, 2), (None, None), (None, None), (None, None)], "a double, b int")
    assert tuple(stats.modes(ties, ["a", "b"]).first()) == (4.0, 1)
    assert tuple(stats.modes(ties.where("b > 9"), ["a", "b"]).first()) == (None, None)
    plan = df.select(stats.fill_values(df, columns, "mode"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery#") >= 1 and plan.count("Aggregate [") == 2  # before, a pass for each column


SERIES = [("b", "2024-01-01", 5.0), ("b", "2024-01-03", 9.0), ("b", "2024-01-10", 9.0), ("c", "2024-01-02", 1.0)]


def test_histories(spark):
    df = spark.createDataFrame(SERIES, "book_id string, d string, numeric_popularity double").withColumn("rank_date", F.to_date("d"))
    result = df.select(
        "book_id",
        "d",
        previous("numeric_popularity", history()).alias("before"),
        is_newest(history()).alias("newest"),
        peak_date("numeric_popularity", lifetime()).cast("string").alias("peak"),
    )
    assert values(result, "book_id", "d", "before", "newest", "peak") == [
        ("b", "2024-01-01", None, False, "2024-01-03"),
        ("b", "2024-01-03", 5.0, False, "2024-01-03"),
        ("b", "2024-01-10", 9.0, True, "2024-01-03"),
        ("c", "2024-01-02", None, True, "2024-01-02"),
    ]


def test_latest_puts_null_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 3, 2), ("b", None, 3)], "k string, o int, v int")
    assert values(latest(df, ["k"], ["o"], ["v"]), "k", "v") == [("a", 2), ("b", 3)]
