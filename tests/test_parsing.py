import datetime

import pytest
from pyspark.sql import functions as F

from rankhouse.functions.expressions import by_ceiling, by_floor, change, first_true, flag, in_bucket, percent_change, ratio
from rankhouse.functions.parsing import metric_number, month_start, plain_number, words_number
from rankhouse.fixed_values import AUTHOR_RULES, HEAT_LEVELS, HEAT_RULES, IP_RULES, WORDS_RANGES


def parsed(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row.v for row in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


METRIC_CASES = {
    "1.5万": 15000.0,
    "2亿": 2e8,
    "3": 3.0,
    " 4.5 ": 4.5,
    "-2万": -20000.0,
    "1e3": 1000.0,
    ".5": 0.5,
    "": None,
    None: None,
    "未找到": None,
    "获取失败": None,
    "请求失败": None,
    "NaN": None,
    "Infinity": None,
    "-inf": None,
    "1亿2万": None,
    "9.0d": None,
    "0x1p3": None,
    "0x1.8p1": None,
    "0x1p3万": None,
    "5\n": None,
    "5\n万": None,
    "1e5": 100000.0,
    "9f": None,
    "1 2": None,
    "万": None,
}


def test_metric_numbers(spark):
    assert parsed(spark, list(METRIC_CASES), metric_number) == list(METRIC_CASES.values())


def test_default_unit_applies_to_unitless_text_only(spark):
    assert parsed(spark, ["145.7", "2万", "x"], lambda c: metric_number(c, 10000.0)) == [1457000.0, 20000.0, None]


def test_words(spark):
    cases = {"174.83万字": 1748300.0, "9000字": 9000.0, "120万": None, "5000": 5000.0, "未找到": None, None: None}
    assert parsed(spark, list(cases), words_number) == pytest.approx(list(cases.values()))


def test_plain_numbers(spark):
    assert parsed(spark, ["8.5", "8.5分", "", None], plain_number) == [8.5, None, None, None]


def test_month_start(spark):
    assert parsed(spark, ["202310", "", "2023-10", None, "202313"], month_start) == [datetime.date(2023, 10, 1), None, None, None, None]


def numbers(spark, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v double")
    return [row.r for row in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_guards(spark):
    assert numbers(spark, [2.0, 0.0, -1.0, None], lambda v: ratio(F.lit(6.0), v)) == [3.0, 0.0, 0.0, 0.0]
    assert numbers(spark, [2.0, None], lambda v: change(F.lit(5.0), v)) == [3.0, 0.0]
    assert numbers(spark, [4.0, 0.0, None], lambda v: percent_change(F.lit(5.0), v)) == [25.0, 0.0, 0.0]
    assert numbers(spark, [1.0, 0.0, None], lambda v: flag(v > 0)) == [1, 0, 0]


def test_ladders_on_their_edges(spark):
    levels = numbers(spark, [1e7, 9999999.0, 1e6, 1e5, 99999.0, None], lambda v: by_floor(v, HEAT_LEVELS))
    assert levels == ["爆款", "热门", "热门", "中等", "冷门", "冷门"]
    ranges = numbers(spark, [199999.0, 2e5, 5e5, 8e5, 1.5e6, None], lambda v: by_ceiling(v, WORDS_RANGES))
    assert [r[:2] for r in ranges] == ["短篇", "中篇", "长篇", "超长", "巨著", "巨著"]
    assert numbers(spark, [3.0, 1.0, -1.0], lambda v: first_true([v > 2, v > 0], ["two", "zero", "rest"])) == ["two", "zero", "rest"]


def test_buckets(spark):
    assert numbers(spark, [0.0, 5.0, 99.0, 100.0, -1.0, None], lambda v: in_bucket(v, IP_RULES)) == ["C级", "B级", "SS级", "SSS级", None, None]
    assert numbers(spark, [1e5], lambda v: in_bucket(v, HEAT_RULES)) == ["中等"]
    authors = numbers(spark, [1.0, 2.0, 4.0, 5.0, 9.0, 10.0], lambda v: in_bucket(v, AUTHOR_RULES, closed="both"))
    assert authors == ["新人作家", "新锐作家", "新锐作家", "资深作家", "资深作家", "高产作家"]
    with pytest.raises(ValueError):
        in_bucket(F.lit(1), IP_RULES, closed="right")
