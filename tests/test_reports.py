from datetime import date

from conftest import values

from rankhouse.plans import reports
from rankhouse.plans.extras import keyword_lift, risk_rules, words_regression
from rankhouse.fixed_values import ReasonRules


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_growth_top(spark):
    schema = "book_id string, title string, numeric_popularity double, prev_day_popularity double, popularity_growth_rate double"
    heat = frame(spark, schema, ("b", "t", 3.0, 2.0, 50.123456), ("a", "t", 3.0, 2.0, 50.123456), ("c", "t", 3.0, None, None), ("d", "t", 1.0, 2.0, -50.0))
    top = reports.heat_growth_top(heat, 2).collect()
    assert [(r.book_id, r.growth_rate) for r in top] == [("a", 50.1235), ("b", 50.1235)]


def test_new_book_trend(spark):
    schema = "rank_date date, is_new_book int, numeric_popularity double"
    d1, d2 = date(2024, 1, 2), date(2024, 1, 1)
    heat = frame(spark, schema, (d1, 1, 10.0), (d1, 1, 0.0), (d1, 1, 5.004), (d1, 0, 99.0), (d2, 1, None), (d2, 1, 4.0))
    assert [tuple(r) for r in reports.new_book_trend(heat).collect()] == [("2024-01-01", 4.0), ("2024-01-02", 7.5)]


def test_surges_on_a_given_day(spark):
    schema = "book_id string, title string, category1_name string, rank_date date, popularity_diff double, popularity_acceleration double, popularity_growth_rate double"
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    heat = frame(spark, schema, ("a", "t", "c", d1, 1.0, 5.0, 50.0), ("b", "t", "c", d1, 1.0, 9.0, 49.9), ("c", "t", "c", d2, 1.0, 1.0, 80.0))
    assert values(reports.heat_surge_top(heat), "book_id") == [("c",)]
    assert values(reports.heat_surge_top(heat, as_of=d1), "book_id") == [("a",)]


def test_top_books_of_a_category(spark):
    schema = "book_id string, title string, category1_name string, numeric_popularity double, numeric_score double"
    books = frame(spark, schema, ("a", "t", "x", 1.0, 8.0), ("b", "t", "y", 9.0, 8.0), ("c", "t", "x", 1.0, 8.0), ("d", "t", "x", 0.5, 8.0))
    assert [r.book_id for r in reports.top_books(books, limit=2).collect()] == ["b", "a"]
    assert [r.book_id for r in reports.top_books(books, "x", 2).collect()] == ["a", "c"]


def test_averages(spark):
    reason = frame(spark, "category1_name string, avg_popularity double", ("x", 1.0), ("x", 2.0), ("y", None))
    assert values(reports.category_avg_heat(reason), "category", "avg_heat") == [("x", 1.5), ("y", 0.0)]
    ltv = frame(spark, "status string, avg_popularity double", ("s", 1.0), ("", 2.0), (None, 3.0))
    assert values(reports.status_heat_compare(ltv), "status", "avg_heat") == [("s", 1.0)]


def test_investment_reports(spark):
    schema = "book_id string, title string, author string, status string, ltv_score double, ip_value_level string, adaptation_suggestion string, total_heat_integral double, lifecycle_days int"
    good = "适合影视剧、动漫、游戏"
    ltv = frame(spark, schema, ("a", "t", "a", "s", 2.0, "S级", good, 1.0, 99), ("b", "t", "a", "s", 9.0, "SS级", good, 1.0, 99), ("c", "t", "a", "s", 1.0, "A级", "适合短期营销炒作", 1.0, 99))
    assert values(reports.ip_investment(ltv), "book_id") == [("a",)]
    assert values(reports.ip_investment(ltv, levels=("SS级",)), "book_id") == [("b",)]


def test_documented_thresholds(spark):
    rows = frame(spark, "book_id string, title string, numeric_popularity double, numeric_score double", ("a", "t", 3000001.0, 5.9), ("b", "t", 3000000.0, 5.9), ("c", "t", 1e6, 1.0))
    assert values(risk_rules(rows), "book_id", "documented_risk") == [("a", "高风险"), ("b", "可疑"), ("c", "正常")]


def test_lift_and_fit(facts):
    rows = facts(*({"book_id": str(i), "title": "重生" if i < 2 else "x", "numeric_popularity": 100.0 * (i + 1), "numeric_words": 10.0 * i} for i in range(4)))
    (lift,) = keyword_lift(rows, ReasonRules()).collect()
    assert (lift.book_count, lift.keyword_books, lift.category_avg, lift.keyword_avg) == (4, 2, 250.0, 150.0)
    assert abs(lift.keyword_lift + 0.4) < 1e-12
    fits = {r.feature: r for r in words_regression(rows, ReasonRules()).collect()}
    assert abs(fits["numeric_words"].slope - 10.0) < 1e-9 and abs(fits["numeric_words"].correlation - 1.0) < 1e-12
    assert abs(fits["has_hot_keywords"].slope + 200.0) < 1e-9 and fits["title_length"].correlation > -1
