from datetime import date, datetime, timedelta

import pytest
from conftest import values

from rankhouse.fixed_values import HeatRules
from rankhouse.plans import extras, features

DAY = date(2024, 1, 1)


def on(days):
    return DAY + timedelta(days=days)


def series(popularity, step=1, **others):
    return [{"rank_date": on(i * step), "numeric_popularity": float(p), **others} for i, p in enumerate(popularity)]


def one(df):
    (row,) = df.collect()
    return row


def test_heat_momentum_and_snapshot(facts):
    row = one(features.platform_heat(facts(*series([100, 150, 300], created_at=datetime(2023, 12, 31)))))
    assert (row.rank_date, row.prev_day_popularity, row.popularity_diff, row.popularity_growth_rate) == (on(2), 150.0, 150.0, 100.0)
    assert (row.prev_popularity_diff, row.popularity_acceleration) == (50.0, 100.0)
    assert row.category_avg_growth_rate == pytest.approx(50.0)  # over 0, 50 and 100
    assert (row.is_new_book, row.is_high_growth, row.is_cold_start_quality, row.heat_level) == (1, 1, 1, "冷门")


def test_heat_of_a_single_observation_and_zero_before(facts):
    first = one(features.platform_heat(facts({"numeric_popularity": 1e7})))
    assert (first.prev_day_popularity, first.popularity_diff, first.popularity_growth_rate, first.popularity_acceleration) == (None, 0, 0, 0)
    assert (first.heat_level, first.is_new_book, first.is_high_growth) == ("爆款", 0, 0)
    assert one(features.platform_heat(facts(*series([0, 5])))).popularity_growth_rate == 0.0


def test_new_books_may_need_a_lower_bound(facts):
    rows = facts({"created_at": datetime(2025, 1, 1)})
    assert one(features.platform_heat(rows)).is_new_book == 1
    assert one(features.platform_heat(rows, HeatRules(min_new_book_days=0))).is_new_book == 0
    assert one(features.platform_heat(facts({"created_at": datetime(2023, 12, 25, 23)}))).is_new_book == 1
    assert one(features.platform_heat(facts({"created_at": datetime(2023, 12, 24)}))).is_new_book == 0


def test_trend_follows_the_book_and_keeps_each_list(facts):
    rows = facts(
        {"rank_name": "大热", "rank_date": on(0), "numeric_read_count": 100.0, "numeric_popularity": 2e6},
        {"rank_name": "新书", "rank_date": on(1), "numeric_read_count": 150.0, "numeric_popularity": 50.0, "numeric_score": 8.0},
    )
    hot, new = sorted(features.platform_ranking_trend(rows).collect(), key=lambda r: r.rank_date)
    assert (hot.prev_read_count, hot.is_unworthy, hot.recommend_weight) == (None, 1, pytest.approx(0.35))
    assert (new.prev_read_count, new.read_count_growth, new.read_count_growth_rate) == (100.0, 50.0, 50.0)
    assert (new.ranking_conversion_rate, new.is_high_conversion) == (100.0, 1)
    assert new.recommend_weight == pytest.approx(0.9)


def test_reason_groups(facts):
    rows = facts(
        {"book_id": "1", "title": "都市之王", "numeric_words": 5e5, "numeric_popularity": 1e6},
        {"book_id": "2", "title": "重生", "numeric_words": 799999.0, "numeric_popularity": 3e6},
        {"book_id": "3", "title": "山海", "numeric_words": 8e5},
    )
    groups = values(features.author_reason(rows), "words_range", "has_hot_keywords", "is_golden_range", "book_count", "avg_popularity", "avg_title_length", "heat_index")
    assert groups == [("超长篇(80-150万)", 0, 1, 1, 1000.0, 2.0, 0.001), ("长篇(50-80万)", 1, 1, 2, 2000000.0, 3.0, 2.0)]


def test_attenuation(facts):
    row = one(features.author_attenuation_effect(facts(*series([50, 100, 100, 20]))))
    assert (row.peak_popularity, row.lowest_popularity, row.total_attenuation, row.attenuation_type) == (100.0, 20.0, 80.0, "断崖式衰减")
    assert row.lifecycle_days == 2  # counted from the first of the equal peaks
    assert (row.has_severe_attenuation, row.avg_attenuation_rate) == (1, pytest.approx(130 / 4))
    assert row.avg_attenuation_speed == pytest.approx((-100 + 0 + 80) / 4) and row.recommended_new_book_days == 90.0
    falling = one(features.author_attenuation_effect(facts(*series([100, 60]))))
    assert (falling.attenuation_type, falling.recommended_new_book_days) == ("缓慢衰减", pytest.approx(1.0))
    both = features.decay_steps(facts(*series([100, 20]))).where("attenuation_rate = 80")
    assert values(both, "is_severe_attenuation", "is_moderate_attenuation") == [(1, 1)]
    changed = facts(*series([100, 60]), {"rank_date": on(9), "status": "已完结", "numeric_popularity": 10.0})
    assert values(features.author_attenuation_effect(changed), "status", "peak_popularity", "lowest_popularity") == [
        ("已完结", 100.0, 10.0),
        ("连载中", 100.0, 60.0),
    ]


def test_recommendation(facts):
    books = [{"book_id": f"{i:02}", "numeric_popularity": 5e6 - i * 1e5, "numeric_score": 6.0} for i in range(22)]
    books[2] |= {"numeric_popularity": 4e6, "numeric_score": 9.5}  # ties with book 10
    books[21] |= {"numeric_score": 8.5}
    result = {r.book_id: r for r in features.user_layered_recommendation(facts(*books)).collect()}
    assert "20" in result and "21" in result  # rank 20 by dense rank; rank 21 by score
    niche = result["02"]
    assert niche.category_heat_rank == result["10"].category_heat_rank == 10
    assert (niche.is_niche_hit, niche.is_high_score_niche, niche.subcategory_heat_rank) == (1, 0, 10)
    average = sum(b["numeric_popularity"] for b in books) / 22
    assert niche.relative_heat == pytest.approx(4e6 / average)
    assert niche.niche_recommendation_score == pytest.approx(0.95 * 0.7 + 4e6 / average / 5 * 0.3)
    assert (result["00"].recommendation_level, result["21"].is_niche_hit) == ("一般", 0)
    low = facts(*({"book_id": str(i), "numeric_popularity": 4e6 + i, "numeric_score": 9.5} for i in range(7)))
    assert sum(r.is_high_score_niche for r in features.user_layered_recommendation(low).collect()) == 5


@pytest.mark.parametrize(
    "popularity, score, read, level, weight",
    [(1e7, 5.4, 1e7, "高风险", 0.3), (5e6, 5.9, 1e7, "中风险", 0.5), (5e6, 6.0, 4e5, "低风险", 0.7), (5e6, 6.0, 5e5, "正常", 1.0), (0.0, 0.0, 1.0, "正常", 1.0)],
)
def test_pitfalls(facts, popularity, score, read, level, weight):
    rows = facts({"numeric_popularity": popularity, "numeric_score": score, "numeric_read_count": read})
    row = one(features.user_avoid_pitfalls(rows))
    assert (row.risk_level, row.recommendation_weight) == (level, weight)
    assert row.heat_score_ratio == pytest.approx(popularity / score / 1e5 if score else 0)


@pytest.mark.parametrize(
    "popularity, step, kind",
    [([1, 1, 1, 1, 40], 7, "短线爆款"), ([10, 10], 90, "长线稳定"), ([1, 1, 1, 10], 60, "波动型"), ([10, 10], 88, "成长型")],
)
def test_long_term_types(facts, popularity, step, kind):
    row = one(features.capital_ltv(facts(*series(popularity, step))))
    assert row.ip_type == kind and row.appearance_count == len(popularity)
    assert row.adaptation_suggestion == dict(zip(features.IP_TYPES, features.ADAPTATIONS))[kind]


def test_long_term_value(facts):
    row = one(features.capital_ltv(facts(*series([1e7, 3e7], step=364))))
    assert (row.total_heat_integral, row.lifecycle_days, row.daily_avg_heat) == (4e7, 365, pytest.approx(4e7 / 365))
    assert (row.heat_volatility, row.heat_stability) == (1.5, 0.5)
    assert row.ltv_score == pytest.approx(4 * 0.4 + 0.3 + 0.7 * 0.2 + 0.05) and row.ip_value_level == "S级"
    assert one(features.capital_ltv(facts({"numeric_popularity": 0.0}))).heat_volatility == 0.0


def test_purchasing_power(facts):
    paid = {"rank_name": "月票榜", "numeric_popularity": 6000.0, "numeric_score": 8.0}
    row = one(features.capital_future_purchasing_power(facts({**paid, "number": "50"}, {**paid, "number": "51", "rank_date": on(1)})))
    assert (row.avg_arpu, row.avg_fan_quality, row.has_payment_rank, row.is_high_arpu_book) == (60.0, 75.0, 1, 1)
    assert row.fan_value_score == pytest.approx(0.3 + 0.225 + 0.16)
    assert (row.investment_value_level, row.investment_recommendation) == ("B级", "强烈推荐-高付费+高质量")
    none = one(features.capital_future_purchasing_power(facts({"numeric_read_count": 0.0, "number": None})))
    assert (none.avg_arpu, none.investment_recommendation) == (0.0, "观望")


def test_row_labels(facts):
    rows = facts({"rank_name": "打赏榜", "number": "x", "numeric_popularity": 6000.0}, {"number": None, "numeric_popularity": 2500.0})
    labels = features.paying_rows(rows)
    assert values(labels, "rank_number", "fan_stickiness_level", "purchasing_power_rating") == [
        (999.0, "中等", "中等付费潜力"),
        (None, "强", "高付费潜力"),
    ]


def test_registry_takes_new_features():
    extended = features.with_feature("ads_custom_roi", extras.roi)
    assert len(extended) == 9 and "ads_custom_roi" not in features.FEATURES
    with pytest.raises(ValueError):
        features.with_feature("ads_capital_ltv", extras.roi)


def test_features_of_nothing(facts):
    empty = facts({}).where("false")
    for feature in features.FEATURES.values():
        assert feature(empty).count() == 0


def test_features_do_not_depend_on_the_order_of_rows(facts):
    rows = [p for b in range(6) for p in series([b + 1, 5 * b, 7, b * b], book_id=str(b), category1_name=str(b % 2))]
    for name, feature in features.FEATURES.items():
        ordered, shuffled = feature(facts(*rows)), feature(facts(*reversed(rows)).repartition(7, "rank_date"))
        columns = sorted(c for c, kind in ordered.dtypes if kind != "double")
        assert values(ordered, *columns) == values(shuffled, *columns), name


def test_extras(facts):
    rows = facts(*series([10, 20, 40], step=2), {"rank_date": on(10), "status": "已完结", "numeric_popularity": 0.0, "number": "3"})
    assert one(extras.heat_trapezoid(rows)).heat_area == pytest.approx(30 + 60 + 20 * 6)
    assert [v[0] for v in values(extras.days_since_completion(rows), "days_since_completion")] == [-10, -6, -8, 0]
    assert one(extras.ranking_stability(rows)).ranking_stability == pytest.approx(1 - (0.75**0.5) / 1.5)
    ltv = features.capital_ltv(facts(*series([1, 9], step=99)))
    assert one(extras.ltv_log(ltv, coefficient=2.0)).ltv_log_score == pytest.approx(10 * 3 * 2)
