"""Dashboard and report queries over the feature tables. Every order has a tie break, so results are stable."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from rankhouse.fixed_values import ADAPTATIONS, INVESTED_IP_LEVELS, TOP_INVESTMENT_LEVEL, HeatRules, PurchasingRules


def _rounded(value: str, digits: int) -> Column:
    return F.coalesce(F.round(value, digits), F.lit(0.0))


# --- dashboard --------------------------------------------------------------------------------------------------
def heat_growth_top(heat: DataFrame, limit: int = 10) -> DataFrame:
    ranked = heat.where(F.col("popularity_growth_rate").isNotNull())
    top = ranked.orderBy(F.desc("popularity_growth_rate"), "book_id").limit(limit)
    return top.select(
        "book_id",
        "title",
        F.col("numeric_popularity").alias("current_heat"),
        F.col("prev_day_popularity").alias("previous_heat"),
        _rounded("popularity_growth_rate", 4).alias("growth_rate"),
    )


def new_book_trend(heat: DataFrame) -> DataFrame:
    """Average heat of new books by date; books without heat do not count."""
    new = heat.where((F.col("is_new_book") == 1) & F.col("rank_date").isNotNull() & (F.col("numeric_popularity") != 0))
    by_date = new.groupBy("rank_date").agg(F.round(F.avg("numeric_popularity"), 2).alias("avg_heat"))
    return by_date.select(F.date_format("rank_date", "yyyy-MM-dd").alias("date"), "avg_heat").orderBy("date")


def category_avg_heat(reason: DataFrame) -> DataFrame:
    """Unweighted mean of the group averages per category."""
    averages = reason.groupBy("category1_name").agg(F.avg("avg_popularity").alias("mean"))
    return averages.select(F.col("category1_name").alias("category"), _rounded("mean", 2).alias("avg_heat"))


def _first(rows: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """All rows, or the first by an order that ranks nothing, for a front end that cannot show them all."""
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def wordcount_vs_heat(ltv: DataFrame, limit: int | None = None) -> DataFrame:
    """Points for a scatter plot: books with both values."""
    points = ltv.where((F.col("total_words") != 0) & (F.col("avg_popularity") != 0))
    return _first(points, limit, "book_id", "title", "status").select(F.col("total_words").alias("word_count"), F.col("avg_popularity").alias("heat"))


def status_heat_compare(ltv: DataFrame) -> DataFrame:
    averages = ltv.where(F.col("status") != "").groupBy("status").agg(F.avg("avg_popularity").alias("mean"))
    return averages.select("status", _rounded("mean", 2).alias("avg_heat"))


def top_books(recommendation: DataFrame, category: str | None = None, limit: int = 5) -> DataFrame:
    books = recommendation if category is None else recommendation.where(F.col("category1_name") == category)
    return books.orderBy(F.desc("numeric_popularity"), "book_id").limit(limit).select(
        "book_id",
        "title",
        F.col("category1_name").alias("category"),
        F.col("numeric_popularity").alias("current_heat"),
        F.col("numeric_score").alias("score"),
    )


def categories(recommendation: DataFrame) -> DataFrame:
    return recommendation.select("category1_name").distinct()


def high_heat_low_score(pitfalls: DataFrame) -> DataFrame:
    return pitfalls.where("is_high_heat_low_score = 1").select(
        "book_id",
        "title",
        F.col("numeric_popularity").alias("heat"),
        F.col("numeric_score").alias("score"),
        F.col("avoidance_advice").alias("advice"),
    )


def ip_value_top(ltv: DataFrame, limit: int = 10) -> DataFrame:
    """A book whose status changed may appear once per status, as in the table itself."""
    top = ltv.orderBy(F.desc("ltv_score"), "book_id", "status").limit(limit)
    return top.select("book_id", "title", _rounded("ltv_score", 2).alias("ip_value"), "ip_value_level", "total_heat_integral")


def payment_power(power: DataFrame, limit: int | None = None) -> DataFrame:
    return _first(power, limit, "book_id", "title").select(
        "book_id",
        "title",
        F.col("avg_arpu").alias("arpu"),
        F.col("avg_fan_quality").alias("fan_quality"),
        F.col("investment_value_level").alias("level"),
    )


# --- documented reports -----------------------------------------------------------------------------------------
def heat_surge_top(heat: DataFrame, as_of: datetime.date | None = None, limit: int = 10, rules: HeatRules = HeatRules()) -> DataFrame:
    """Strongest acceleration among books that surge on a date, by default the newest one in the table."""
    day = heat.agg(F.max("rank_date")).scalar() if as_of is None else F.lit(as_of)
    surging = heat.where((F.col("popularity_growth_rate") >= rules.surge_growth_rate) & (F.col("rank_date") == day))
    top = surging.orderBy(F.desc("popularity_acceleration"), "book_id").limit(limit)
    return top.select("book_id", "title", "category1_name", "popularity_diff", "popularity_acceleration", "rank_date")


def unworthy_report(trend: DataFrame, conversion: float = 0.3, limit: int = 20) -> DataFrame:
    rows = trend.where((F.col("is_unworthy") == 1) & (F.col("ranking_conversion_rate") < conversion))
    top = rows.orderBy("recommend_weight", "book_id", "rank_name").limit(limit)
    return top.select("book_id", "title", "rank_name", "ranking_conversion_rate", "recommend_weight")


def niche_hits(recommendation: DataFrame, gender: str, category: str, limit: int = 10) -> DataFrame:
    hits = recommendation.where((F.col("is_niche_hit") == 1) & (F.col("gender_type") == gender) & (F.col("category1_name") == category))
    top = hits.orderBy(F.desc("niche_recommendation_score"), "book_id").limit(limit)
    return top.select("book_id", "title", "category1_name", "gender_type", "relative_heat", "numeric_score", "niche_recommendation_score")


def ip_investment(ltv: DataFrame, levels: tuple[str, ...] = INVESTED_IP_LEVELS, suggestion: str = ADAPTATIONS[1], limit: int = 20) -> DataFrame:
    rows = ltv.where(F.col("ip_value_level").isin(*levels) & F.col("adaptation_suggestion").like(f"%{suggestion}%"))
    top = rows.orderBy(F.desc("ltv_score"), "book_id", "status").limit(limit)
    return top.select(
        "book_id", "title", "author", "ltv_score", "ip_value_level", "adaptation_suggestion", "total_heat_integral", "lifecycle_days"
    )


def high_arpu_fans(power: DataFrame, level: str = TOP_INVESTMENT_LEVEL, limit: int = 15, rules: PurchasingRules = PurchasingRules()) -> DataFrame:
    rows = power.where((F.col("investment_value_level") == level) & (F.col("avg_arpu") > rules.high_arpu))
    top = rows.orderBy(F.desc("fan_value_score"), "book_id").limit(limit)
    return top.select("book_id", "title", "avg_arpu", "fan_value_score", "investment_value_level", "investment_recommendation")


def dwd_profile(df: DataFrame) -> DataFrame:
    """Size and plausibility of the cleaned layer in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg("numeric_popularity").alias("avg_popularity"),
        F.avg("numeric_score").alias("avg_score"),
    )
