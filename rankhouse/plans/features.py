"""The eight feature tables. Input: cleaned observations, unique by (book, date); output columns are a fixed contract.

Every per-book window and per-book group uses the book id as its partitioning, so on a layer bucketed by it (see
``rankhouse.sources.tables``) they need no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rankhouse.fixed_values import (
    ADAPTATIONS,
    ATTENUATION_TYPES,
    HEAT_LEVELS,
    INVESTMENT_ADVICE,
    INVESTMENT_LEVELS,
    IP_TYPES,
    IP_VALUE_LEVELS,
    POPULARITY_STEPS,
    PURCHASING_RATINGS,
    RECOMMENDATION_LEVELS,
    RISK_ADVICE,
    RISK_LEVELS,
    RISK_WEIGHTS,
    SERIALISING,
    STICKINESS_LEVELS,
    WORDS_RANGES,
    AttenuationRules,
    HeatRules,
    LongTermRules,
    PitfallRules,
    PurchasingRules,
    ReasonRules,
    RecommendationRules,
    TrendRules,
)
from rankhouse.functions.expressions import (
    by_ceiling,
    by_floor,
    change,
    first_true,
    flag,
    percent,
    percent_change,
    ratio,
)
from rankhouse.functions.parsing import plain_number
from rankhouse.operators.stats import with_dense_ranks, with_group_stats
from rankhouse.operators.windows import history, is_newest, latest, lifetime, newest_per_book, peak_date, previous
from rankhouse.schema import METRICS
from rankhouse.sources.staging import materialize

# Input columns and groups of the feature tables.
HEAT_INPUT = (
    "book_id", "title", "author", "category1_name", "category2_name", "rank_name",
    "rank_date", "created_at", "numeric_popularity", "numeric_read_count", "numeric_score", "status",
    "gender_type",
)
TREND_INPUT = (
    "book_id", "title", "author", "rank_name", "category1_name", "rank_date",
    "numeric_popularity", "numeric_read_count", "numeric_score", "status", "gender_type",
)
RECOMMENDATION_INPUT = (
    "book_id", "title", "author", "category1_name", "category2_name", "gender_type",
    "numeric_popularity", "numeric_score", "numeric_read_count", "status",
)
PITFALL_INPUT = (
    "book_id", "title", "author", "category1_name", "category2_name", "rank_name",
    "gender_type", "numeric_popularity", "numeric_score", "numeric_read_count", "rank_date",
)
REASON_GROUPS = (
    "category1_name", "category2_name", "words_range", "status", "has_hot_keywords", "is_golden_range",
)
ATTENUATION_GROUPS = (
    "book_id", "title", "author", "category1_name", "status", "gender_type",
)
LTV_GROUPS = (
    "book_id", "title", "author", "category1_name", "category2_name", "status",
    "gender_type",
)
PURCHASING_GROUPS = (
    "book_id", "title", "author", "category1_name", "gender_type",
)


def _metrics() -> tuple[Column, Column, Column, Column]:
    """Popularity, read count, score and words."""
    return tuple(F.col(name) for name in METRICS)


# --- platform ---------------------------------------------------------------------------------------------------
def heat_momentum(df: DataFrame) -> DataFrame:
    """Every observation with its previous popularity, growth and acceleration."""
    p, *_ = _metrics()
    timeline = history()
    before = F.col("prev_day_popularity")
    rows = df.withColumn("prev_day_popularity", previous("numeric_popularity", timeline))
    rows = rows.withColumns({"popularity_diff": change(p, before), "popularity_growth_rate": percent_change(p, before)})
    rows = rows.withColumn("prev_popularity_diff", previous("popularity_diff", timeline))
    return rows.withColumn("popularity_acceleration", change(F.col("popularity_diff"), F.col("prev_popularity_diff")))


def heat_walk(df: DataFrame) -> DataFrame:
    """One walk over every book's history: per book and category the sum and count of its growth rates, and, in one category of each book, its newest
    row. Only this one is carried whole to the grouping."""
    rows = heat_momentum(df.select(*HEAT_INPUT))
    newest = F.when(is_newest(history()), F.struct(*rows.columns)).alias("newest")
    steps = rows.select("book_id", "category1_name", F.col("popularity_growth_rate").alias("growth"), newest)
    last = F.max_by("newest", F.col("newest.rank_date")).alias("newest")
    return steps.groupBy("book_id", "category1_name").agg(F.sum("growth").alias("growth"), F.count("growth").alias("steps"), last)


def platform_heat(df: DataFrame, rules: HeatRules = HeatRules(), stage: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Newest observation per book with its momentum against the whole history of its category. ``stage`` writes the walk,
    a few rows per book; snapshot and category averages are both read from it."""
    p, *_ = _metrics()
    walked = stage(heat_walk(df), "heat_walk")
    snapshot = walked.groupBy("book_id").agg(F.max_by("newest", F.col("newest.rank_date")).alias("newest")).select("newest.*")
    averages = {"category_avg_growth_rate": F.try_divide(F.sum("growth"), F.sum("steps"))}
    compared = with_group_stats(snapshot, ["category1_name"], averages, of=walked)
    age = F.datediff("rank_date", "created_at")
    is_new = age <= rules.new_book_days
    if rules.min_new_book_days is not None:
        is_new = is_new & (age >= rules.min_new_book_days)
    is_high = F.col("popularity_growth_rate") > F.col("category_avg_growth_rate")
    return compared.withColumns(
        {
            "is_new_book": flag(is_new),
            "is_high_growth": flag(is_high),
            "is_cold_start_quality": flag(is_new & is_high),
            "heat_level": by_floor(p, HEAT_LEVELS),
        }
    )


def reading_growth(df: DataFrame) -> DataFrame:
    """Every observation with the growth of its read count, followed per book across lists."""
    p, r, *_ = _metrics()
    before = F.col("prev_read_count")
    rows = df.withColumn("prev_read_count", previous("numeric_read_count", history()))
    rows = rows.withColumns({"read_count_growth": change(r, before), "read_count_growth_rate": percent_change(r, before)})
    return rows.withColumn("ranking_conversion_rate", percent(F.col("read_count_growth"), p))


def platform_ranking_trend(df: DataFrame, rules: TrendRules = TrendRules()) -> DataFrame:
    """Newest observation per book and list: does reading follow the rank?"""
    p, _, s, *_ = _metrics()
    rows = reading_growth(df.select(*TREND_INPUT))
    newest = latest(rows, ["book_id", "rank_name"], ["rank_date"])
    growth, conversion = F.col("read_count_growth_rate"), F.col("ranking_conversion_rate")
    capped = F.when(conversion > 0, F.least(conversion / 100, F.lit(1.0))).otherwise(0.0)
    return newest.withColumns(
        {
            "is_unworthy": flag((p > rules.unworthy_popularity) & (growth < rules.unworthy_growth_rate)),
            "is_high_conversion": flag((s >= rules.conversion_score) & (growth > rules.conversion_growth_rate)),
            "recommend_weight": s / 10 * rules.score_weight + capped * rules.conversion_weight,
        }
    )


# --- author -----------------------------------------------------------------------------------------------------
def title_features(df: DataFrame, rules: ReasonRules = ReasonRules()) -> DataFrame:
    """Word-count range, title and keyword features of each row."""
    p, _, _, w = _metrics()
    golden = w.between(*rules.golden_words) & (F.col("status") == SERIALISING)
    return df.withColumns(
        {
            "words_range": by_ceiling(w, WORDS_RANGES),
            "intro_length": F.lit(0),  # the introduction is not kept
            "title_length": F.coalesce(F.length("title"), F.lit(0)),
            "has_hot_keywords": flag(F.col("title").rlike(rules.hot_keywords)),
            "is_golden_range": flag(golden),
            "popularity_level": by_floor(p, POPULARITY_STEPS),
        }
    )


def reason_totals(df: DataFrame, rules: ReasonRules = ReasonRules()) -> DataFrame:
    """Counts and averages per combination of category, length, status and title features."""
    p, _, s, w = _metrics()
    return title_features(df, rules).groupBy(*REASON_GROUPS).agg(
        F.count("book_id").alias("book_count"),
        F.avg(p).alias("avg_popularity"),
        F.avg(s).alias("avg_score"),
        F.avg(w).alias("avg_words"),
        F.avg("intro_length").alias("avg_intro_length"),
        F.avg("title_length").alias("avg_title_length"),
    )


def author_reason(df: DataFrame, rules: ReasonRules = ReasonRules()) -> DataFrame:
    """Average heat by such features over the newest rows; ``df`` may hold these alone."""
    return reason_totals(newest_per_book(df), rules).withColumn("heat_index", F.col("avg_popularity") / rules.heat_unit)


def decay_steps(df: DataFrame, rules: AttenuationRules = AttenuationRules()) -> DataFrame:
    """Every observation with its distance from the book's peak and its loss since the previous one."""
    p, *_ = _metrics()
    life = lifetime()
    rows = df.withColumns(
        {
            "peak_popularity": F.max(p).over(life),
            "prev_popularity": previous("numeric_popularity", history()),
            "days_from_peak": F.datediff("rank_date", peak_date("numeric_popularity", life)),
        }
    )
    peak, before, rate = F.col("peak_popularity"), F.col("prev_popularity"), F.col("attenuation_rate")
    rows = rows.withColumns({"attenuation_rate": percent(peak - p, peak), "attenuation_speed": percent(before - p, before)})
    return rows.withColumns(
        {
            "is_severe_attenuation": flag(rate >= rules.severe_rate),
            "is_moderate_attenuation": flag(rate.between(rules.moderate_rate, rules.severe_rate)),
        }
    )


def attenuation_totals(df: DataFrame, rules: AttenuationRules = AttenuationRules()) -> DataFrame:
    """Extremes and averages of the decay. The peak belongs to the book, the other figures to the group."""
    p, _, s, *_ = _metrics()
    return decay_steps(df, rules).groupBy(*ATTENUATION_GROUPS).agg(
        F.max("peak_popularity").alias("peak_popularity"),
        F.min(p).alias("lowest_popularity"),
        F.avg("attenuation_rate").alias("avg_attenuation_rate"),
        F.avg("attenuation_speed").alias("avg_attenuation_speed"),
        F.max("days_from_peak").alias("lifecycle_days"),
        F.avg(s).alias("avg_score"),
        F.max("is_severe_attenuation").alias("has_severe_attenuation"),
    )


def author_attenuation_effect(df: DataFrame, rules: AttenuationRules = AttenuationRules()) -> DataFrame:
    """How far and how fast a book's heat fell; a book whose status changed has one row per status."""
    return attenuation_of(attenuation_totals(df, rules), rules)


def attenuation_of(totals: DataFrame, rules: AttenuationRules = AttenuationRules()) -> DataFrame:
    """The same from the totals."""
    peak = F.col("peak_popularity")
    effect = totals.withColumn("total_attenuation", percent(peak - F.col("lowest_popularity"), peak))
    return effect.withColumns(
        {
            "attenuation_type": by_ceiling(F.col("total_attenuation"), ATTENUATION_TYPES),
            "recommended_new_book_days": ratio(F.lit(rules.target_percent), F.col("avg_attenuation_speed"), rules.default_days),
        }
    )


# --- reader -----------------------------------------------------------------------------------------------------
def heat_ranks(df: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Rows with their heat rank inside (category, gender) and (category, subcategory, gender), and the category's average."""
    category = ["category1_name", "gender_type"]
    levels = {"category_heat_rank": category, "subcategory_heat_rank": ["category1_name", "category2_name", "gender_type"]}
    return with_dense_ranks(df, levels, "numeric_popularity", averages={"category_heat_rank": "category_avg_popularity"}, stage=stage)


def user_layered_recommendation(
    df: DataFrame, rules: RecommendationRules = RecommendationRules(), stage: Callable[[DataFrame, str], DataFrame] = materialize
) -> DataFrame:
    """Books that stand out inside their own category and gender. The newest rows are read twice: for the counts that ``stage`` writes,
    and when ranks and averages are joined to them."""
    p, _, s, *_ = _metrics()
    ranked = heat_ranks(newest_per_book(df).select(*RECOMMENDATION_INPUT), stage)
    rank, score = F.col("category_heat_rank"), F.col("niche_recommendation_score")
    kept = ranked.where((rank <= rules.keep_rank) | (s >= rules.keep_score))
    kept = kept.withColumn("relative_heat", ratio(p, F.col("category_avg_popularity")))
    niche = (s >= rules.niche_score) & (p < rules.niche_popularity) & (rank <= rules.niche_rank)
    kept = kept.withColumns(
        {
            "is_niche_hit": flag((rank <= rules.hit_rank) & (s >= rules.hit_score)),
            "is_high_score_niche": flag(niche),
            "niche_recommendation_score": s / 10 * rules.score_weight + F.col("relative_heat") / rules.heat_scale * rules.heat_weight,
        }
    )
    return kept.withColumn("recommendation_level", by_floor(score, RECOMMENDATION_LEVELS))


def user_avoid_pitfalls(df: DataFrame, rules: PitfallRules = PitfallRules()) -> DataFrame:
    """Newest row per book with warnings about bought heat, low scores and low reading."""
    p, r, s, *_ = _metrics()
    rows = newest_per_book(df).select(*PITFALL_INPUT)
    rows = rows.withColumns({"heat_score_ratio": ratio(p, s) / rules.ratio_unit, "read_conversion": percent(r, p)})
    low_score = (p >= rules.low_score_heat) & (s < rules.low_score)
    boosted = (p >= rules.boost_heat) & (s < rules.boost_score)
    unread = (p >= rules.conversion_heat) & (F.col("read_conversion") < rules.conversion_percent)
    warnings = [boosted, low_score, unread]
    return rows.withColumns(
        {
            "is_high_heat_low_score": flag(low_score),
            "is_suspicious_boost": flag(boosted),
            "is_low_conversion": flag(unread),
            "risk_level": first_true(warnings, RISK_LEVELS),
            "recommendation_weight": first_true(warnings, RISK_WEIGHTS),
            "avoidance_advice": first_true(warnings, RISK_ADVICE),
        }
    )


# --- capital ----------------------------------------------------------------------------------------------------
def long_term_totals(df: DataFrame) -> DataFrame:
    p, r, s, w = _metrics()
    return df.groupBy(*LTV_GROUPS).agg(
        F.sum(p).alias("total_heat_integral"),
        F.avg(p).alias("avg_popularity"),
        F.max(p).alias("peak_popularity"),
        F.min(p).alias("lowest_popularity"),
        F.count("*").alias("appearance_count"),
        F.min("rank_date").alias("first_rank_date"),
        F.max("rank_date").alias("latest_rank_date"),
        F.avg(s).alias("avg_score"),
        F.avg(r).alias("avg_read_count"),
        F.avg(w).alias("total_words"),
    )


def capital_ltv(df: DataFrame, rules: LongTermRules = LongTermRules()) -> DataFrame:
    """Accumulated heat, stability and adaptation value per book."""
    return long_term_of(long_term_totals(df), rules)


def long_term_of(totals: DataFrame, rules: LongTermRules = LongTermRules()) -> DataFrame:
    """The same from the totals."""
    average, integral, days = F.col("avg_popularity"), F.col("total_heat_integral"), F.col("lifecycle_days")
    totals = totals.withColumn("lifecycle_days", F.datediff("latest_rank_date", "first_rank_date") + 1)
    totals = totals.withColumns(
        {
            "daily_avg_heat": ratio(integral, days, average),
            "heat_volatility": ratio(F.col("peak_popularity"), average),
            "heat_stability": ratio(F.col("lowest_popularity"), average),
        }
    )
    volatility = F.col("heat_volatility")
    shapes = [
        (volatility > rules.burst_volatility) & (days < rules.burst_days),
        (volatility <= rules.stable_volatility) & (days >= rules.stable_days),
        volatility > rules.stable_volatility,
    ]
    heat, life, score, stability = rules.weights
    value = integral / rules.integral_unit * heat + days / 365 * life + F.col("avg_score") / 10 * score + F.col("heat_stability") * stability
    kind = F.col("ip_type")
    totals = totals.withColumns({"ip_type": first_true(shapes, IP_TYPES), "ltv_score": value})
    return totals.withColumns(
        {
            "ip_value_level": by_floor(F.col("ltv_score"), IP_VALUE_LEVELS),
            "adaptation_suggestion": first_true([kind == name for name in IP_TYPES[:-1]], ADAPTATIONS),
        }
    )


def paying_rows(df: DataFrame, rules: PurchasingRules = PurchasingRules()) -> DataFrame:
    """Every observation with its spending indicators and labels."""
    p, r, s, *_ = _metrics()
    arpu, paid, quality = F.col("arpu_indicator"), F.col("is_payment_rank"), F.col("fan_quality_index")
    rows = df.withColumns(
        {
            "arpu_indicator": ratio(p, r),
            "is_payment_rank": flag(F.col("rank_name").rlike(rules.payment_lists)),
            "rank_number": F.when(F.col("number").isNull(), F.lit(float(rules.missing_position))).otherwise(plain_number(F.col("number"))),
        }
    )
    leading = (paid == 1) & (F.col("rank_number") <= rules.top_position)
    high = (arpu > rules.high_arpu) & (paid == 1)
    rows = rows.withColumns({"fan_quality_index": F.when(leading, arpu * rules.payment_boost).otherwise(arpu), "is_high_arpu": flag(high)})
    ratings = [high & (s >= rules.good_score), high, arpu > rules.medium_arpu]
    return rows.withColumns(
        {
            "fan_stickiness_level": by_floor(quality, STICKINESS_LEVELS),
            "purchasing_power_rating": first_true(ratings, PURCHASING_RATINGS),
        }
    )


def purchasing_totals(df: DataFrame, rules: PurchasingRules = PurchasingRules()) -> DataFrame:
    """Averages, maxima and counts of the spending indicators per book."""
    p, r, s, *_ = _metrics()
    return paying_rows(df, rules).groupBy(*PURCHASING_GROUPS).agg(
        F.avg("arpu_indicator").alias("avg_arpu"),
        F.max("arpu_indicator").alias("max_arpu"),
        F.avg("fan_quality_index").alias("avg_fan_quality"),
        F.max("is_payment_rank").alias("has_payment_rank"),
        F.max("is_high_arpu").alias("is_high_arpu_book"),
        F.avg(s).alias("avg_score"),
        F.avg(r).alias("avg_read_count"),
        F.avg(p).alias("avg_popularity"),
        F.count("*").alias("appearance_count"),
    )


def capital_future_purchasing_power(df: DataFrame, rules: PurchasingRules = PurchasingRules()) -> DataFrame:
    """Fan loyalty and spending per book."""
    return purchasing_power_of(purchasing_totals(df, rules), rules)


def purchasing_power_of(power: DataFrame, rules: PurchasingRules = PurchasingRules()) -> DataFrame:
    """The same from the totals."""
    arpu_weight, quality_weight, score_weight = rules.weights
    quality, score, high = F.col("avg_fan_quality"), F.col("avg_score"), F.col("is_high_arpu_book") == 1
    value = F.col("avg_arpu") / 100 * arpu_weight + quality / 100 * quality_weight + score / 10 * score_weight
    power = power.withColumn("fan_value_score", value)
    return power.withColumns(
        {
            "investment_value_level": by_floor(F.col("fan_value_score"), INVESTMENT_LEVELS),
            "investment_recommendation": first_true([high & (score >= rules.good_score), high, quality >= rules.loyal_quality], INVESTMENT_ADVICE),
        }
    )


# --- one pass for three tables ----------------------------------------------------------------------------------
def book_totals(df: DataFrame, decay: AttenuationRules = AttenuationRules(), paying: PurchasingRules = PurchasingRules()) -> DataFrame:
    """One pass over the history: sums, counts and extremes per book, title, categories and status, of which the totals of long-term value,
    attenuation and purchasing are made. Their groups are these or coarser ones of the same book."""
    p, r, s, w = _metrics()
    rows = paying_rows(decay_steps(df, decay), paying)
    averaged = {"popularity": p, "read_count": r, "score": s, "words": w, "rate": F.col("attenuation_rate"), "speed": F.col("attenuation_speed")}
    averaged |= {"arpu": F.col("arpu_indicator"), "quality": F.col("fan_quality_index")}
    sums = [part for name, c in averaged.items() for part in (F.sum(c).alias(f"sum_{name}"), F.count(c).alias(f"n_{name}"))]
    highest = {"popularity": p, "peak": F.col("peak_popularity"), "days": F.col("days_from_peak"), "severe": F.col("is_severe_attenuation")}
    highest |= {"arpu": F.col("arpu_indicator"), "payment": F.col("is_payment_rank"), "high_arpu": F.col("is_high_arpu")}
    extremes = [F.max(c).alias(f"max_{name}") for name, c in highest.items()]
    dates = [F.min("rank_date").alias("first_rank_date"), F.max("rank_date").alias("latest_rank_date")]
    return rows.groupBy(*LTV_GROUPS).agg(F.count(F.lit(1)).alias("n"), *sums, *extremes, F.min(p).alias("min_popularity"), *dates)


def _mean(name: str) -> Column:
    """Over the groups that are put together."""
    return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def long_term_from(totals: DataFrame) -> DataFrame:
    """``long_term_totals`` from the totals of books, row by row."""

    def mean(name: str) -> Column:
        return F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}"))

    return totals.select(
        *LTV_GROUPS,
        F.col("sum_popularity").alias("total_heat_integral"),
        mean("popularity").alias("avg_popularity"),
        F.col("max_popularity").alias("peak_popularity"),
        F.col("min_popularity").alias("lowest_popularity"),
        F.col("n").alias("appearance_count"),
        "first_rank_date",
        "latest_rank_date",
        mean("score").alias("avg_score"),
        mean("read_count").alias("avg_read_count"),
        mean("words").alias("total_words"),
    )


def attenuation_from(totals: DataFrame) -> DataFrame:
    """``attenuation_totals`` from the totals of books."""
    return totals.groupBy(*ATTENUATION_GROUPS).agg(
        F.max("max_peak").alias("peak_popularity"),
        F.min("min_popularity").alias("lowest_popularity"),
        _mean("rate").alias("avg_attenuation_rate"),
        _mean("speed").alias("avg_attenuation_speed"),
        F.max("max_days").alias("lifecycle_days"),
        _mean("score").alias("avg_score"),
        F.max("max_severe").alias("has_severe_attenuation"),
    )


def purchasing_from(totals: DataFrame) -> DataFrame:
    """``purchasing_totals`` from the totals of books."""
    return totals.groupBy(*PURCHASING_GROUPS).agg(
        _mean("arpu").alias("avg_arpu"),
        F.max("max_arpu").alias("max_arpu"),
        _mean("quality").alias("avg_fan_quality"),
        F.max("max_payment").alias("has_payment_rank"),
        F.max("max_high_arpu").alias("is_high_arpu_book"),
        _mean("score").alias("avg_score"),
        _mean("read_count").alias("avg_read_count"),
        _mean("popularity").alias("avg_popularity"),
        F.sum("n").alias("appearance_count"),
    )


# --- registry ---------------------------------------------------------------------------------------------------
Feature = Callable[[DataFrame], DataFrame]

FEATURES: dict[str, Feature] = {
    "ads_platform_heat": platform_heat,
    "ads_platform_ranking_trend": platform_ranking_trend,
    "ads_author_reason": author_reason,
    "ads_author_attenuation_effect": author_attenuation_effect,
    "ads_user_layered_recommendation": user_layered_recommendation,
    "ads_user_avoid_pitfalls": user_avoid_pitfalls,
    "ads_capital_ltv": capital_ltv,
    "ads_capital_future_purchasing_power": capital_future_purchasing_power,
}


#: Features that are made of the totals of books, and how.
OVER_TOTALS: dict[str, Feature] = {
    "ads_author_attenuation_effect": lambda totals: attenuation_of(attenuation_from(totals)),
    "ads_capital_ltv": lambda totals: long_term_of(long_term_from(totals)),
    "ads_capital_future_purchasing_power": lambda totals: purchasing_power_of(purchasing_from(totals)),
}

#: Features that look at every book's newest row only; a layer of these rows gives the same result as the whole history.
OVER_NEWEST = frozenset({"ads_author_reason", "ads_user_layered_recommendation", "ads_user_avoid_pitfalls"})


def with_feature(name: str, feature: Feature, features: dict[str, Feature] = FEATURES) -> dict[str, Feature]:
    """A registry with one more feature table; names are unique."""
    if name in features:
        raise ValueError(f"feature {name} exists")
    return {**features, name: feature}
