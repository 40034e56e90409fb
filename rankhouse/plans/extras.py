"""Features that are described but not among the eight tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankhouse.fixed_values import FINISHED, ReasonRules
from rankhouse.functions.expressions import first_true, flag, ratio
from rankhouse.functions.parsing import plain_number
from rankhouse.operators.stats import with_group_stats
from rankhouse.plans.features import title_features
from rankhouse.operators.windows import history, latest_per_book, lifetime, previous


def roi(df: DataFrame) -> DataFrame:
    """Popularity per reader of every observation."""
    return df.select(
        "book_id",
        "title",
        "author",
        F.col("numeric_popularity").alias("popularity"),
        F.col("numeric_read_count").alias("read_count"),
        F.col("numeric_score").alias("score"),
        ratio(F.col("numeric_popularity"), F.col("numeric_read_count")).alias("roi_score"),
    )


def ranking_stability(df: DataFrame) -> DataFrame:
    """1 - stddev/mean of a book's list number, per list: 1 is perfectly stable."""
    number = plain_number(F.col("number"))
    spread = df.groupBy("book_id", "rank_name").agg(
        F.count(number).alias("observations"), F.avg(number).alias("avg_number"), F.stddev_pop(number).alias("std_number")
    )
    stability = F.when(F.col("avg_number") > 0, 1 - F.col("std_number") / F.col("avg_number"))
    return spread.select("book_id", "rank_name", "observations", stability.alias("ranking_stability"))


def days_since_completion(df: DataFrame, finished: str = FINISHED) -> DataFrame:
    """Days from a book's first finished observation; NULL for books never finished, negative before."""
    done = F.min(F.when(F.col("status") == finished, F.col("rank_date"))).over(lifetime())
    return df.select("book_id", "rank_date", "status", F.datediff("rank_date", done).alias("days_since_completion"))


def reason_with_category_heat(df: DataFrame, reason: DataFrame) -> DataFrame:
    """Feature groups beside the mean heat of their category's newest rows."""
    averages = {"category_avg_heat": F.avg("numeric_popularity")}
    return with_group_stats(reason, ["category1_name"], averages, of=latest_per_book(df))


def ltv_log(ltv: DataFrame, coefficient: float = 1.0) -> DataFrame:
    """The other long-term formula: integral x (1 + log10 days) x adaptation coefficient."""
    score = F.col("total_heat_integral") * (1 + F.log10(F.col("lifecycle_days").cast("double"))) * coefficient
    return ltv.select("book_id", "title", "status", "total_heat_integral", "lifecycle_days", score.alias("ltv_log_score"))


# The documented risk thresholds, (heat above, score below, label).
RISK_RULES = ((3000000, 6.0, "高风险"), (1000000, 7.0, "可疑"))
NORMAL_RISK = "正常"


def risk_rules(pitfalls: DataFrame, rules=RISK_RULES) -> DataFrame:
    """Risk by the documented thresholds instead of the coded ones."""
    conditions = [(F.col("numeric_popularity") > heat) & (F.col("numeric_score") < score) for heat, score, _ in rules]
    label = first_true(conditions, [label for *_, label in rules] + [NORMAL_RISK])
    return pitfalls.select("book_id", "title", "numeric_popularity", "numeric_score", label.alias("documented_risk"))


def keyword_lift(df: DataFrame, rules: ReasonRules = ReasonRules()) -> DataFrame:
    """Mean heat of books with a hot keyword relative to all books of the subcategory, over the newest rows."""
    rows = latest_per_book(df).withColumn("has_hot_keywords", flag(F.col("title").rlike(rules.hot_keywords)))
    with_keyword = F.when(F.col("has_hot_keywords") == 1, F.col("numeric_popularity"))
    lift = rows.groupBy("category2_name").agg(
        F.count(F.lit(1)).alias("book_count"),
        F.sum("has_hot_keywords").alias("keyword_books"),
        F.avg("numeric_popularity").alias("category_avg"),
        F.avg(with_keyword).alias("keyword_avg"),
    )
    return lift.withColumn("keyword_lift", F.when(F.col("category_avg") > 0, F.col("keyword_avg") / F.col("category_avg") - 1))


def words_regression(df: DataFrame, rules: ReasonRules = ReasonRules()) -> DataFrame:
    """Linear fit of heat on the words and on each title feature, per category, over the newest rows: a row for each category and
    feature. A feature that does not vary has neither slope nor correlation."""
    features = ["numeric_words", "title_length", "has_hot_keywords"]
    rows = title_features(latest_per_book(df), rules).select("category1_name", "numeric_popularity", *(F.col(f).cast("double") for f in features))
    long = rows.unpivot(["category1_name", "numeric_popularity"], features, "feature", "x")
    fit = long.groupBy("category1_name", "feature").agg(
        F.count(F.lit(1)).alias("book_count"),
        F.regr_slope("numeric_popularity", "x").alias("slope"),
        F.when((F.min("x") < F.max("x")) & (F.min("numeric_popularity") < F.max("numeric_popularity")), F.corr("numeric_popularity", "x")).alias("correlation"),
    )
    return fit


def heat_trapezoid(df: DataFrame) -> DataFrame:
    """Area under the heat curve per book, by trapezoids between observations."""
    timeline = history()
    rows = df.withColumns(
        {"_before": previous("numeric_popularity", timeline), "_days": F.datediff("rank_date", previous("rank_date", timeline))}
    )
    area = (F.col("numeric_popularity") + F.col("_before")) / 2 * F.col("_days")
    return rows.groupBy("book_id").agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("heat_area"), F.count(F.lit(1)).alias("observations"))
