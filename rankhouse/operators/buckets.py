"""Level rules: which labelled range a value falls into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rankhouse.fixed_values import AUTHOR_RULES, CATEGORY_RULES, HEAT_RULES, IP_RULES
from rankhouse.functions.expressions import in_bucket


def bucket_by_rules(df: DataFrame, column: str, rules: Sequence[tuple], name: str, closed: str = "left") -> DataFrame:
    return df.withColumn(name, in_bucket(F.col(column), rules, closed))


def author_levels(df: DataFrame, rules: Sequence[tuple] = AUTHOR_RULES) -> DataFrame:
    """Authors by number of distinct books. Distinct (author, book) pairs first, so a prolific author is spread out."""
    books = df.select("author", "book_id").distinct().groupBy("author").agg(F.count("book_id").alias("book_count"))
    return bucket_by_rules(books, "book_count", rules, "author_level", closed="both")


def heat_levels(df: DataFrame) -> DataFrame:
    return bucket_by_rules(df, "numeric_popularity", HEAT_RULES, "heat_level")


def ip_levels(ltv: DataFrame) -> DataFrame:
    return bucket_by_rules(ltv, "ltv_score", IP_RULES, "ip_potential_level")


def category_levels(df: DataFrame) -> DataFrame:
    averages = df.groupBy("category1_name").agg(F.avg("numeric_popularity").alias("avg_popularity"))
    return bucket_by_rules(averages, "avg_popularity", CATEGORY_RULES, "category_level")
