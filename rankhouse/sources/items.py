"""Crawled items as JSON files, one object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def write_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields are written, so every line has all keys."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
