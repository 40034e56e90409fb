"""JDBC source and export. Connection settings come from the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rankhouse.fixed_values import JDBC_BATCH_SIZE, JDBC_FETCH_SIZE


def read_options(
    connection: Mapping[str, str],
    table: str,
    *,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a table scan. With a numeric partition column the scan runs as that many ranged queries; rows outside
    [lower, upper] are still read, by the first and last one."""
    options = {"fetchsize": str(JDBC_FETCH_SIZE), **connection, "dbtable": table}
    split = {"partitionColumn": partition_column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    given = [name for name, value in split.items() if value is not None]
    if given and len(given) < len(split):
        raise ValueError("a partitioned scan needs partition_column, lower, upper and partitions")
    return options | {name: str(split[name]) for name in given}


def read_table(spark: SparkSession, connection: Mapping[str, str], table: str, **split) -> DataFrame:
    """Scan a table; filters and column selection on the result are pushed into the database."""
    return spark.read.format("jdbc").options(**read_options(connection, table, **split)).load()


def row_count(spark: SparkSession, connection: Mapping[str, str], table: str) -> int:
    """Rows of a table, counted by the database."""
    return int(read_table(spark, connection, f"(SELECT COUNT(*) AS n FROM {table}) counted").first()[0])


def write_options(connection: Mapping[str, str], table: str, *, partitions: int | None = None) -> dict[str, str]:
    options = {"batchsize": str(JDBC_BATCH_SIZE), **connection, "dbtable": table}
    return options if partitions is None else options | {"numPartitions": str(partitions)}


def export_table(df: DataFrame, connection: Mapping[str, str], table: str, *, partitions: int | None = None) -> None:
    """Replace the target table. ``partitions`` bounds the simultaneous connections."""
    df.write.format("jdbc").options(**write_options(connection, table, partitions=partitions)).mode("overwrite").save()
