"""Layer tables: read by name, replace, append, verify, sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankhouse.sources.staging import write_counted


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def read_layer(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def pass_order(spark: SparkSession) -> None:
    """From now on scans of this session hand on the order of bucketed tables with one file for each bucket."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")


def write_layer(
    df: DataFrame,
    table: str,
    *,
    path: str | None = None,
    bucket_by: str | None = None,
    buckets: int | None = None,
    sort_by: Sequence[str] | None = (),
    placed: bool = False,
) -> int:
    """Replace a layer table and return its rows. Bucketing by the entity lets every later window, group or join on it
    read the table without a shuffle; pick it only where an entity's rows are bounded, as after de-duplication. The number
    of ``buckets`` is the caller's choice of layout; the session's shuffle partitions if not given. Each bucket is one file, sorted by
    the entity and ``sort_by``; with ``pass_order`` windows in that order need no sort either. Rows that are ``placed`` come dealt by the
    entity into as many parts already, by ``repartition`` or from a table with these buckets, and are not shuffled again. With ``sort_by`` None the
    rows of a bucket stay in the order they come in; placed ones are then written as they come, without the sort by bucket."""
    if bucket_by is not None:
        buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if not placed:
            df = df.repartition(buckets, bucket_by)  # one file per bucket

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("overwrite").format("parquet").option("compression", "zstd")
        if path is not None:
            writer = writer.option("path", path)
        if bucket_by is not None:
            writer = writer.bucketBy(buckets, bucket_by)
            writer = writer if sort_by is None else writer.sortBy(bucket_by, *sort_by)
        writer.saveAsTable(table)

    if not placed:
        return write_counted(df, write)
    spark = df.sparkSession
    # Else Spark reads a table by files where no join or window asks for its buckets.
    wanted = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    if sort_by is None:
        wanted["spark.sql.maxConcurrentOutputFileWriters"] = "1"  # a task holds one bucket, so one open file is enough
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        return write_counted(df, write)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def append_layer(df: DataFrame, path: str, *, partition_by: str = "date_month", replace_partitions: bool = False) -> int:
    """Add rows to a partitioned layer. With ``replace_partitions`` the partitions that occur in ``df`` are replaced,
    which makes a repeated load harmless. The rebalance hint splits a dominant partition over several files."""

    def write(rows: DataFrame) -> None:
        writer = rows.write.partitionBy(partition_by)
        if replace_partitions:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        else:
            writer.mode("append").parquet(path)

    return write_counted(df.hint("rebalance", F.col(partition_by)), write)


def verify(target: DataFrame, columns: int = 5) -> DataFrame:
    """Row count and the first columns of a written table: (position, column_name, data_type, row_count)."""
    spark = target.sparkSession
    fields = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(target.schema.fields[:columns])]
    described = spark.createDataFrame(fields, "position int, column_name string, data_type string")
    return described.withColumn("row_count", target.agg(F.count(F.lit(1))).scalar())


def sample(df: DataFrame, fraction: float, keys: Sequence[str] | None = None, seed: int = 0) -> DataFrame:
    """A development sample. With keys the choice depends on the md5 of their text alone: whole entities, the same ones
    each run and in any engine. NULL keys count as empty text; the leading 52 bits decide, so small fractions hold."""
    if keys is None:
        return df.sample(fraction=fraction, seed=seed)
    text = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys), F.lit(str(seed)))
    place = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return df.where(place < int(fraction * 16**13))
