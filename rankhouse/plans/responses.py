"""Crawled responses as tables: flatten list payloads, extract detail fields, merge, unify, find gaps, count."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rankhouse.fixed_values import (
    CRAWL_FIRST_MONTH,
    CRAWL_MONTHS,
    CRAWL_PAGES,
    FEMALE_CHANNEL,
    GENDER_OF_CHANNEL,
    MALE_CHANNEL,
    MONTHLY_LISTS,
    NOT_FOUND,
    REQUEST_FAILED,
    UNDATED_LISTS,
)
from rankhouse.functions.parsing import month_start
from rankhouse.operators.windows import latest
from rankhouse.sources.staging import Scratch, exists, materialize
from rankhouse.sources.tables import append_layer

# Fields of a list entry; is_over becomes status.
BOOK_FIELDS = (
    "book_id", "title", "author", "category1_name", "category2_name", "words_num", "intro", "image_link", "is_over", "number", "unit",
)
LIST_SCHEMA = f"STRUCT<data: STRUCT<table_data: ARRAY<STRUCT<{', '.join(f'{name}: STRING' for name in BOOK_FIELDS)}>>>, msg: STRING>"


def parse_rank_lists(responses: DataFrame, body: str = "body") -> DataFrame:
    """Add ``parsed``, the typed payload; text that is not JSON gives a NULL list."""
    return responses.withColumn("parsed", F.from_json(body, LIST_SCHEMA))


def listed_books(parsed: DataFrame, body: str = "body") -> DataFrame:
    """One row per listed book of parsed responses, with the response's own columns; absent fields become ''."""
    books = parsed.select("*", F.explode("parsed.data.table_data").alias("book"))
    fields = [F.coalesce(F.col("book")[name], F.lit("")).alias("status" if name == "is_over" else name) for name in BOOK_FIELDS]
    return books.select(*(c for c in parsed.columns if c not in (body, "parsed")), *fields)


def without_list(parsed: DataFrame, body: str = "body") -> DataFrame:
    """Parsed responses without a list, with the message they carry."""
    bad = parsed.where("parsed.data.table_data IS NULL")
    return bad.select(*(c for c in parsed.columns if c not in (body, "parsed")), F.coalesce("parsed.msg", F.lit("")).alias("reason"))


def flatten_rank_lists(responses: DataFrame, body: str = "body") -> DataFrame:
    return listed_books(parse_rank_lists(responses, body), body)


def rejected_rank_lists(responses: DataFrame, body: str = "body") -> DataFrame:
    return without_list(parse_rank_lists(responses, body), body)


def split_rank_lists(responses: DataFrame, body: str = "body", stage: Callable[[DataFrame, str], DataFrame] = materialize) -> tuple[DataFrame, DataFrame]:
    """Listed books and rejected responses; every payload is parsed once and the result written by ``stage``."""
    parsed = stage(parse_rank_lists(responses, body).drop(body), "parsed_lists")
    return listed_books(parsed, body), without_list(parsed, body)


# Fields of a book's page, by the class of their element.
DETAIL_PATTERNS = {name: f'<em class="{name}">([^<]*)</em>' for name in ("score", "read_count", "popularity")}


def extract_details(pages: DataFrame, patterns: Mapping[str, str] = DETAIL_PATTERNS, body: str = "html") -> DataFrame:
    """The first group of each pattern, trimmed; a page without a match says so, a request without a page (NULL body)
    is an error."""
    failed = F.col(body).isNull()

    def field(pattern: str):
        found = F.trim(F.regexp_extract(body, pattern, 1))
        text = F.when(found != "", found).otherwise(F.lit(NOT_FOUND))
        return F.when(failed, F.lit(REQUEST_FAILED)).otherwise(text)

    fields = [field(pattern).alias(name) for name, pattern in patterns.items()]
    message = F.when(failed, F.lit("no response")).otherwise(F.lit("")).alias("error_msg")
    return pages.select(*(c for c in pages.columns if c != body), *fields, failed.alias("error"), message)


UPSERT_KEYS = ("gender", "book_id", "rank_name", "date_month")


def upsert_latest(stored: DataFrame, arrived: DataFrame, keys: Sequence[str] = UPSERT_KEYS, arrival: str = "arrival", tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Merge new records into a table: per key, which includes the channel, the one that arrived last wins. Both sides
    carry ``arrival``."""
    return latest(stored.unionByName(arrived), keys, [arrival], tie_breakers)


_MONTH = "month"  # the partition of the stored table; NULL and empty months are "undated"


def store_upsert(path: str, arrived: DataFrame, keys: Sequence[str] = UPSERT_KEYS, arrival: str = "arrival", tie_breakers: Sequence[str] = (), month: str = "date_month") -> int:
    """Merge new records into the table stored by month at ``path`` and return the rows written; ``rankhouse.plans.upserts`` has a store that only
    appends. Only the months that arrived
    are read and rewritten, because the month is part of the key; the others' files stay as they are. What is stored is
    merged with what arrived in a written table first, as files cannot be replaced while they are read."""
    if month not in keys:
        raise ValueError("the month has to be part of the key")
    spark = arrived.sparkSession
    part = F.when(F.coalesce(F.col(month), F.lit("")) == "", F.lit("undated")).otherwise(F.col(month))
    scratch = Scratch(spark)
    try:
        arrived = scratch.write(arrived.withColumn(_MONTH, part), "arrived")
        months = [row[0] for row in arrived.select(_MONTH).distinct().collect()]  # as many as there are months
        merged = arrived
        if exists(spark, path):
            merged = stored_items(spark, path, arrived.schema).where(F.col(_MONTH).isin(months)).unionByName(arrived)
        kept = scratch.write(latest(merged, keys, [arrival], tie_breakers), "upsert")
        return append_layer(kept, path, partition_by=_MONTH, replace_partitions=True)
    finally:
        scratch.remove()


def stored_items(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that ``store_upsert`` keeps; ``schema`` as that of the records, with or without the partition."""
    fields = [f for f in schema.fields if f.name != _MONTH]
    return spark.read.schema(T.StructType([*fields, T.StructField(_MONTH, T.StringType())])).parquet(path)


def known_channels(items: DataFrame, channels: Mapping[str, str] = GENDER_OF_CHANNEL) -> DataFrame:
    """Drop items of an unknown channel."""
    return items.where(F.col("gender").isin(*channels))


def unify_genders(male: DataFrame, female: DataFrame) -> DataFrame:
    """The two channel tables as one fact, dated by the first day of their month."""
    parts = [df.withColumn("gender_type", F.lit(gender)) for df, gender in ((male, "male"), (female, "female"))]
    return parts[0].unionByName(parts[1]).withColumn("rank_date", month_start(F.col("date_month")))


def expected_requests(
    spark: SparkSession,
    *,
    channels: Sequence[str] = (MALE_CHANNEL, FEMALE_CHANNEL),
    monthly: Sequence[str] = MONTHLY_LISTS,
    undated: Sequence[str] = UNDATED_LISTS,
    first_month: str = CRAWL_FIRST_MONTH,
    months: int = CRAWL_MONTHS,
    pages: int = CRAWL_PAGES,
) -> DataFrame:
    """The crawl grid: monthly lists once per month, the others once with an empty month; every page of each."""
    start = F.to_date(F.lit(first_month), "yyyyMM")
    calendar = F.transform(
        F.sequence(start, F.add_months(start, months - 1), F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyyMM")
    )

    def requests(names: Sequence[str], month_array: Column) -> DataFrame:
        channel = spark.range(1).select(F.explode(F.array(*map(F.lit, channels))).alias("gender"))
        listed = channel.select("gender", F.explode(F.array(*map(F.lit, names))).alias("rank_name"))
        dated = listed.select("*", F.explode(month_array).alias("date_month"))
        return dated.select("*", F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("page"))

    return requests(monthly, calendar).unionByName(requests(undated, F.array(F.lit(""))))


def coverage_gaps(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Requests of the grid that no observation answers."""
    keys = ["gender", "rank_name", "date_month", "page"]
    return expected.join(observed.select(*keys).distinct(), keys, "left_anti")


def crawl_stats(items: DataFrame) -> DataFrame:
    """Items by channel and outcome in one row."""
    failed = F.lower(F.col("error").cast("string")) == "true"
    return items.agg(
        F.count_if(F.col("gender") == MALE_CHANNEL).alias("male"),
        F.count_if(F.col("gender") == FEMALE_CHANNEL).alias("female"),
        F.count_if(~F.coalesce(failed, F.lit(False))).alias("success"),
        F.count_if(failed).alias("failed"),
    )
