"""Cleaning operators, each ``DataFrame -> DataFrame``, and their composition."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from rankhouse.fixed_values import (
    DATE_PATTERN,
    INVALID_TITLES,
    LABEL_DEFAULTS,
    NEWLINE_PATTERN,
    QUALITY_WEIGHTS,
    STATUS_CODES,
    URL_PATTERN,
)
from rankhouse.functions.expressions import flag
from rankhouse.functions.parsing import metric_number, plain_number, words_number
from rankhouse.operators.stats import count_fill_values, count_quantiles, fill_values, quantiles, value_counts
from rankhouse.operators.windows import crowds, latest, latest_by_entity, parts_for
from rankhouse.schema import METRIC_SOURCES, METRICS, NEEDED
from rankhouse.sources.staging import materialize, observed

QUARTILES = (0.25, 0.5, 0.75)
SCORED = ("numeric_popularity", "numeric_read_count", "numeric_score")


def drop_column(df: DataFrame, name: str = "intro") -> DataFrame:
    return df.drop(name)


def replace_newlines(df: DataFrame, column: str = "title") -> DataFrame:
    """Each line break becomes one space; a table without the column stays as it is."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.regexp_replace(column, NEWLINE_PATTERN, " "))


def drop_empty_columns(df: DataFrame, protected: Collection[str] = NEEDED) -> DataFrame:
    """Remove columns without any value; ``protected`` ones stay. One pass over the candidate columns only."""
    candidates = [c for c in df.columns if c not in protected]
    if not candidates:
        return df
    filled = df.agg(*(F.count(F.col(c)).alias(c) for c in candidates)).first()
    return df.drop(*(c for c in candidates if filled[c] == 0))


def keep_any_key(df: DataFrame, keys: Sequence[str] = ("book_id", "title", "author")) -> DataFrame:
    """Keep rows where at least one key is present."""
    return df.where(F.coalesce(*(F.col(k).cast("string") for k in keys)).isNotNull())


def drop_bad_keys(df: DataFrame, entity: str = "book_id", date: str = "rank_date", removed: Observation | None = None) -> DataFrame:
    """Drop rows whose id is a URL or NULL, or whose date is not a real yyyy-MM-dd date. With ``removed``, the first
    action on the result also reports ``removed_rows``, without a pass of its own."""
    good = ~F.col(entity).rlike(URL_PATTERN) & _good_dates(date)
    if removed is not None:
        df = df.observe(removed, F.sum(1 - flag(good)).alias("removed_rows"))
    return df.where(good)


def decode_status(df: DataFrame, codes: Mapping[str, str] = STATUS_CODES) -> DataFrame:
    """Known codes become labels, everything else stays."""
    return df.replace(dict(codes), subset=["status"])


def drop_invalid_titles(df: DataFrame, invalid: Sequence[str] = INVALID_TITLES) -> DataFrame:
    """Drop titles that are shifted status codes; a NULL title fails the test as well."""
    return df.where(~F.col("title").isin(*invalid))


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = ("book_id", "rank_date"),
    tie_breakers: Sequence[str] | None = None,
    dealt: tuple[int, Sequence[int], Column | None] | None = None,
) -> DataFrame:
    """One row per key, the last updated one. Default tie break: all other columns by name, so the choice never
    depends on the order of the input. With ``dealt``, the parts, crowded codes and place of ``latest_by_entity``, the rows come dealt so."""
    newest = ("updated_at", "created_at")
    if tie_breakers is None:
        tie_breakers = sorted(set(df.columns) - set(keys) - set(newest))
    if dealt is None:
        return latest(df, keys, newest, tie_breakers)
    return latest_by_entity(df, keys[0], keys, newest, tie_breakers, *dealt)


def parse_metrics(df: DataFrame, default_unit: float = 1.0) -> DataFrame:
    """Add the popularity and read count as numbers. ``default_unit`` scales text that names no unit."""
    return df.withColumns(
        {name: metric_number(F.col(METRIC_SOURCES[name]), default_unit) for name in ("numeric_popularity", "numeric_read_count")}
    )


def parse_score(df: DataFrame) -> DataFrame:
    return df.withColumn("numeric_score", plain_number(F.col("score")))


def parse_words(df: DataFrame) -> DataFrame:
    return df.withColumn("numeric_words", words_number(F.col("words_num")))


def fill_numbers(df: DataFrame, columns: Sequence[str] = METRICS, strategy: str = "mean", method: str = "exact") -> DataFrame:
    """NULL becomes the column's mean (or median, or mode); 0 when the column has no value at all."""
    return _filled(df, columns, fill_values(df, columns, strategy, method))


def _filled(df: DataFrame, columns: Sequence[str], fill: Column) -> DataFrame:
    rows = df.withColumn("_fill", fill)
    return rows.withColumns({c: F.coalesce(F.col(c), F.col("_fill")[c], F.lit(0.0)) for c in columns}).drop("_fill")


def cap_outliers(df: DataFrame, columns: Sequence[str] = ("numeric_popularity",), multiplier: float = 3, method: str = "exact") -> DataFrame:
    """Values beyond the quartiles by more than ``multiplier`` interquartile ranges become the median."""
    return _capped(df, {name: quantiles(df, [name], QUARTILES, method).select("quantiles").scalar() for name in columns}, multiplier)


def _capped(df: DataFrame, quartiles: Mapping[str, Column], multiplier: float) -> DataFrame:
    rows, capped = df, {}
    for name, found in quartiles.items():
        rows = rows.withColumn(f"_{name}", found)
        q = F.col(f"_{name}")
        margin = (q[2] - q[0]) * multiplier
        outside = (F.col(name) < q[0] - margin) | (F.col(name) > q[2] + margin)
        capped[name] = F.when(outside, q[1]).otherwise(F.col(name))
    return rows.withColumns(capped).drop(*(f"_{name}" for name in quartiles))


def fill_labels(df: DataFrame, defaults: Mapping[str, str] = LABEL_DEFAULTS) -> DataFrame:
    return df.fillna({name: label for name, label in defaults.items() if name in df.columns})


def score_quality(df: DataFrame, columns: Sequence[str] = SCORED) -> DataFrame:
    """1.0 for rows with every metric, else 0.5."""
    complete = F.lit(True)
    for name in columns:
        complete = complete & F.col(name).isNotNull()
    return df.withColumn("data_quality_score", F.when(complete, 1.0).otherwise(0.5))


def score_quality_weighted(df: DataFrame, weights: Mapping[str, float] = QUALITY_WEIGHTS) -> DataFrame:
    """Sum of the weights of the metrics present; use it before filling."""
    score = F.lit(0.0)
    for name, weight in weights.items():
        score = score + flag(F.col(name).isNotNull()) * F.lit(weight)
    return df.withColumn("data_quality_score", score)


def _good_dates(date: str) -> Column:
    as_text = F.col(date).cast("string")
    return as_text.rlike(DATE_PATTERN) & as_text.try_cast("date").isNotNull()


def row_rules() -> dict[str, Column]:
    """The row filters in order, by the reason why a row goes; rows for which one is not true go."""
    return {
        "no_key": F.coalesce(*(F.col(k).cast("string") for k in ("book_id", "title", "author"))).isNotNull(),
        "bad_id": ~F.col("book_id").rlike(URL_PATTERN),
        "bad_date": _good_dates("rank_date"),
        "bad_title": ~F.col("title").isin(*INVALID_TITLES),
    }


REASONS = ("no_key", "bad_id", "bad_date", "bad_title", "duplicate")


class Removed:
    """How many rows each rule of the cleaning removes, observed while the rows are written, without a pass of its own. A row counts
    for the first rule that it fails. Tasks that run again because an executor was lost can count twice."""

    def __init__(self) -> None:
        self.before, self.after = Observation(), Observation()

    def watch_rules(self, df: DataFrame) -> DataFrame:
        """With the first rule that a row fails as ``_fails``, which is tested once."""
        fails = F.coalesce(*(F.when(~F.coalesce(good, F.lit(False)), F.lit(reason)) for reason, good in row_rules().items()))
        counts = [F.count_if(F.col("_fails") == reason).alias(reason) for reason in row_rules()]
        return df.withColumn("_fails", fails).observe(self.before, *counts, F.count_if(F.col("_fails").isNull()).alias("passed"))

    def watch_unique(self, df: DataFrame) -> DataFrame:
        return df.observe(self.after, F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """By reason, once the rows were written."""
        found = observed(self.before)
        unique = observed(self.after).get("rows", 0)
        return {reason: found.get(reason, 0) for reason in REASONS} | {"duplicate": found.get("passed", 0) - unique}


def valid_rows(df: DataFrame, removed: Removed | None = None) -> DataFrame:
    """The row filters and the status labels, in order."""
    if removed is not None:
        return removed.watch_rules(df).where("_fails IS NULL").drop("_fails").transform(decode_status)
    return df.transform(keep_any_key).transform(drop_bad_keys).transform(decode_status).transform(drop_invalid_titles)


def numeric_rows(
    df: DataFrame,
    default_unit: float = 1.0,
    tie_breakers: Sequence[str] | None = None,
    removed: Removed | None = None,
    parts: int | None = None,
    place: Column | None = None,
) -> DataFrame:
    """Valid, unique rows with parsed metrics and a DATE, before anything is filled, dealt by book (or ``place``) into ``parts`` (default: as
    many as the rows need). One narrow read of the book ids counts the rows first; those whose id is bad are never dealt, so they make no crowd."""
    rows, crowded = crowds(df.where(row_rules()["bad_id"]), "book_id")
    dealt = (parts or parts_for(df.sparkSession, rows), crowded, place)
    unique = keep_latest(valid_rows(df, removed), tie_breakers=tie_breakers, dealt=dealt)
    if removed is not None:
        unique = removed.watch_unique(unique)
    parsed = unique.transform(parse_metrics, default_unit).transform(parse_score).transform(parse_words)
    return parsed.withColumn("rank_date", F.col("rank_date").cast("date"))


def corrections(counts: DataFrame, fill_strategy: str = "mean", capped: Sequence[str] = ("numeric_popularity",)) -> tuple[Column, dict[str, Column]]:
    """Fill values (one struct) and quartiles by capped metric, as scalar subqueries over the value counts of unfilled rows. For the quartiles what is
    filled in is added to its value."""
    fill = count_fill_values(counts, METRICS, fill_strategy)

    def quartiles(name: str) -> Column:
        own = counts.where(F.col("metric") == name).withColumn("_fill", fill)
        own = own.select("metric", F.coalesce("value", F.col("_fill")[name], F.lit(0.0)).alias("value"), "weight")
        summed = own.groupBy("metric", "value").agg(F.sum("weight").alias("weight"))
        return count_quantiles(summed, QUARTILES).select("quantiles").scalar()

    return fill, {name: quartiles(name) for name in capped}


def corrected(rows: DataFrame, fill: Column, quartiles: Mapping[str, Column], iqr_multiplier: float = 3, score: bool = True) -> DataFrame:
    """Unfilled rows with numbers filled and capped, labels filled and, with ``score``, the quality score."""
    cleaned = fill_labels(_capped(_filled(rows, METRICS, fill), quartiles, iqr_multiplier))
    return score_quality(cleaned) if score else cleaned


def clean_all(
    df: DataFrame,
    *,
    default_unit: float = 1.0,
    tie_breakers: Sequence[str] | None = None,
    fill_strategy: str = "mean",
    capped: Sequence[str] = ("numeric_popularity",),
    iqr_multiplier: float = 3,
    score_before_filling: bool = False,
    stage: Callable[[DataFrame, str], DataFrame] = materialize,
    removed: Removed | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Raw rank facts to cleaned facts. ``stage`` writes the unique rows and then, from one narrow read of them, the value
    counts of the metrics. Fill values come from the counts; the quartiles come from the counts with what is filled in added to
    its value. A second read of the unique rows carries everything out. ``removed`` counts the removed rows while the unique ones are written."""
    rows = numeric_rows(drop_empty_columns(df), default_unit, tie_breakers, removed, parts)
    if score_before_filling:
        rows = score_quality(rows)
    rows = stage(rows, "unique_facts")
    counts = stage(value_counts(rows, METRICS), "value_counts")
    fill, quartiles = corrections(counts, fill_strategy, capped)
    return corrected(rows, fill, quartiles, iqr_multiplier, score=not score_before_filling)
