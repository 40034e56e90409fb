"""Per-entity operators: newest row, previous value, peak.

Cleaned observations are unique by (entity, date), so an entity's window never holds more rows than there are dates,
however many raw rows the entity had. ``latest`` is also safe on raw rows: the plan keeps one row per key and task
(WindowGroupLimit) before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

ROWS_AT_ONCE = 200_000  # rows that a task is to sort: wide ones take some 600 bytes each in memory
_CODES = 1 << 14  # entities are counted by a hash code, so that each task sends a bounded number of counts


def parts_for(spark: SparkSession, rows: int) -> int:
    """Into how many parts so many rows are dealt: the session's shuffle partitions, more where these would not be sorted in memory."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_AT_ONCE))


def latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str], tie_breakers: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest by the ``newest`` columns, NULLs last, ties settled by ascending ``tie_breakers``."""
    order = [F.desc_nulls_last(c) for c in newest] + [F.asc_nulls_last(c) for c in tie_breakers]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def crowds(df: DataFrame, entity: str, at_once: int = ROWS_AT_ONCE) -> tuple[int, list[int]]:
    """The number of rows, and the hash codes of entities that have more of them than a task is to hold (fewer codes than rows / ``at_once``)."""
    codes = df.groupBy(_code(entity).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    many = F.collect_list(F.when(F.col("n") > at_once, F.struct("code", "n"))).alias("many")
    found = codes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), many).first()
    usual = found["rows"] / _CODES
    return found["rows"], sorted(code["code"] for code in found["many"] if code["n"] > 8 * usual)


def _code(entity: str) -> Column:
    return F.pmod(F.xxhash64(entity), F.lit(_CODES))


def latest_by_entity(
    df: DataFrame,
    entity: str,
    keys: Sequence[str],
    newest: Sequence[str],
    tie_breakers: Sequence[str],
    parts: int,
    crowded: Sequence[int] = (),
    place: Column | None = None,
) -> DataFrame:
    """``latest`` for keys that contain the entity; the result stays dealt by the entity into ``parts``, so rows are shuffled once and sorted
    once, in pieces that fit. Rows of ``crowded`` codes are first cut down to one for each key and task. Rows can be dealt by another
    ``place`` that follows from the keys."""
    if crowded:
        many = _code(entity).isin(*crowded)
        df = df.where(~many).unionByName(latest(df.where(many), keys, newest, tie_breakers))
    if place is None:
        return latest(df.repartition(parts, entity), keys, newest, tie_breakers)
    return latest(df.withColumn("_place", place).repartition(parts, "_place"), ["_place", *keys], newest, tie_breakers).drop("_place")


def latest_per_book(df: DataFrame) -> DataFrame:
    return latest(df, ["book_id"], ["rank_date"])


def newest_per_book(df: DataFrame) -> DataFrame:
    """The same for rows that are unique by book and date. It follows the history upwards, as lags do, so a layer sorted by book and date
    needs no sort for either."""
    return df.withColumn("_newest", is_newest(history())).where("_newest").drop("_newest")


def history(entity: str = "book_id", date: str = "rank_date") -> WindowSpec:
    """An entity's observations in date order."""
    return Window.partitionBy(entity).orderBy(date)


def lifetime(entity: str = "book_id", date: str = "rank_date") -> WindowSpec:
    """All observations of an entity. Shares partitioning and order with ``history``, so both need one sort."""
    return history(entity, date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def previous(column: str, over: WindowSpec) -> Column:
    """Value at the preceding observation, not the preceding calendar day."""
    return F.lag(column).over(over)


def is_newest(over: WindowSpec) -> Column:
    """True on the last observation of a history; reuses its sort."""
    return F.lead(F.lit(1)).over(over).isNull()


def peak_date(metric: str, over: WindowSpec, date: str = "rank_date") -> Column:
    """Date of the highest value; the earliest one among equal peaks."""
    return F.max_by(date, F.struct(F.col(metric), -F.unix_date(date))).over(over)
