"""Windows over a book's history, carried from load to load.

What lags and peaks need of the past is one row for each book: its newest value and change, its peak, its sums. A load of later dates reads
this state and its own rows, never the history; only the load's rows are shuffled, as state and walk are bucketed by book. The walk, every row with what
its windows say, is only added to; a peak belongs to the whole history and is joined from the state when the walk is read.

Every load writes a new state and a new part of the walk and is complete when it is noted in the log; parts that are not noted are never read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankhouse.functions.expressions import change, percent_change
from rankhouse.operators.windows import history, previous
from rankhouse.sources.staging import exists, owned, remove
from rankhouse.sources.tables import write_layer

_LOG = "load bigint, newest date, walked bigint"


@dataclass
class BookHistory:
    """The walk of one metric under ``location``, in tables that begin with ``name`` (database.name). Rows are unique by book and date."""

    spark: SparkSession
    name: str
    location: str
    metric: str = "numeric_popularity"
    buckets: int | None = None

    def _table(self, part: str, load: int) -> str:
        return f"{self.name}_{part}_{load}"

    def _path(self, part: str, load: int) -> str:
        return f"{self.location}/{part}/{load}"

    def _log(self) -> list:
        """A row for each load."""
        path = f"{self.location}/log"
        return sorted(self.spark.read.schema(_LOG).parquet(path).collect()) if exists(self.spark, path) else []

    def _write(self, rows: DataFrame, part: str, load: int) -> int:
        return write_layer(rows, self._table(part, load), path=self._path(part, load), bucket_by="book_id", buckets=self._buckets(), sort_by=["rank_date"] if part == "walk" else ())

    def _buckets(self) -> int:
        return self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def state(self) -> DataFrame | None:
        """One row for each book after all loads, or None before the first."""
        log = self._log()
        return self.spark.table(self._table("state", log[-1].load)) if log else None

    def append(self, rows: DataFrame) -> int:
        """Add rows of later dates than any before, and return their number. An earlier date is an error: rebuild from the whole history then."""
        log = self._log()
        rows = rows.select("book_id", "rank_date", F.col(self.metric).alias("value"))
        oldest, newest = rows.agg(F.min("rank_date"), F.max("rank_date")).first()
        if newest is None:
            return 0
        if log and oldest <= log[-1].newest:
            raise ValueError(f"rows of {oldest} after rows of {log[-1].newest}: rebuild from the history")
        load = (log[-1].load if log else 0) + 1
        state = self.state()
        walked = self._write(walk(rows, state, self._buckets()), "walk", load)
        self._write(advance(state, self.spark.table(self._table("walk", load))), "state", load)
        note = self.spark.createDataFrame([(load, newest, walked)], _LOG)
        note.coalesce(1).write.mode("append").parquet(f"{self.location}/log")
        if log:  # the state before is not needed any more
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table('state', log[-1].load)}")
            remove(self.spark, self._path("state", log[-1].load))
        return walked

    def rebuild(self, rows: DataFrame) -> int:
        """Forget all loads and walk the whole history again."""
        for entry in self._log():
            for part in ("walk", "state"):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(part, entry.load)}")
        with owned(self.spark) as scratch:
            kept = scratch.write(rows, "history")  # it may come from the walk itself
            remove(self.spark, self.location)
            return self.append(kept)

    def read(self) -> DataFrame:
        """Every row of all loads with its lags and the peak of its book: (book_id, rank_date, value, previous, diff, growth_rate, previous_diff,
        acceleration, peak, peak_date)."""
        parts = [self.spark.table(self._table("walk", entry.load)) for entry in self._log()]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows.join(self.state().select("book_id", "peak", "peak_date"), "book_id")


def walk(rows: DataFrame, state: DataFrame | None, buckets: int) -> DataFrame:
    """(book_id, rank_date, value) with previous value, difference, growth rate, previous difference and acceleration; what lies before
    the rows comes from the state."""
    rows = rows.repartition(buckets, "book_id")
    if state is not None:
        rows = rows.join(state.select("book_id", "last", "last_diff"), "book_id", "left")
    else:
        rows = rows.withColumns({"last": F.lit(None).cast("struct<value: double>"), "last_diff": F.lit(None).cast("struct<value: double>")})

    def before(column: str, carried: str) -> Column:
        """The value of the row before, which may be NULL; NULL also without such a row."""
        return F.coalesce(previous(f"_{column}", history()), F.col(carried))["value"]

    value, past = F.col("value"), F.col("previous")
    rows = rows.withColumn("_value", F.struct("value"))
    rows = rows.withColumn("previous", before("value", "last"))
    rows = rows.withColumns({"diff": change(value, past), "growth_rate": percent_change(value, past)})
    rows = rows.withColumn("_diff", F.struct(F.col("diff").alias("value")))
    rows = rows.withColumn("previous_diff", before("diff", "last_diff"))
    return rows.select("book_id", "rank_date", "value", "previous", "diff", "growth_rate", "previous_diff", change(F.col("diff"), F.col("previous_diff")).alias("acceleration"))


def _peak_order(value: str, date: str) -> Column:
    """The highest value, the earliest date among equals."""
    return F.struct(F.col(value), -F.unix_date(date))


def advance(state: DataFrame | None, walked: DataFrame) -> DataFrame:
    """The state after a load's walk: books of the load move on, all others stay."""
    newest = F.max_by(F.struct("value", "diff"), "rank_date")
    moved = walked.groupBy("book_id").agg(
        newest.alias("_newest"),
        F.max_by(F.struct("value", "rank_date"), _peak_order("value", "rank_date")).alias("_peak"),
        F.sum("value").alias("total"),
        F.count("value").alias("n_values"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min("rank_date").alias("first_date"),
        F.max("rank_date").alias("last_date"),
    )
    moved = moved.select(
        "book_id",
        F.struct(F.col("_newest")["value"].alias("value")).alias("last"),
        F.struct(F.col("_newest")["diff"].alias("value")).alias("last_diff"),
        F.col("_peak")["value"].alias("peak"),
        F.col("_peak")["rank_date"].alias("peak_date"),
        "total", "n_values", "n_rows", "first_date", "last_date",
    )
    if state is None:
        return moved
    old, new = state.alias("old"), moved.alias("new")
    both = old.join(new, "book_id", "full")
    order = {side: F.struct(F.col(f"{side}.peak"), -F.unix_date(F.col(f"{side}.peak_date"))) for side in ("old", "new")}
    higher = F.col("old.book_id").isNull() | (F.col("new.book_id").isNotNull() & (order["new"] > order["old"]))

    def added(name: str) -> Column:
        parts = [F.col(f"{side}.{name}") for side in ("old", "new")]
        some = F.coalesce(*parts)
        return F.when(some.isNotNull(), sum((F.coalesce(p, F.lit(0)) for p in parts), F.lit(0).cast("bigint"))).alias(name)

    return both.select(
        "book_id",
        *(F.coalesce(f"new.{name}", f"old.{name}").alias(name) for name in ("last", "last_diff")),
        *(F.when(higher, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name) for name in ("peak", "peak_date")),
        *map(added, ("total", "n_values", "n_rows")),
        F.coalesce("old.first_date", "new.first_date").alias("first_date"),
        F.coalesce("new.last_date", "old.last_date").alias("last_date"),
    )
