"""Raw and cleaned facts kept by month. A load replaces the months that it brings; only these are cleaned again.

A row belongs to the month of its date, one without a real date to the month that its month column names. Rows of one book and date therefore
always lie in one month, so months can be cleaned one by one. What cleaning needs to know of all rows, the fill values, the quartiles and which columns
are empty, follows from counts that are kept for each month and added up (as many rows as there are distinct values); one row of
constants made of them is applied when the facts are read.

Both stores log which load brought which month. Cleaning takes the months whose raw load it has not seen and writes its own log last, so
a run that broke off is made good by the next one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from rankhouse.operators.cleaning import REASONS, Removed, corrected, corrections, numeric_rows, score_quality
from rankhouse.schema import METRICS, NEEDED
from rankhouse.sources.staging import exists, observed, remove

MONTH = "load_month"
UNDATED = "undated"
_LOG = f"load bigint, {MONTH} string"
_STATE = "kind string, name string, value double, weight bigint, " + f"{MONTH} string"


def _month_of(date: str, month: str) -> F.Column:
    day = F.date_format(F.col(date).cast("string").try_cast("date"), "yyyyMM")
    named = F.col(month).cast("string")
    return F.coalesce(day, F.when(named != "", named), F.lit(UNDATED))


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A stored table, empty if nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _latest_loads(spark: SparkSession, path: str) -> dict[str, int]:
    """The load that each month was last brought by: a row for each month."""
    log = _read(spark, path, _LOG).groupBy(MONTH).agg(F.max("load").alias("load"))
    return {row[MONTH]: row["load"] for row in log.collect()}


def _note(spark: SparkSession, path: str, loads: dict[str, int]) -> None:
    spark.createDataFrame([(load, month) for month, load in loads.items()], _LOG).coalesce(1).write.mode("append").parquet(path)


@dataclass
class MonthlyRaw:
    """The raw layer, a folder for each month under ``path``; ``month`` is the column that names the month of rows without a date."""

    spark: SparkSession
    path: str
    month: str = "date_month"

    @property
    def log(self) -> str:
        return f"{self.path}_loads"

    def load(self, rows: DataFrame) -> int:
        """Replace the months that occur in the rows by them, and return the number of rows. The hint splits a dominant month over files."""
        seen = Observation()
        placed = rows.withColumn(MONTH, _month_of("rank_date", self.month))
        counted = placed.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(MONTH).alias("months"))  # as many as there are months
        writer = counted.hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)
        number = max(_latest_loads(self.spark, self.log).values(), default=0) + 1
        found = observed(seen)
        if found.get("months"):
            _note(self.spark, self.log, {month: number for month in found["months"]})
        return found.get("rows", 0)

    def stored(self) -> DataFrame:
        """All rows with their month."""
        found = self.spark.read.parquet(self.path).schema  # the folders' names would be read as numbers
        return self.spark.read.schema(T.StructType([f for f in found.fields if f.name != MONTH]).add(MONTH, "string")).parquet(self.path)

    def read(self) -> DataFrame:
        return self.stored().drop(MONTH)

    def loads(self) -> dict[str, int]:
        return _latest_loads(self.spark, self.log)


@dataclass
class MonthlyFacts:
    """Valid, unique, unfilled facts by month in the table ``table`` at ``path``, bucketed by book so that no feature shuffles them, with the counts
    of each month beside them. ``options`` are those of ``clean_all``."""

    spark: SparkSession
    table: str
    path: str
    buckets: int | None = None
    options: dict[str, object] = field(default_factory=dict)

    @property
    def log(self) -> str:
        return f"{self.path}_loads"

    @property
    def state(self) -> str:
        return f"{self.path}_state"

    @property
    def constants(self) -> str:
        return f"{self.path}_constants"

    def _option(self, name: str, default: object) -> object:
        return self.options.get(name, default)

    def follow(self, raw: MonthlyRaw) -> dict[str, int]:
        """Clean the months whose raw rows changed; the rows removed from these, by reason."""
        loads, seen = raw.loads(), _latest_loads(self.spark, self.log)
        pending = sorted(month for month, load in loads.items() if load > seen.get(month, 0))
        if not pending:
            return dict.fromkeys(REASONS, 0)
        removed = self.replace(raw.stored(), pending)
        _note(self.spark, self.log, {month: loads[month] for month in pending})
        return removed

    def replace(self, raw: DataFrame, months: Sequence[str]) -> dict[str, int]:
        """Clean the rows of these months and replace what is stored of them."""
        removed, written = Removed(), Observation()
        arrived = raw.where(F.col(MONTH).isin(*months))
        # the files of a month and bucket come from one task, which holds few of them; a row's month follows from its date
        place = F.struct(MONTH, F.pmod(F.hash("book_id"), F.lit(self._layout())))
        rows = numeric_rows(arrived, self._option("default_unit", 1.0), self._option("tie_breakers", None), removed, place=place)
        if self._option("score_before_filling", False):
            rows = score_quality(rows)
        self._write(rows.select(*(c for c in rows.columns if c != MONTH), MONTH).observe(written, F.collect_set(MONTH).alias("months")))
        for month in set(months) - set(observed(written).get("months", ())):  # nothing valid is left of them
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({MONTH} = '{month}')")
            remove(self.spark, f"{self.path}/{MONTH}={month}")
        self._count(arrived, months)
        self._fix_constants()
        return removed.counts()

    def _known(self) -> bool:
        """Whether there is a table. A catalog that ended with its session is told of the stored files again."""
        if not self.spark.catalog.tableExists(self.table) and self._versions():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(self.path).schema if f.name != MONTH)
            self.spark.sql(
                f"CREATE TABLE {self.table} ({columns}, {MONTH} STRING) USING parquet PARTITIONED BY ({MONTH}) "
                f"CLUSTERED BY (book_id) SORTED BY (book_id, rank_date) INTO {self._constants()['buckets']} BUCKETS LOCATION '{self.path}'"
            )
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        return self.spark.catalog.tableExists(self.table)

    def _layout(self) -> int:
        """The number of buckets, which stays what it was when the first month was written."""
        if self._versions():
            return self._constants()["buckets"]
        return self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> None:
        buckets = self._layout()
        if self._known():
            key = "spark.sql.sources.partitionOverwriteMode"
            before = self.spark.conf.get(key)
            self.spark.conf.set(key, "dynamic")
            try:
                rows.write.insertInto(self.table, overwrite=True)
            finally:
                self.spark.conf.set(key, before)
        else:
            writer = rows.write.format("parquet").option("path", self.path).partitionBy(MONTH).bucketBy(buckets, "book_id").sortBy("book_id", "rank_date")
            writer.saveAsTable(self.table)

    def _count(self, arrived: DataFrame, months: Sequence[str]) -> None:
        """Value counts of the metrics and values in each column that may be dropped, for each of the months."""
        facts = self.spark.table(self.table).where(F.col(MONTH).isin(*months))
        values = facts.select(MONTH, *(F.col(c).cast("double") for c in METRICS)).unpivot([MONTH], list(METRICS), "name", "value")
        counts = values.groupBy(MONTH, "name", "value").agg(F.count(F.lit(1)).alias("weight")).withColumn("kind", F.lit("value"))
        optional = [c for c in arrived.columns if c not in NEEDED and c != MONTH]
        columns = arrived.groupBy(MONTH).agg(*(F.count(F.col(c)).alias(c) for c in optional)).unpivot([MONTH], optional, "name", "weight")
        columns = columns.select(F.lit("column").alias("kind"), "name", F.lit(None).cast("double").alias("value"), "weight", MONTH)
        names = [c.split()[0] for c in _STATE.split(", ")]
        both = counts.select(*names).unionByName(columns.select(*names))
        writer = both.hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.state)

    def merged(self) -> DataFrame:
        """(metric, value, weight) over all months."""
        counts = _read(self.spark, self.state, _STATE).where("kind = 'value'")
        return counts.groupBy(F.col("name").alias("metric"), "value").agg(F.sum("weight").alias("weight"))

    def _fix_constants(self) -> None:
        """What the counts say of all rows, as one row in a folder of its own; the newest folder counts."""
        fill, quartiles = corrections(self.merged(), self._option("fill_strategy", "mean"), self._option("capped", ("numeric_popularity",)))
        columns = _read(self.spark, self.state, _STATE).where("kind = 'column'").groupBy("name").agg(F.sum("weight").alias("n"))
        empty = columns.where("n = 0").agg(F.collect_list("name")).scalar()  # as many as there are columns
        caps = [F.struct(*(q.alias(name) for name, q in quartiles.items())).alias("quartiles")] if quartiles else []
        total = self.merged().where(F.col("metric") == METRICS[0]).agg(F.sum("weight")).scalar()
        row = self.spark.range(1).select(fill.alias("fill"), *caps, empty.alias("empty"), total.alias("n"), F.lit(self._layout()).alias("buckets"))
        row.write.parquet(f"{self.constants}/version={max(self._versions(), default=0) + 1}")
        for version in sorted(self._versions())[:-2]:  # the last but one may still be read
            remove(self.spark, f"{self.constants}/version={version}")

    def _versions(self) -> list[int]:
        if not exists(self.spark, self.constants):
            return []
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.constants)
        listed = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
        found = [(f.getPath().getName(), f.getPath().toString()) for f in listed]
        return [int(name.partition("=")[2]) for name, path in found if name.startswith("version=") and exists(self.spark, f"{path}/_SUCCESS")]

    def _constants(self):
        if not self._versions():
            raise ValueError(f"no month was cleaned into {self.table} yet")
        return self.spark.read.parquet(f"{self.constants}/version={max(self._versions())}").first()

    def rows(self) -> int:
        return self._constants()["n"] or 0 if self._versions() else 0

    def read(self) -> DataFrame:
        """All months, cleaned as ``clean_all`` cleans all rows at once."""
        known = self._constants()
        fill = F.struct(*(F.lit(known["fill"][c]).cast("double").alias(c) for c in METRICS))
        caps = known["quartiles"].asDict() if "quartiles" in known else {}
        missing = F.lit(None).cast("array<double>")
        quartiles = {name: F.array(*(F.lit(q) for q in found)) if found else missing for name, found in caps.items()}
        self._known()
        rows = self.spark.table(self.table).drop(MONTH, *known["empty"])
        return corrected(rows, fill, quartiles, self._option("iqr_multiplier", 3), score=not self._option("score_before_filling", False))
