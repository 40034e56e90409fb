"""The layers in order: raw facts -> ODS -> DWD -> feature tables -> export."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from rankhouse.operators.cleaning import REASONS, Removed, clean_all, drop_column, replace_newlines
from rankhouse.operators.windows import newest_per_book, parts_for
from rankhouse.plans.features import FEATURES, OVER_NEWEST, OVER_TOTALS, Feature, book_totals
from rankhouse.plans.monthly import MonthlyFacts, MonthlyRaw
from rankhouse.schema import METRICS
from rankhouse.sources import jdbc
from rankhouse.sources.staging import Scratch, materialize, owned
from rankhouse.sources.tables import create_database, pass_order, read_layer, write_layer

log = logging.getLogger(__name__)

STEPS = ("ods", "dwd", "ads", "export")
#: What the features over the newest rows read.
NEWEST_COLUMNS = (
    "book_id", "title", "author", "category1_name", "category2_name", "rank_name", "status", "gender_type", "rank_date", *METRICS,
)
OUTCOME = "layer string, ok boolean, rows bigint, seconds double, error string, " + ", ".join(f"removed_{reason} bigint" for reason in REASONS)


@dataclass
class Warehouse:
    """Where the layers live and what runs between them. Without ``connection`` there is nothing to export to.

    ``buckets`` is the layout of the cleaned layer (by book, each bucket sorted by book and date; the session's shuffle partitions if not given)
    and ``connections`` bounds what an export opens at once. With ``append`` raw and cleaned layer are kept by month under ``location``: a load
    replaces the months that it brings, only these are cleaned, and what depends on all rows, the fill values and quartiles, comes from
    counts that are kept for each month."""

    spark: SparkSession
    source: Callable[[], DataFrame]
    database: str = "rankhouse"
    location: str | None = None
    connection: Mapping[str, str] | None = None
    clean_options: Mapping[str, object] = field(default_factory=dict)
    features: Mapping[str, Feature] = field(default_factory=lambda: dict(FEATURES))
    buckets: int | None = None
    connections: int = 8
    append: bool = False
    month: str = "date_month"
    removed: dict[str, int] = field(default_factory=dict, init=False)  # rows that the last cleaning removed, by reason
    run: Scratch | None = field(default=None, init=False)  # what the tables of one run share

    def __post_init__(self) -> None:
        if self.append and self.location is None:
            raise ValueError("layers that are appended to need a location")
        pass_order(self.spark)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def _path(self, name: str) -> str | None:
        return None if self.location is None else f"{self.location}/{name}"

    def _write(self, df: DataFrame, name: str, **options) -> int:
        return write_layer(df, self.table(name), path=self._path(name), **options)

    def _parts(self) -> int:
        """The buckets of tables by book; counting a stored layer reads no column of it."""
        return self.buckets or parts_for(self.spark, self.raw().count())

    def _by_book(self, df: DataFrame, name: str, buckets: int, **options) -> int:
        return self._write(df, name, bucket_by="book_id", buckets=buckets, sort_by=["rank_date"], **options)

    def _stage_by_book(self, scratch: Scratch, buckets: int) -> Callable[[DataFrame, str], DataFrame]:
        """Staging that keeps the unique rows in the buckets they are dealt into, so that they are not shuffled again. Only the layer made of them is
        sorted within its buckets."""

        def stage(rows: DataFrame, label: str) -> DataFrame:
            if label != "unique_facts":
                return materialize(rows, label)
            name = self.table(f"{label}_{uuid.uuid4().hex}")
            scratch.then(lambda: self.spark.sql(f"DROP TABLE IF EXISTS {name}"))
            write_layer(rows, name, path=scratch.path(label), bucket_by="book_id", buckets=buckets, sort_by=None, placed=True)
            return read_layer(self.spark, name)

        return stage

    def _raw_months(self) -> MonthlyRaw:
        return MonthlyRaw(self.spark, self._path("ods_rank_facts"), self.month)

    def _cleaned_months(self) -> MonthlyFacts:
        return MonthlyFacts(self.spark, self.table("dwd_month_facts"), self._path("dwd_month_facts"), self.buckets, dict(self.clean_options))

    def layer(self, name: str) -> DataFrame:
        """A layer as it is stored; of layers that are kept by month all months."""
        if self.append and name == "ods_rank_facts":
            return self._raw_months().read()
        if self.append and name == "dwd_rank_facts":
            return self._cleaned_months().read()
        return read_layer(self.spark, self.table(name))

    def raw(self) -> DataFrame:
        """The raw layer as it is stored."""
        return self.layer("ods_rank_facts")

    def ods(self) -> list[tuple[str, Callable[[], int]]]:
        def build() -> int:
            create_database(self.spark, self.database, self.location)
            rows = replace_newlines(drop_column(self.source()))
            return self._raw_months().load(rows) if self.append else self._write(rows, "ods_rank_facts")

        return [("ods_rank_facts", build)]

    def dwd(self) -> list[tuple[str, Callable[[], int]]]:
        def build() -> int:
            if self.append:
                cleaned = self._cleaned_months()
                self.removed = cleaned.follow(self._raw_months())
                return cleaned.rows()
            removed, buckets = Removed(), self._parts()
            with owned(self.spark) as scratch:
                options = {"stage": self._stage_by_book(scratch, buckets), **self.clean_options}
                facts = clean_all(self.raw(), removed=removed, parts=buckets, **options)
                rows = self._by_book(facts, "dwd_rank_facts", buckets, placed="stage" not in self.clean_options)
            self.removed = removed.counts()
            return rows

        def build_newest() -> int:
            return self._by_book(newest_per_book(self.layer("dwd_rank_facts")).select(*NEWEST_COLUMNS), "dwd_newest_facts", self._parts())

        return [("dwd_rank_facts", build), ("dwd_newest_facts", build_newest)]

    def _totals(self) -> DataFrame | None:
        """The totals of books that several features share, written once in a run and removed at its end; None outside of a run."""
        if self.run is None:
            return None
        name = f"book_totals_{id(self.run)}"
        if not self.spark.catalog.tableExists(self.table(name)):
            self.run.then(lambda: self.spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}"))
            totals = book_totals(self.layer("dwd_rank_facts"))
            write_layer(totals, self.table(name), path=self.run.path("book_totals"), bucket_by="book_id", buckets=self._parts())
        return read_layer(self.spark, self.table(name))

    def ads(self) -> list[tuple[str, Callable[[], int]]]:
        def build(name: str, feature: Feature) -> Callable[[], int]:
            def run() -> int:
                shared = name in OVER_TOTALS and feature is FEATURES[name]  # a feature with rules of its own reads the layer itself
                totals = self._totals() if shared else None
                with owned(self.spark):
                    if totals is not None:
                        return self._write(OVER_TOTALS[name](totals), name)
                    return self._write(feature(self.layer("dwd_newest_facts" if name in OVER_NEWEST else "dwd_rank_facts")), name)

            return run

        return [(name, build(name, feature)) for name, feature in self.features.items()]

    def export(self) -> list[tuple[str, Callable[[], int]]]:
        def build(name: str) -> Callable[[], int]:
            def run() -> int:
                if self.connection is None:
                    raise ValueError("no connection to export to")
                jdbc.export_table(read_layer(self.spark, self.table(name)), self.connection, name, partitions=self.connections)
                return jdbc.row_count(self.spark, self.connection, name)

            return run

        return [(f"export:{name}", build(name)) for name in self.features]


def resolve_step(step: str | int) -> str:
    """A step by name or by its number from 1."""
    name = str(step).lower()
    if name.isdigit() and 1 <= int(name) <= len(STEPS):
        return STEPS[int(name) - 1]
    if name in STEPS:
        return name
    raise ValueError(f"step is one of 1-{len(STEPS)} or {', '.join(STEPS)}")


def run_layers(warehouse: Warehouse, steps: Sequence[str | int] = STEPS) -> DataFrame:
    """Run the steps; a failing table is reported and the following ones still run. One row per table, the cleaned layer's with the
    rows that each rule removed. Whatever the run staged is gone when it returns."""
    outcomes = []
    with owned(warehouse.spark) as warehouse.run:
        try:
            for step in map(resolve_step, steps):
                for name, build in getattr(warehouse, step)():
                    started, warehouse.removed = time.monotonic(), {}
                    try:
                        rows, error = build(), None
                    except Exception as failure:  # reported in the result, later tables go on
                        log.exception("layer %s failed", name)
                        rows, error = None, f"{type(failure).__name__}: {failure}"
                    removed = (warehouse.removed.get(reason) for reason in REASONS)
                    outcomes.append((name, error is None, rows, time.monotonic() - started, error, *removed))
        finally:
            warehouse.run = None
    return warehouse.spark.createDataFrame(outcomes, OUTCOME)
