"""A table of the newest record for each key that grows by appending.

Records are stored as they arrive, bucketed by key: a load shuffles and writes its own records and neither reads nor rewrites what is stored. The newest record of a
key is picked when the table is read, within its bucket and without a shuffle. ``compact`` writes the picked records as a new
version; a version counts once it is complete, and the one before is removed then. Loading the same records again changes nothing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rankhouse.operators.windows import latest
from rankhouse.plans.responses import UPSERT_KEYS
from rankhouse.sources.staging import exists, remove, write_counted


@dataclass
class UpsertStore:
    """Records by ``keys`` in tables that begin with ``name``, under ``path``. The last by ``arrival`` wins, then by ascending ``tie_breakers``.
    ``schema`` is that of the records. Within a bucket records are sorted by ``sort_by`` and the keys, so that a filter on these columns skips
    most of a file."""

    spark: SparkSession
    name: str
    path: str
    schema: T.StructType
    keys: Sequence[str] = UPSERT_KEYS
    arrival: str = "arrival"
    tie_breakers: Sequence[str] = ()
    buckets: int | None = None
    sort_by: Sequence[str] = ("date_month",)

    def versions(self) -> list[int]:
        """The complete ones, lowest first: the first is made by the first load."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not exists(self.spark, self.path):
            return []
        store = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in store.listStatus(folder)]
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def _place(self, version: int) -> tuple[str, str]:
        return f"{self.name}_v{version}", f"{self.path}/v{version}"

    def _layout(self, stored: bool) -> int:
        """The number of buckets: what the stored files say, else the caller's choice or the session's shuffle partitions."""
        if stored:
            return self.spark.read.schema("buckets int").parquet(f"{self.path}/layout").agg(F.max("buckets")).first()[0]
        return self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _known(self, version: int) -> str:
        """The version's table; a catalog that ended with its session is told of it again."""
        table, path = self._place(version)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            keys, order = (", ".join(f"`{c}`" for c in names) for names in (self.keys, self._order()))
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({order}) "
                f"INTO {self._layout(stored=True)} BUCKETS LOCATION '{path}'"
            )
        return table

    def _order(self) -> list[str]:
        return list(dict.fromkeys([*self.sort_by, *self.keys]))

    def _append(self, rows: DataFrame, version: int, buckets: int) -> int:
        table, path = self._place(version)
        rows = rows.select(*self.schema.names).repartition(buckets, *self.keys)

        def write(counted: DataFrame) -> None:
            writer = counted.write.format("parquet").mode("append").option("path", path)
            writer.bucketBy(buckets, *self.keys).sortBy(*self._order()).saveAsTable(table)

        return write_counted(rows, write)

    def load(self, arrived: DataFrame) -> int:
        """Add records and return their number."""
        found = self.versions()
        buckets = self._layout(bool(found))
        if not found:
            self.spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/layout")
        else:
            self._known(found[-1])
        return self._append(arrived, found[-1] if found else 1, buckets)

    def stored(self) -> DataFrame:
        """All records, also those that later ones replace."""
        return self.spark.table(self._known(self.versions()[-1]))

    def read(self) -> DataFrame:
        """The newest record of each key."""
        return latest(self.stored(), self.keys, [self.arrival], self.tie_breakers)

    def compact(self) -> int:
        """Keep the newest records alone, and return their number."""
        version = self.versions()[-1]
        remove(self.spark, self._place(version + 1)[1])  # what a compaction that broke off has left
        self.spark.sql(f"DROP TABLE IF EXISTS {self._place(version + 1)[0]}")
        kept = self._append(self.read(), version + 1, self._layout(stored=True))
        self.spark.sql(f"DROP TABLE IF EXISTS {self._place(version)[0]}")
        remove(self.spark, self._place(version)[1])
        return kept
