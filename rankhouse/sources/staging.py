"""Intermediate tables in the folder all executors share. A written table cuts the lineage, survives the loss of
executors and lets later passes read only the columns they need."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; without it there is no place that all executors are known to reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing was written to yet."""
    return f"{shared_folder(spark)}/rankhouse_{uuid.uuid4().hex}/{label}"


def observed(seen: Observation) -> dict:
    """The metrics of a frame that was written; none at all where Spark found that no row can come and left the observation out."""
    return seen.get if seen._jo.getRow().size() else {}


def write_counted(df: DataFrame, write) -> int:
    """Run ``write`` on the frame and return the rows written, counted during the write itself."""
    counted = Observation()
    write(df.observe(counted, F.count(F.lit(1)).alias("rows")))
    return observed(counted).get("rows", 0)


class Scratch:
    """Intermediate tables of one run, removed together when it is over."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.last = spark, [], []

    def path(self, label: str = "rows") -> str:
        """A fresh path that belongs to this run."""
        self.paths.append(fresh_path(self.spark, label))
        return self.paths[-1]

    def write(self, df: DataFrame, label: str = "rows") -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def then(self, action: Callable[[], object]) -> None:
        """Something else to be done when the run is over, such as dropping a table."""
        self.last.append(action)

    def remove(self) -> None:
        while self.last:
            self.last.pop()()
        while self.paths:
            remove(self.spark, self.paths.pop())

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        self.remove()


_owners: ContextVar[tuple[Scratch, ...]] = ContextVar("owners of staged tables", default=())


@contextmanager
def owned(spark: SparkSession) -> Iterator[Scratch]:
    """Whatever is staged inside the block, by any operator, is removed at its end, also after a failure. Write the results that
    read it inside the block."""
    with Scratch(spark) as scratch:
        token = _owners.set((*_owners.get(), scratch))
        try:
            yield scratch
        finally:
            _owners.reset(token)


def staged_path(spark: SparkSession, label: str) -> str:
    """A fresh path for an intermediate table. It belongs to the innermost ``owned`` block; outside of any, a result may be read at
    any later time, so the path is removed when the driver ends."""
    owners = _owners.get()
    if owners:
        return owners[-1].path(label)
    path = fresh_path(spark, label)
    store, target = _on_its_store(spark, path)
    store.mkdirs(target.getParent())  # only what is there can be marked
    store.deleteOnExit(target.getParent())
    return path


def materialize(df: DataFrame, label: str = "rows") -> DataFrame:
    """Write the frame as Parquet and read it back."""
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _on_its_store(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _on_its_store(spark, path)
    return store.exists(target)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete what ``fresh_path`` named, with the folder made for it, on whatever file system it lies; False if it was not there."""
    store, target = _on_its_store(spark, path)
    found = store.delete(target, True)
    if target.getParent().getName().startswith("rankhouse_"):
        store.delete(target.getParent(), True)
    return found
