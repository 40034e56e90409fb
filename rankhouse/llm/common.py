"""Helpers the operators share: the input contract, staged tables, Arrow texts as bytes, words, hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankhouse.sources.staging import remove, staged_path

#: Text bytes a task holds in numpy arrays at once; a single longer text is held whole.
SLICE_BYTES = 1 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id long and text string (null: empty), whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def row_text(docs: DataFrame) -> DataFrame:
    """``row``, all columns, and the text beside it only where it has to be cast: ``slices`` takes it out of the row otherwise, so that it crosses to
    the worker once."""
    row = F.struct("*").alias("row")
    return docs.select(row) if docs.schema["text"].dataType.typeName() == "string" else docs.select(row, F.col("text").cast("string").alias("text"))


def with_row_id(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text); equal rows have equal ids."""
    return id_text(docs).select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")


class Stages:
    """Written tables that are dropped together once what was made from them is written itself."""

    def __init__(self) -> None:
        self.written: list[tuple[SparkSession, str]] = []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = staged_path(df.sparkSession, f"llm-{label}")
        self.written.append((df.sparkSession, path))
        return written(df, path)

    def drop(self) -> None:
        while self.written:
            remove(*self.written.pop())


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame as Parquet to the folder all executors share and read it back: lineage ends here, and a lost
    executor costs no recomputation. The shuffle files of the write are removed when it ends, not when the driver's garbage
    happens to be collected."""
    return written(df, staged_path(df.sparkSession, f"llm-{label}"))


def written(df: DataFrame, path: str) -> DataFrame:
    """Write the frame as Parquet to ``path`` and read it back."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds at most ``most`` bytes of the column, or a single row. A text column that is missing is taken
    from inside the column ``row``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        if column not in batch.schema.names:
            batch = batch.append_column(column, pc.struct_field(batch.column("row"), column))
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library

    def _trim(_: int) -> int:
        return 0


def give_back() -> None:
    """Return memory that is free but still held: a worker is used by many stages, and each would keep its largest."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets. Nulls are empty."""
    column = pc.cast(pc.fill_null(column, ""), pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8, high - low, low) if high > low else np.zeros(0, np.uint8)
    return data, offsets - low


def ids_of(batch: pa.RecordBatch, column: str = "doc_id") -> np.ndarray:
    """A long column without nulls as an array."""
    return batch.column(column).to_numpy(zero_copy_only=False)


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (bytes other than space and tab to carriage return, or than those marked in ``outside``;
    never over a text's end), and the position of each text's first word among them (n + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~outside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """1, base, base ** 2 ... of at least n entries; the tables of a slice are kept, longer ones are not."""
    if base not in _powers or len(_powers[base]) < n:
        size = max(n, SLICE_BYTES + 1)
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        table = np.cumprod(factors, dtype=np.uint64)
        if size > 4 * SLICE_BYTES:
            return table
        _powers[base] = table
    return _powers[base]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SpanHashes:
    """64-bit hashes of byte spans; equal bytes give equal hashes in every process."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * _power_table(_MULTIPLIER, n)[:n], out=self.sums[1:])
        self.inverse = _power_table(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, first: np.ndarray, length: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``length`` words in each text, and each window's text. A text with fewer words has one
    window of all its words; one without words has none. ``words``: word hashes; ``first``: as from word_spans."""
    counts = np.diff(first)
    windows = np.where(counts == 0, 0, np.maximum(counts - length + 1, 1))
    owner = np.repeat(np.arange(len(counts)), windows)
    if not len(owner):
        return np.zeros(0, np.uint64), owner
    start = first[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    size = np.minimum(counts[owner], length)
    h = np.full(len(owner), 0x51ED270B, np.uint64) + size.astype(np.uint64)
    for k in range(length):
        inside = k < size
        h = np.where(inside, mixed(h * np.uint64(_MULTIPLIER) + words[np.where(inside, start + k, start)]), h)
    return h, owner
