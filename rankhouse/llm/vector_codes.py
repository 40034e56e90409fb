"""Vector codes: vectors cut into equal parts, each part written as the number of the nearest entry of its codebook.

Ball k-means, exact in whole numbers. The first assignment lays every part into the ball of an entry and is written once. From then on a
part x of ball i is at a distance r from that ball's entry as it is now; another entry can only be as near if it lies within 2r of
entry i. So a ball's neighbours are the entries within twice its radius, the distance of its farthest part; a part nearer than half the way to the
nearest neighbour is in the stable core and keeps its entry without a comparison; rings around the core, which double in the number of neighbours
that their outer edge reaches, are compared with these neighbours alone. This holds for any ball that a part is said to be in, so
a lost task gives the same codes when it is run again.

Codebooks (parts x entries x components, bounded by parameters) go to every task; each task adds up what it meets, and the sums by part
and entry, as many rows as there are entries, come back. Vectors are never grouped or shuffled; only codes and errors meet their label's sum.

Defined results: rows whose vector is null or has a null, NaN or infinite component are dropped. Vectors of different lengths, of a length that
the parts do not divide, or with a component of 2**23 or more after scaling (squares would not fit) raise an error. Equal vec_ids are rows of their own, the
first entries are taken by vec_id (nulls last), then by components; with fewer rows than entries the codebooks are that small. Null labels are a label.
An empty table gives no rows. Other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from rankhouse.llm.common import Stages, stage

#: Components after scaling stay below this, so that errors of vectors of up to 2**14 components fit a long.
LARGEST = 1 << 23
#: Vectors whose distances a task works out at once.
BLOCK = 16_384
#: Labels up to this number are broadcast with their sums (16 bytes and the label each); more are joined by shuffling.
BROADCAST_LABELS = 50_000
_SALTS = 16


def whole_vectors(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors without null or non-finite components as rows of floor(scale * x), and which rows of the column they are."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column)
    values = pc.cast(flat, pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
    owner = np.repeat(np.flatnonzero(lengths > 0), lengths[lengths > 0])
    good = lengths >= 0
    good[owner[~np.isfinite(values)]] = False
    size = np.unique(lengths[good])
    if len(size) > 1:
        raise ValueError(f"vectors of different lengths: {size.tolist()}")
    whole = np.floor(values[good[owner]] * scale)
    if len(whole) and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"a component of {LARGEST} or more after scaling")
    return whole.astype(np.int64).reshape(int(good.sum()), int(size[0]) if len(size) else 0), np.flatnonzero(good)


def _squares(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all parts (rows) to all entries. Doubles are exact here: every number is whole and below 2**53, else whole numbers
    are used."""
    bound = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 4 * parts.shape[1] * int(bound) ** 2 < 1 << 53 else np.int64
    a, b = parts.astype(kind), entries.astype(kind)
    return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)).astype(np.int64)


class Balls:
    """A part's codebook with the distances between its entries, nearest first."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = _squares(entries, entries)
        np.fill_diagonal(apart, -1)  # an entry comes before its equals
        self.near = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.near, axis=1)
        self.compared = 0  # distances worked out so far

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry (lowest among equals) of each part and its squared distance, by comparing with all entries."""
        squares = _squares(parts, self.entries)
        self.compared += squares.size
        code = squares.argmin(axis=1)
        return code, squares[np.arange(len(code)), code]

    def reassign(self, parts: np.ndarray, ball: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts that are each in a ball, by cores and rings."""
        gap = parts - self.entries[ball]
        square = (gap * gap).sum(axis=1)
        code = ball.copy()
        order = np.argsort(ball, kind="stable")
        edges = np.searchsorted(ball[order], np.arange(len(self.entries) + 1))
        best = square.copy()
        for i in np.flatnonzero(np.diff(edges)):
            members = order[edges[i] : edges[i + 1]]
            # neighbours within twice the distance, the entry itself first; a radius beyond all of them reaches all
            reach = np.searchsorted(self.apart[i], 4 * square[members], side="right")
            low, high = 1, 1 + reach.max(initial=0).item()  # reach 1: the stable core
            while low < high:
                ring = members[(reach > low) & (reach <= 2 * low)]
                low *= 2
                if len(ring):
                    near = np.sort(self.near[i, :low])
                    squares = _squares(parts[ring], self.entries[near])
                    self.compared += squares.size
                    at = squares.argmin(axis=1)
                    code[ring], best[ring] = near[at], squares[np.arange(len(ring)), at]
        return code, best


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Batches put together to blocks of about ``rows`` rows: the more parts of a ball meet, the fewer calls."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= rows:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting = []
    if sum(b.num_rows for b in waiting):
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _written_vectors(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.astype(np.int32).ravel()))


def _read_vectors(batch: pa.RecordBatch, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """vectors as (rows, parts, width) and codes as (rows, parts)."""
    n = batch.num_rows
    vectors = pc.list_flatten(batch.column("vector")).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = pc.list_flatten(batch.column("codes")).to_numpy(zero_copy_only=False).astype(np.int64)
    return vectors.reshape(n, parts, -1 if n and len(vectors) else 0), codes.reshape(n, parts)


def first_entries(vectors: DataFrame, vec_id: str, vector: str, entries: int, parts: int, scale: int) -> np.ndarray:
    """The codebooks to begin with, (parts, entries, width): the parts of the first whole vectors by vec_id. At most ``entries`` rows
    come to the driver."""
    x = F.col("_x")
    whole = vectors.select(F.col(vec_id).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_x"))
    whole = whole.where(x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    taken = [row[0] for row in whole.orderBy(F.asc_nulls_last("_id"), "_x").limit(entries).select("_x").collect()]
    rows, _ = whole_vectors(pa.array(taken, pa.list_(pa.float64())), scale)
    if rows.shape[1] % parts:
        raise ValueError(f"{parts} parts do not divide vectors of {rows.shape[1]} components")
    return rows.reshape(len(rows), parts, -1 if rows.size else 0).transpose(1, 0, 2).copy()


def assign_first(vectors: DataFrame, vec_id: str, vector: str, label: str, books: np.ndarray, scale: int) -> DataFrame:
    """(vec_id, label, vector array<int>, codes array<int>) of the whole vectors: every part compared with all entries."""
    spark, kind = vectors.sparkSession, vectors.schema[label].dataType
    given = spark.sparkContext.broadcast(books)
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", kind)])
    schema = schema.add("vector", T.ArrayType(T.IntegerType())).add("codes", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(book) for book in given.value]
        for batch in _blocks(batches):
            rows, kept = whole_vectors(batch.column("vector"), scale)
            if len(rows) and rows.shape[1] != given.value.shape[0] * given.value.shape[2]:
                raise ValueError("vectors of different lengths")
            cut = rows.reshape(len(rows), len(balls), -1 if rows.size else 0)
            codes = np.stack([b.nearest(cut[:, k])[0] for k, b in enumerate(balls)], axis=1)
            taken = pa.array(kept)
            out = [batch.column("vec_id").take(taken), batch.column("label").take(taken), _written_vectors(rows), _written_vectors(codes)]
            yield pa.RecordBatch.from_arrays(out, names=["vec_id", "label", "vector", "codes"])

    columns = [F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")]
    return vectors.select(*columns).mapInArrow(run, schema)


def entry_sums(assigned: DataFrame, books: np.ndarray, fresh: bool) -> tuple[np.ndarray, np.ndarray]:
    """Component sums (parts, entries, width) and counts (parts, entries) of what is nearest to each entry; with ``fresh`` as the written
    codes say. Tasks return one row for each part and entry that they meet; these are added up by Spark."""
    spark, (parts, entries, width) = assigned.sparkSession, books.shape
    given = spark.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(book) for book in given.value]
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in _blocks(batches):
            vectors, codes = _read_vectors(batch, parts)
            for k, ball in enumerate(balls):
                code = codes[:, k] if fresh else ball.reassign(vectors[:, k], codes[:, k])[0]
                np.add.at(sums[k], code, vectors[:, k])
                counts[k] += np.bincount(code, minlength=entries)
        place = np.flatnonzero(counts.ravel())
        flat = sums.reshape(parts * entries, width)[place]
        columns = [pa.array(place), pa.array(counts.ravel()[place]), *(pa.array(flat[:, c].copy()) for c in range(width))]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["place", "n", *(f"s{c}" for c in range(width))]
    partial = assigned.select("vector", "codes").mapInArrow(run, ", ".join(f"{name} long" for name in names))
    found = partial.groupBy("place").agg(*(F.sum(name).alias(name) for name in names[1:])).collect()  # at most parts * entries rows
    sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
    for row in found:
        counts[row[0]], sums[row[0]] = row[1], row[2:]
    return sums.reshape(parts, entries, width), counts.reshape(parts, entries)


def moved(books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each entry at the floor of the mean of its parts; unused entries stay."""
    used = counts > 0
    return np.where(used[..., None], sums // np.maximum(counts, 1)[..., None], books)


def encode(assigned: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, codes, error) by the final codebooks."""
    given = assigned.sparkSession.sparkContext.broadcast(books)
    schema = T.StructType([assigned.schema["vec_id"], assigned.schema["label"]]).add("code", "string").add("error", "long")
    digits = np.array([f"{i:02x}" for i in range(256)] if books.shape[1] <= 256 else [f"{i:04x}" for i in range(books.shape[1])], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(book) for book in given.value]
        for batch in _blocks(batches):
            vectors, codes = _read_vectors(batch, len(balls))
            found = [ball.reassign(vectors[:, k], codes[:, k]) for k, ball in enumerate(balls)]
            code = sum((digits[c] for c, _ in found), np.full(batch.num_rows, "", object))
            error = sum(e for _, e in found)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)], names=schema.names)

    return assigned.mapInArrow(run, schema)


def with_label_sum(rows: DataFrame, labels: int = BROADCAST_LABELS) -> DataFrame:
    """Add ``label_error``, the error of all rows with an equal label. The sums are broadcast if they are counted to be few; else both sides
    are shuffled by label and salt, so that no label's rows meet in one task."""
    kept = Stages()
    sums = kept.write(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-sums").withColumnRenamed("label", "_label")
    if sums.limit(labels + 1).count() <= labels:
        return rows.join(F.broadcast(sums), rows["label"].eqNullSafe(sums["_label"])).drop("_label")
    copies = sums.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(_SALTS)).cast("int"))
    same = salted["label"].eqNullSafe(copies["_label"]) & (salted["_salt"] == copies["_copy"])
    return salted.join(copies, same).drop("_label", "_copy", "_salt")


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def train(assigned: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after the rounds; the codes that ``assigned`` holds are those of the first one."""
    for k in range(rounds):
        books = moved(books, *entry_sums(assigned, books, fresh=k == 0))
    return books


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of all whole vectors, written, and the codebooks (parts, entries, width)."""
    books = first_entries(vectors, vec_id, vector, entries, parts, scale)
    kept = Stages()
    if not books.shape[1]:  # no whole vector
        schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", vectors.schema[label].dataType)])
        return vectors.sparkSession.createDataFrame([], schema.add("code", "string").add("error", "long")), books
    try:
        assigned = kept.write(assign_first(vectors, vec_id, vector, label, books, scale), "assigned")
        books = train(assigned, books, rounds)
        return stage(encode(assigned, books), "codes"), books
    finally:
        kept.drop()


def op13_vector_codes(embeddings: DataFrame) -> DataFrame:
    codes, books = compress(embeddings)
    rows = with_label_sum(codes)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
