"""Best-fit packing: planned on the histogram of piece lengths, carried out by rank within each length.

The driver sees one count per length (at most ``capacity`` of them) and plans best-fit decreasing on counts; a plan
entry seats a run of ranks of one length in a run of sequences. Every piece knows its rank within its length without any
sort: a task numbers the pieces of each length it meets, and the counts of the tasks before it are added.

Defined results: null text is empty (one piece, the end id); null doc_ids and repeated rows are packed like others;
an empty table gives no rows; a document of more ids than ``capacity`` is cut into full pieces, the first takes the rest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rankhouse.llm import tokens
from rankhouse.llm.common import id_text, slices, stage

_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each followed by the end id, and the n + 1 offsets of the texts."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts + 1, out=offsets[1:])
    out = np.full(offsets[-1], end_id, "<u4")
    inside = np.ones(len(out), bool)
    inside[offsets[1:] - 1] = False
    out[inside] = ids
    return out, offsets


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """Pieces of at most ``capacity`` ids: the columns of _PIECES, the task's number and the piece's number among those
    of its length in the task, and the ids if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = tokens.held(tokens.ByteTokens, tokenizer), np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in slices(batches, most=tokens.SLICE_BYTES):
            ids, offsets = with_end(*encoder.column(batch.column("text")), end_id)
            size = np.diff(offsets)
            first = (size - 1) % capacity + 1
            n = (size - first) // capacity + 1
            owner = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[owner], capacity)
            raw, at = memoryview(ids.tobytes()), offsets[:-1][owner] + start
            order = np.argsort(length, kind="stable")
            begins = np.searchsorted(length[order], length)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            rank += seen[length] - begins
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [
                batch.column("doc_id").take(pa.array(owner)),
                pa.array(piece.astype(np.int32)),
                pa.array(start),
                pa.array(length.astype(np.int32)),
                pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())], pa.int64()),
                pa.array(np.full(len(owner), part, np.int32)),
                pa.array(rank),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, offsets[-1]).astype(np.int32)), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = _PIECES + ", part int, rank long" + ", ids array<int>" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    return id_text(docs).mapInArrow(run, schema)


def plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Best-fit decreasing on counts[length]: rows (length, first rank, first sequence, pieces a sequence, offset in the
    sequence), ordered by length and rank. Sequences of the same free space are kept as runs, so the plan's size depends on
    the capacity, not on the number of pieces."""
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by free space: runs (first sequence, how many)
    rows, sequences = [], 0
    for length in range(capacity, 0, -1):
        left, rank = int(counts[length]), 0

        def seat(first: int, many: int, space: int) -> None:
            nonlocal left, rank
            each = space // length
            full = min(many, left // each)
            for start, n, take in ((first, full, each), (first + full, min(1, many - full), left - full * each)):
                if n and 0 < take:
                    take = min(take, each)
                    rows.append((length, rank, start, take, capacity - space))
                    free[space - take * length].append((start, n))
                    rank += n * take
                    left -= n * take
                    first, many = start + n, many - n
            if many:
                free[space].append((first, many))

        for space in range(length, capacity):
            runs = free[space]
            while runs and left:
                seat(*runs.pop(), space)
            if not left:
                break
        if left:
            each = capacity // length
            fresh = -(-left // each)
            sequences += fresh
            seat(sequences - fresh, fresh, capacity)
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset there. ``with_ids`` adds the piece's ids."""
    pieces = stage(cut(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    spark = docs.sparkSession
    by_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    by_task = by_task.select("length", "part", before.alias("before"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        histogram[row["length"]] = row["count"]
    table = spark.sparkContext.broadcast(plan(histogram, capacity))

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        key = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            if batch.num_rows:
                length = batch.column("length").to_numpy().astype(np.int64)
                rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
                row = rows[np.searchsorted(key, length << 48 | rank, side="right") - 1]
                place = rank - row[:, 1]
                kept = [batch.column(c) for c in names[:-2]]
                kept += [pa.array(row[:, 2] + place // row[:, 3]), pa.array(row[:, 4] + place % row[:, 3] * length)]
                yield pa.RecordBatch.from_arrays(kept, names=names)

    schema = _PIECES + ", ids array<int>" * with_ids + ", sequence_id long, offset long"
    names = [c.split()[0] for c in schema.split(", ")]
    return pieces.join(by_task, ["length", "part"]).mapInArrow(seat, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that carry their ids; a group holds one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op10_best_fit_packing(docs: DataFrame, tokenizer: str) -> DataFrame:
    packed = pack(docs, tokenizer)
    return packed.withColumn("length", F.col("length").cast("long"))
