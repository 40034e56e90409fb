"""Token archive: ids of documents, written by an adaptive context-mixing range coder and read back.

A segment holds whole documents in ascending doc_id order. Its ids are cut into blocks of BLOCK ids; every block is coded
from a reset model and carries a checksum, so it can be read alone, with the segment's head (``decode`` with ``only``). The model mixes three predictions of the next id:
order 0 (the segment's id frequencies, stored in its head), order 1 and order 2 (the id that followed the last one or the
last two ids before, in this block). Orders 1 and 2 get the share of the code space that their hits at the same
confidence have earned so far in the block; order 0 gets the rest. All blocks of a segment are coded side by side, an id of
each at a time, by the same array operations in both directions.

Segments are rows of a Parquet table, written by Spark's own committer, so a lost executor leaves no half file and any store
Spark reaches will do.

Defined results: null text is empty (the end id only); rows of equal doc_id stand in the order of their texts, null doc_ids
come first; an empty table gives an empty archive and no rows."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rankhouse.llm import tokens
from rankhouse.llm.common import id_text, slices
from rankhouse.llm.packing import with_end
from rankhouse.sources.staging import staged_path

BLOCK = 2048  # ids in a block
SEGMENT = 3_000_000  # ids after which a segment is closed, at the end of a document
_SLOTS = 9  # bits of a block's prediction tables, which stay in the processor's cache
_BITS = 16  # bits of order 0, at least: a segment of more different ids takes as many as these need, up to _MOST_BITS
_MOST_BITS = 22
_SHARES = 8  # bits of the shares of the three orders; with those of order 0 they are the code space of an id
_NONE = 4  # confidence of an empty slot
_HALF, _WORD = np.uint64(32), np.uint64(1 << 32)
SCHEMA = "part int, segment int, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"


def _frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, ascending, and frequencies of at least 1 that add up to a power of two."""
    present, counts = np.unique(ids, return_counts=True)
    bits = max(_BITS, (len(present) - 1).bit_length())
    if bits > _MOST_BITS:
        raise ValueError(f"more than {1 << _MOST_BITS} different ids in a segment")
    share = 1 + counts * ((1 << bits) - len(present)) // counts.sum()
    share[np.argmax(share)] += (1 << bits) - share.sum()
    return present, share


class _Mixer:
    """The model of all blocks of a segment, one lane each; rows 0 and 1 of its arrays are orders 1 and 2. ``symbols`` below are
    positions in the list of ids."""

    def __init__(self, lanes: int, share: np.ndarray):
        self.bits = int(share.sum()).bit_length() - 1
        self.space = np.uint64(self.bits + _SHARES)
        self.share = share.astype(np.int32)
        self.below = (np.cumsum(share) - share).astype(np.int32)
        self.symbol_at = np.repeat(np.arange(len(share), dtype=np.int32), share)
        self.table = np.full(2 * lanes << _SLOTS, _NONE, np.int32)  # symbol * 8 + confidence
        self.hits = np.tile(np.array([16, 64, 128, 192, 0, 0, 0, 0], np.int32), 2 * lanes)  # 1/256 by confidence
        self.row = np.arange(2 * lanes).reshape(2, lanes)
        self.slots = self.row << _SLOTS
        self.last = np.zeros(lanes, np.int64)

    def predict(self, n: int) -> None:
        """For the first n lanes: guessed symbols, their widths, the width of a unit of order 0."""
        found = self.table.take(self.slots[:, :n])
        self.guess, self.sure = found >> 3, found & 7
        self.confidence = (self.row[:, :n] << 3) + self.sure
        self.odds = self.hits.take(self.confidence)
        first = self.odds[0] * (256 - self.odds[1]) >> 8
        self.unit = 256 - first - self.odds[1]
        self.width = np.stack([first, self.odds[1]]) << self.bits

    def interval(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the symbols' intervals; remembers which guesses are right."""
        self.right = self.guess == symbol
        start = self.unit * self.below.take(symbol) + (self.width * (self.guess < symbol)).sum(axis=0, dtype=np.int32)
        size = self.unit * self.share.take(symbol) + (self.width * self.right).sum(axis=0, dtype=np.int32)
        return start, size

    def symbol(self, target: np.ndarray) -> np.ndarray:
        """The symbol whose interval holds the target."""
        (one, two), (wide_one, wide_two) = self.guess, self.width
        start = self.unit * self.below.take(self.guess)
        start[0] += wide_two * (two < one)
        start[1] += wide_one * (one < two)
        end = start + self.unit * self.share.take(self.guess) + self.width
        same = one == two
        end[0] += wide_two * same
        end[1] += wide_one * same
        past = target >= end
        inside = (target >= start) & ~past
        rest = target - (self.width * past).sum(axis=0, dtype=np.int32)
        rest[inside[0] | inside[1]] = 0
        return np.where(inside[0], one, np.where(inside[1], two, self.symbol_at.take(rest // self.unit)))

    def learn(self, symbol: np.ndarray, n: int) -> None:
        """After ``interval`` of the same symbols."""
        empty = self.sure == _NONE
        self.hits[self.confidence] = np.where(empty, 0, self.odds + ((self.right * 254 - self.odds) >> 4))
        kept = np.where(self.right, np.minimum(self.sure + 1, 3), self.sure - 1)
        self.table[self.slots[:, :n]] = np.where(empty | (kept < 0), symbol << 3, (self.guess << 3) | kept)
        symbol = symbol.astype(np.int64)
        one = symbol * 0x9E3779B1 & 0xFFFFFFFF
        two = (one + self.last[:n] * 0x85EBCA6B) * 0xC2B2AE35 & 0xFFFFFFFF
        self.slots[0, :n] = self.row[0, :n] << _SLOTS | one >> 32 - _SLOTS
        self.slots[1, :n] = self.row[1, :n] << _SLOTS | two >> 32 - _SLOTS
        self.last[:n] = symbol


def _lanes(total: int) -> tuple[int, np.ndarray]:
    """Number of blocks of ``total`` ids and, by position in a block, how many blocks reach it."""
    lanes = -(-total // BLOCK)
    tail = total - (lanes - 1) * BLOCK
    reach = np.full(min(BLOCK, total), lanes)
    reach[tail:] -= 1
    return lanes, reach


def encode(ids: np.ndarray) -> bytes:
    """Head (counts, id list and frequencies), then sizes and checksums of the blocks, then the blocks."""
    if not len(ids):
        return struct.pack("<QII", 0, 0, 0)
    present, share = _frequencies(ids)
    lanes, reach = _lanes(len(ids))
    padded = np.zeros(lanes * BLOCK, np.int32)
    padded[: len(ids)] = np.searchsorted(present, ids)
    by_step = np.ascontiguousarray(padded.reshape(lanes, BLOCK).T)
    model = _Mixer(lanes, share)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    words, used = np.zeros((lanes, 128), "<u4"), np.zeros(lanes, np.int64)
    for step, n in enumerate(reach.tolist()):
        symbol = by_step[step, :n]
        model.predict(n)
        start, size = model.interval(symbol)
        unit = span[:n] >> model.space
        moved = low[:n] + unit * start.astype(np.uint64)
        for lane in np.flatnonzero(moved < low[:n]).tolist():  # a carry runs into the words before
            at = used[lane] - 1
            while words[lane, at] == 0xFFFFFFFF:
                words[lane, at] = 0
                at -= 1
            words[lane, at] += 1
        unit *= size.astype(np.uint64)
        low[:n], span[:n] = moved, unit
        out = np.flatnonzero(unit < _WORD)
        words[out, used[out]] = moved[out] >> _HALF
        used[out] += 1
        low[out] <<= _HALF
        span[out] <<= _HALF
        model.learn(symbol, n)
        if step % 32 == 31 and used.max() + 40 > words.shape[1]:
            words = np.concatenate([words, np.zeros_like(words)], axis=1)
    flat = [row[:k].tobytes() + struct.pack("<II", int(x) >> 32, int(x) & 0xFFFFFFFF) for row, k, x in zip(words, used.tolist(), low)]
    raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
    sums = [zlib.crc32(raw[4 * a : 4 * (a + BLOCK)]) for a in range(0, len(ids), BLOCK)]
    head = zlib.compress(np.diff(present, prepend=0).astype("<u4").tobytes() + share.astype("<u4").tobytes())
    table = np.array([[len(b) for b in flat], sums], "<u4").tobytes()
    return struct.pack("<QII", len(ids), len(present), len(head)) + head + table + b"".join(flat)


def decode(payload: bytes, only: int | None = None) -> np.ndarray:
    """The ids of a segment, or of one of its blocks; raises ValueError if a block does not match its checksum."""
    total, kinds, size = struct.unpack_from("<QII", payload)
    if not total:
        return np.zeros(0, "<u4")
    at = struct.calcsize("<QII")
    steps, share = np.frombuffer(zlib.decompress(payload[at : at + size]), "<u4").astype(np.int64).reshape(2, kinds)
    present = np.cumsum(steps).astype("<u4")
    lanes, reach = _lanes(total)
    sizes, sums = np.frombuffer(payload, "<u4", 2 * lanes, at + size).astype(np.int64).reshape(2, lanes)
    stream = np.frombuffer(payload[at + size + 8 * lanes :] + bytes(8), "<u4")
    nxt = (np.cumsum(sizes) - sizes) // 4
    if only is not None:
        total = min(BLOCK, total - only * BLOCK)
        lanes, reach = _lanes(total)
        nxt, sums = nxt[only : only + 1], sums[only : only + 1]
    code = stream[nxt].astype(np.uint64) << _HALF | stream[nxt + 1]
    nxt += 2
    span = np.full(lanes, (1 << 64) - 1, np.uint64)
    model = _Mixer(lanes, share)
    out = np.zeros((len(reach), lanes), np.int32)
    for step, n in enumerate(reach.tolist()):
        model.predict(n)
        unit = span[:n] >> model.space
        symbol = model.symbol(np.minimum(code[:n] // unit, np.uint64((1 << int(model.space)) - 1)).astype(np.int32))
        start, width = model.interval(symbol)
        code[:n] -= unit * start.astype(np.uint64)
        unit *= width.astype(np.uint64)
        span[:n] = unit
        more = np.flatnonzero(unit < _WORD)
        code[more] = code[more] << _HALF | stream[nxt[more]]
        span[more] <<= _HALF
        nxt[more] += 1
        out[step, :n] = symbol
        model.learn(symbol, n)
    ids = present.take(np.ascontiguousarray(out.T).reshape(-1)[:total])
    raw = memoryview(ids.tobytes())
    for block, expected in enumerate(sums.tolist()):
        if zlib.crc32(raw[4 * block * BLOCK : 4 * (block + 1) * BLOCK]) != expected:
            raise ValueError(f"block {block + (only or 0)} does not match its checksum")
    return ids


def write_archive(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every text, append the end id, and write segments in ascending doc_id order to a new folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = tokens.held(tokens.ByteTokens, tokenizer), TaskContext.get().partitionId(), 0
        kept: list[tuple[list, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            names, sizes, ids = ([x for k in kept for x in k[0]], np.concatenate([k[1] for k in kept]), np.concatenate([k[2] for k in kept]))
            return pa.RecordBatch.from_pylist(
                [{"part": part, "segment": number, "n_tokens": len(ids), "doc_ids": names, "lengths": sizes.tolist(), "payload": encode(ids)}],
                pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]),
            )

        for batch in slices(batches, most=tokens.SLICE_BYTES):
            ids, offsets = with_end(*encoder.column(batch.column("text")), end_id)
            kept.append((batch.column("doc_id").to_pylist(), np.diff(offsets), ids))
            if sum(len(k[2]) for k in kept) >= SEGMENT:
                yield close()
                kept, number = [], number + 1
        if kept:
            yield close()

    ordered = id_text(docs).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(run, SCHEMA).write.option("compression", "none").parquet(path)


def read_archive(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, and its ids if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes = decode(row["payload"]), np.array(row["lengths"], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                raw = memoryview(ids.tobytes())
                columns = [
                    pa.array(np.full(len(sizes), row["part"], np.int32)),
                    pa.array(np.full(len(sizes), row["segment"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(offsets[:-1]),
                    pa.array(sizes),
                    pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "part int, segment int, doc_id long, place long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    table = spark.read.schema(SCHEMA).parquet(path)
    sizes = table.select("part", "segment", "n_tokens")
    # one row for each written partition is all that meets in one task
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("parts_before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_tokens")
    before = sizes.withColumn("inside", inside).join(parts, "part").select("part", "segment", (F.col("inside") + F.col("parts_before")).alias("before"))
    rows = table.mapInArrow(run, schema).join(before, ["part", "segment"])
    return rows.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op2_token_archive(docs: DataFrame, tokenizer: str) -> DataFrame:
    path = staged_path(docs.sparkSession, "llm-archive")
    write_archive(docs, path, tokenizer)
    return read_archive(docs.sparkSession, path)
