"""Exact removal of repeated passages: every byte covered by a LENGTH-byte string that also starts anywhere else.

A corpus has no suffix array on one machine, so it is parsed first. The anchor of a window of LENGTH bytes is its
GRAM-byte string of the smallest hash (the first of equals); neighbouring windows mostly share one. The windows that share an
anchor form a fragment, the bytes they cover. Equal windows have equal anchors at equal places, so two windows can be equal only
in fragments with the same anchor string, and fragments are grouped by it.

* Fragments equal as a whole are counted by hash. All windows of a fragment that occurs twice are repeated.
* Fragments that occur once, but whose anchor occurs in other fragments too, go to an index together with one copy of each
  of those: a run-length Burrows-Wheeler index of the fragments of a number of anchors. Suffixes are sorted by prefix doubling;
  the transform is cut into runs of equal characters; the length that a suffix shares with its neighbour before or after is
  sampled at the first and last place of each run only. Matching statistics are streamed from the samples in text order: within a
  run a suffix that begins a byte later shares a byte less. A window whose statistic reaches LENGTH is repeated.
* Anchors with more than INDEX_BYTES of fragments are not put in one index; their windows are counted by hash (pre-aggregated),
  which gives the same answer at any size.

Defined results: null text is empty; texts shorter than LENGTH bytes keep everything; a text that repeats inside itself counts, also
with overlaps; equal rows are copies of each other; an empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from rankhouse.llm.common import SpanHashes, Stages, as_bytes, give_back, mixed, slices, stage, with_row_id

LENGTH = 400
GRAM = 200
INDEX_BYTES = 1 << 20  # fragments in one index; also the most that an anchor may bring there
_PLACE = 26  # bits of a place in a slice
SEGMENT = 1 << 22  # bytes of a text looked at together; longer texts are walked in overlapping segments


# ---------------------------------------------------------------- parsing


def fragments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(owner, first window, last window, anchor hash, fragment hash) of all fragments; windows by their place in the text."""
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - length + 1, 0)
    empty = np.zeros(0, np.int64)
    if not windows.any():
        return empty, empty, empty, empty, empty
    hashes = SpanHashes(data)
    n = len(data) - gram + 1
    at = np.arange(n)
    grams = hashes.of(at, at + gram)
    # rank by hash, then place; a window's anchor is the smallest of its length - gram + 1 keys
    best = (grams >> np.uint64(_PLACE) << np.uint64(_PLACE)) | at.astype(np.uint64)
    reach, want = 1, length - gram + 1
    while 2 * reach <= want:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if want > reach:
        best = np.minimum(best[: len(best) - (want - reach)], best[want - reach :])
    owner = np.repeat(np.arange(len(sizes)), windows)
    start = offsets[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    anchor = (best[start] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    low, high = start[head], start[np.append(head[1:], len(start)) - 1]
    place = anchor[head]
    content = mixed(hashes.of(low, high + length) + (place - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    base = offsets[:-1][owner[head]]
    return owner[head], low - base, high - base, grams[place].view(np.int64), content.view(np.int64)


def _segments(texts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of (rid, text) as (rid, place of the segment in its text, bytes, offsets); a long text comes in segments that overlap
    by LENGTH - 1 bytes, so that each window is in exactly one."""
    for batch in slices(texts):
        data, offsets = as_bytes(batch.column("text"))
        if len(data) <= SEGMENT:
            yield batch.column("rid"), np.zeros(batch.num_rows, np.int64), data, offsets
        else:  # a single long text
            step = SEGMENT - LENGTH + 1
            for low in range(0, max(1, len(data) - LENGTH + 1), step):
                part = data[low : low + SEGMENT]
                yield batch.column("rid"), np.array([low]), part, np.array([0, len(part)])


def _parsed(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rids, base, data, offsets in _segments(batches):
            owner, low, high, anchor, content = fragments(data, offsets)
            if len(owner):
                yield pa.RecordBatch.from_arrays(
                    [rids.take(pa.array(owner)), pa.array(base[owner] + low), pa.array((high - low).astype(np.int32)), pa.array(anchor), pa.array(content)],
                    names=["rid", "low", "more", "anchor", "content"],
                )

    return rows.mapInArrow(run, "rid long, low long, more int, anchor long, content long")


# ---------------------------------------------------------------- run-length index


class RunLengthIndex:
    """Run-length Burrows-Wheeler index of byte strings, none of which matches over its end."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.begins = np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + len(texts)
        symbols[self.begins + sizes - 1] = np.arange(len(texts))  # every end is a character of its own
        rank = np.unique(symbols, return_inverse=True)[1]
        ranks, reach = [rank.astype(np.int32)], 1
        while True:  # prefix doubling; all suffixes differ once the longest string is covered
            key = rank * (n + 2)
            key[:-reach] += rank[reach:] + 1
            order = np.argsort(key)
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.diff(key, prepend=key[0]) != 0)
            reach *= 2
            if rank[order[-1]] == n - 1 or 2 * reach > n:
                break
            ranks.append(rank.astype(np.int32))
        del key, rank
        self.n = n
        before = symbols[order - 1]  # the transform; the first suffix has the last character before it
        turn = np.flatnonzero(np.diff(before) != 0) + 1
        heads, tails = np.concatenate([[0], turn]), np.concatenate([turn - 1, [n - 1]])
        # order and ranks are needed for the samples only; what stays grows with the runs
        self.runs = before[heads]
        self.heads, self.tails = (self._sampled(order, ranks, at, step) for at, step in ((heads, -1), (tails, 1)))

    def _sampled(self, order: np.ndarray, ranks: list[np.ndarray], at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes at these places of the order, and how much each shares with its neighbour."""
        other = at + step
        inside = (other >= 0) & (other < self.n)
        sample = np.zeros(len(at), np.int64)
        sample[inside] = self._shared(ranks, order[at[inside]], order[other[inside]])
        return order[at], sample

    def _shared(self, ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many characters the suffixes at a and b have in common, from the ranks of the doublings."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            rank, inside = ranks[level], (a < self.n) & (b < self.n)
            same = inside & (rank[np.minimum(a, self.n - 1)] == rank[np.minimum(b, self.n - 1)])
            step = same.astype(np.int64) << level
            out, a, b = out + step, a + step, b + step
        return out

    def statistics(self) -> np.ndarray:
        """For every place the length of the longest string that starts there and anywhere else, streamed from the samples."""
        best = np.zeros(self.n, np.int64)
        for place, sample in (self.heads, self.tails):
            line = np.full(self.n, -1, np.int64)
            line[place] = sample
            known = np.flatnonzero(line >= 0)
            last = known[np.searchsorted(known, np.arange(self.n), side="right") - 1]
            # place 0 begins a text: the character before it is an end, which stands alone in its run, so it is sampled
            best = np.maximum(best, line[last] - (np.arange(self.n) - last))
        return best


def repeated_windows(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, which of its windows also start anywhere else in the texts."""
    index = RunLengthIndex(texts)
    found = index.statistics() >= length
    return [found[b : b + max(0, len(t) - length + 1)] for b, t in zip(index.begins.tolist(), texts)]


# ---------------------------------------------------------------- corpus


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of the runs of set flags."""
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _fetched(chosen: DataFrame, rows: DataFrame) -> DataFrame:
    """The bytes of the chosen fragments."""
    wanted = chosen.groupBy("rid").agg(F.collect_list(F.struct("low", "more", "anchor", "once", "crowded")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for rid, text, parts in zip(*(batch.column(c).to_pylist() for c in ("rid", "text", "parts"))):
                raw = text.encode()
                for p in parts:
                    out.append((p["anchor"], rid, p["low"], p["once"], p["crowded"], raw[p["low"] : p["low"] + p["more"] + LENGTH]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=names)

    names = ["anchor", "rid", "low", "once", "crowded", "bytes"]
    return rows.join(wanted, "rid").mapInArrow(run, "anchor long, rid long, low long, once boolean, crowded boolean, bytes binary")


def _indexed(found: DataFrame) -> DataFrame:
    """(rid, low, high) of the repeated windows of fragments that occur once, from indexes of whole anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pile: list[tuple] = []
        size = 0

        def solve() -> pa.RecordBatch:
            out = []
            for (_, rid, low, once, _), flags in zip(pile, repeated_windows([p[4] for p in pile])):
                if once:
                    out += [(rid, low + a, low + b + LENGTH) for a, b in zip(*(x.tolist() for x in _runs(flags)))]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], names=["rid", "low", "high"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "rid", "low", "once", "bytes"))):
                if size >= INDEX_BYTES and row[0] != pile[-1][0]:
                    yield solve()
                    pile, size = [], 0
                pile.append(row)
                size += len(row[4])
        if pile:
            yield solve()
        give_back()

    dealt = found.select("anchor", "rid", "low", "once", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "rid long, low long, high long")


def _counted(found: DataFrame) -> DataFrame:
    """The same for anchors with too many fragments for an index: windows are counted by two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes"):
            raw = batch.column("bytes").to_pylist()
            data = np.frombuffer(b"".join(raw), np.uint8)
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            begins, n = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
            owner = np.repeat(np.arange(len(raw)), n)
            shift = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            start, hashes = begins[owner] + shift, SpanHashes(data)
            half = start + LENGTH // 2
            columns = [batch.column("rid").take(pa.array(owner)), pa.array(batch.column("low").to_numpy()[owner] + shift)]
            columns += [pa.array(hashes.of(start, half).view(np.int64)), pa.array(hashes.of(half, start + LENGTH).view(np.int64))]
            columns.append(batch.column("once").take(pa.array(owner)))
            yield pa.RecordBatch.from_arrays(columns, names=["rid", "low", "first", "second", "once"])

    windows = found.select("rid", "low", "once", "bytes").mapInArrow(run, "rid long, low long, first long, second long, once boolean")
    copies = F.sum(F.when(F.col("once"), 1).otherwise(2))
    twice = windows.groupBy("first", "second").agg(copies.alias("copies")).where("copies > 1").select("first", "second")
    return windows.where("once").join(twice, ["first", "second"]).select("rid", "low", (F.col("low") + LENGTH).alias("high"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(rid, spans) of the texts with repeated bytes, written; spans are (low, high) in bytes and may overlap."""
    rows, stages = rows.select("rid", "text"), Stages()
    parsed = stages.write(_parsed(rows), "fragments")
    twice = stages.write(parsed.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "repeated-anchors")
    shared = stages.write(parsed.join(twice, "anchor", "left_semi"), "shared-fragments")
    kinds = stages.write(shared.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("rid")), "kinds")
    whole = shared.join(kinds.where("n > 1").select("anchor", "content"), ["anchor", "content"])
    whole = whole.select("rid", "low", (F.col("low") + F.col("more") + LENGTH).alias("high"))
    several = stages.write(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "anchors-of-several")
    crowded = F.col("kinds") > INDEX_BYTES // (2 * LENGTH)
    chosen = kinds.join(several, "anchor").select("anchor", "content", "rid", (F.col("n") == 1).alias("once"), crowded.alias("crowded"))
    chosen = shared.join(chosen, ["anchor", "content", "rid"]).dropDuplicates(["anchor", "content"])
    found = stages.write(_fetched(chosen, rows), "fragment-bytes")
    spans = whole.union(_indexed(found.where("not crowded"))).union(_counted(found.where("crowded")))
    spans = stage(spans.groupBy("rid").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "spans")
    stages.drop()
    return spans


def _merged(spans: list[dict] | None) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted((s["low"], s["high"]) for s in spans or []):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _kept(raw: bytes, spans: list[list[int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def removal(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and the sha256 of the bytes that are left."""
    rows = with_row_id(docs)
    spans = repeated_spans(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw, merged = text.encode(), _merged(found)
                out.append((len(raw), sum(b - a for a, b in merged), len(merged), hashlib.sha256(_kept(raw, merged)).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return rows.join(spans, "rid", "left").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(raw: bytes, spans: list[list[int]]) -> str:
    """The text without its spans; a character that a span covers in part stays."""
    inner = []
    for low, high in spans:
        while low < high and raw[low] & 0xC0 == 0x80:
            low += 1
        while low < high < len(raw) and raw[high] & 0xC0 == 0x80:
            high -= 1
        if low < high:
            inner.append([low, high])
    return _kept(raw, inner).decode()


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, repeated passages taken out of their texts; n_chars, where there is such a column, follows
    the text. Null texts stay null."""
    rid = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    spans = repeated_spans(with_row_id(docs)).withColumnsRenamed({"rid": "_rid", "spans": "_spans"})
    texts = docs.withColumn("text", F.col("text").cast("string"))
    rows = texts.withColumn("_rid", rid).join(spans, "_rid", "left").select(F.struct(*docs.columns).alias("row"), "_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = dict(zip(docs_columns, batch.column("row").flatten()))
            found = batch.column("_spans")
            left = [t if s is None else whole_characters(t.encode(), _merged(s)) for t, s in zip(columns["text"].to_pylist(), found.to_pylist())]
            columns["text"] = pa.array(left, columns["text"].type)
            if "n_chars" in columns:
                size = pc.cast(pc.utf8_length(columns["text"]), columns["n_chars"].type)
                columns["n_chars"] = pc.if_else(pc.is_valid(found), size, columns["n_chars"])
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(list(columns.values()), names=docs_columns)], names=["row"])

    docs_columns = docs.columns
    return rows.select("row", "_spans").mapInArrow(run, T.StructType([rows.schema["row"]])).select("row.*")


def op9_suffix_dedup(docs: DataFrame) -> DataFrame:
    return removal(docs)
