"""Document fingerprints: digests of improbable features.

Every window of WINDOW bytes is ranked by the entropy of its bytes; the fewer bytes repeat, the less likely the window is to occur
by chance. In every run of RUN neighbouring windows the rarest (the first of equals) gets a point, and windows with POINTS
or more are the text's features, together with its rarest window; a short text's features need one point only. Hashes of the features, each once, go into a chain of Bloom
filters of 2048 bits, FEATURES to a filter, five bits each. Likeness compares the filters of the shorter chain with the best
match in the other: common bits, less those expected by chance, over the most that could be common.

Entropies are sums of a table of integers, so a text's fingerprint does not depend on what stands beside it.

Defined results: null text is empty; a text shorter than a window is one feature; equal fingerprints have likeness 1; rows of equal
doc_id stand in the order of their texts, null doc_ids come last; an only document is its own next; an empty table gives no rows."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankhouse.llm.common import SpanHashes, id_text

WINDOW = 32
RUN = 32  # a power of 2
POINTS = 8
SHORT = 8 * WINDOW  # bytes of a text up to which a single point is enough
FEATURES = 160
FILTER_BYTES = 256
_HASHES = 5
#: c * log2(c) for c equal bytes in a window, in 2 ** -16 bits
_REPEATS = np.round(np.arange(WINDOW + 2) * np.log2(np.maximum(np.arange(WINDOW + 2), 1)) * 65536).astype(np.int64)
_STRIP = 1 << 16  # bytes whose counts are made at once, so that they stay in the processor's cache


def repetition(data: np.ndarray) -> np.ndarray:
    """For every window its sum of c * log2(c) over the counts c of its bytes: the smaller, the higher its entropy."""
    n = len(data) - WINDOW + 1
    out = np.empty(n, np.int64)
    for low in range(0, n, _STRIP):
        high = min(low + _STRIP, n)
        x = data[low : high + WINDOW - 1]
        later, earlier = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
        for lag in range(1, WINDOW):  # how often a byte occurs among the WINDOW - 1 after it, and before it
            same = (x[:-lag] == x[lag:]).view(np.uint8) if lag < len(x) else x[:0]
            later[: len(same)] += same
            earlier[lag : lag + len(same)] += same
        out[low] = _REPEATS[np.bincount(x[:WINDOW])].sum()
        # moving on by a byte takes one out that occurs 1 + later times and one in that occurred ``earlier`` times
        leaves, enters = later[: high - low - 1], earlier[WINDOW : WINDOW + high - low - 1]
        step = _REPEATS[leaves] - _REPEATS[leaves.astype(np.int64) + 1] + _REPEATS[enters.astype(np.int64) + 1] - _REPEATS[enters]
        out[low + 1 : high] = out[low] + np.cumsum(step)
    return out


def features(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct feature hashes of each text, in the order of their first places."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes = SpanHashes(data)
    short = hashes.of(begins, ends)
    if len(data) < WINDOW:
        return [short[i : i + 1] for i in range(len(texts))]
    n = len(data) - WINDOW + 1
    windows = np.maximum(sizes - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    start = begins[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    # a key is the rank with the place: the smallest is the rarest window, the first of equals
    best = np.full(n + RUN - 1, np.iinfo(np.int64).max)
    best[start] = key = repetition(data)[start] << 32 | start
    reach = 1
    while reach < RUN:  # the smallest of the next 2, 4, 8 ... keys; what runs over a text's end has no key
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    chosen = best[start] & 0xFFFFFFFF
    points = np.bincount(chosen, minlength=n)
    picked = points >= POINTS
    few = start[(sizes <= SHORT)[owner]]
    picked[few] = points[few] > 0
    has = np.flatnonzero(windows)
    if len(has):
        at = np.cumsum(windows)[has] - windows[has]
        picked[np.minimum.reduceat(key, at) & 0xFFFFFFFF] = True
    place = np.flatnonzero(picked)
    found = hashes.of(place, place + WINDOW)
    first = np.searchsorted(place, np.append(begins, len(data)))
    out = []
    for i in range(len(texts)):
        own = found[first[i] : first[i + 1]] if windows[i] else short[i : i + 1]
        out.append(own[np.sort(np.unique(own, return_index=True)[1])])
    return out


def filters(hashes: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters: an array of FILTER_BYTES bytes for every FEATURES features."""
    chain = np.zeros((-(-len(hashes) // FEATURES), FILTER_BYTES * 8), bool)
    row = np.arange(len(hashes)) // FEATURES
    for k in range(_HASHES):
        chain[row, (hashes >> np.uint64(11 * k)).astype(np.int64) & (FILTER_BYTES * 8 - 1)] = True
    return np.packbits(chain, axis=1)


def written(chain: np.ndarray) -> str:
    """The fingerprint as text: the number of filters, then their bytes."""
    return f"{len(chain)}:{base64.b64encode(chain.tobytes()).decode()}"


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), np.uint8).reshape(-1, FILTER_BYTES)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Normalised bit overlap of two chains, 0 to 1; symmetric."""
    if one.shape == other.shape and (one == other).all():
        return 1.0
    a, b = (x.view(np.uint64) for x in ((one, other) if len(one) <= len(other) else (other, one)))
    bits_a, bits_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))

    def matched(x: np.ndarray, bits_x: np.ndarray, y: np.ndarray, bits_y: np.ndarray) -> float:
        total = 0.0
        for row, bits in zip(x, bits_x.tolist()):
            common = np.bitwise_count(y & row).sum(axis=1, dtype=np.int64)
            chance = bits * bits_y / (FILTER_BYTES * 8)
            room = np.maximum(np.minimum(bits, bits_y) - chance, 1e-9)
            # a filter with fewer bits than its partner can match it at most in proportion
            total += bits * float(np.clip((common - chance) / room * np.minimum(bits, bits_y) / np.maximum(bits, bits_y), 0, 1).max())
        return total

    if len(a) == len(b):
        return min(1.0, (matched(a, bits_a, b, bits_b) + matched(b, bits_b, a, bits_a)) / float(bits_a.sum() + bits_b.sum()))
    return min(1.0, matched(a, bits_a, b, bits_b) / float(bits_a.sum()))


def fingerprint_all(texts: list[bytes]) -> list[np.ndarray]:
    return [filters(h) for h in features(texts)]


def _followed(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, ahead, doc_id, text): buckets of neighbouring doc_ids, sorted descending, each in one partition and each ending
    with the next bucket's first row (``ahead``). One shuffle of the texts; the driver gets the cuts and a head for each bucket."""
    rows = id_text(docs)
    share = [i / buckets for i in range(1, buckets)]
    cuts = rows.agg(F.percentile_approx("doc_id", share, 10_000) if share else F.lit(None)).first()[0] or []
    above = F.array(*map(F.lit, sorted(set(cuts)))) if cuts else F.array().cast("array<long>")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(set(cuts)) + 1)).otherwise(F.size(F.filter(above, lambda cut: cut > F.col("doc_id"))))
    rows = rows.withColumn("bucket", bucket.cast("int"))
    heads = [(r["bucket"], r["head"]) for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect()]
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]  # the first goes to the last
    table = docs.sparkSession.createDataFrame(before, "head long, bucket_before int")
    seen = rows.join(F.broadcast(table), rows["doc_id"].eqNullSafe(table["head"]), "left")  # a row for each bucket
    places = F.array(F.struct(F.lit(False).alias("ahead"), F.col("bucket").alias("bucket")), F.struct(F.lit(True).alias("ahead"), F.col("bucket_before").alias("bucket")))
    spread = seen.select("doc_id", "text", F.explode(places).alias("p")).where("p.bucket is not null").select("p.bucket", "p.ahead", "doc_id", "text")
    return spread.repartitionById(len(cuts) + 2, F.col("bucket")).sortWithinPartitions("bucket", "ahead", F.col("doc_id").desc_nulls_last(), "text")


def fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Every document's fingerprint and that of its edited text, and their likenesses. ``buckets``: parts the doc_ids are dealt
    into; the session's shuffle partitions if not given."""
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def edited(text: str, following: str) -> str:
        half = len(text) // 2
        return text[: len(text) - half] + following[:half]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # (bucket, ahead, doc_id, text) of rows whose next row is not seen yet, at most a slice

        def done(rows: list[tuple]) -> pa.RecordBatch | None:
            """All rows but the last, and rows that only look ahead."""
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]]
            if not pairs:
                return None
            changed = [edited(a[3], b[3]).encode() for a, b in pairs]
            own = fingerprint_all([r[3].encode() for r in rows])
            of_row = {id(r): f for r, f in zip(rows, own)}
            other = fingerprint_all(changed)
            mine = [of_row[id(a)] for a, _ in pairs]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([a[2] for a, _ in pairs], pa.int64()),
                    pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
                    pa.array(list(map(written, mine))),
                    pa.array(list(map(written, other))),
                    pa.array(list(map(likeness, mine, other)), pa.float64()),
                    pa.array([likeness(f, of_row[id(b)]) for f, (_, b) in zip(mine, pairs)], pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "ahead", "doc_id", "text")]
            size = 0
            for row in zip(*columns):
                waiting.append(row)
                size += len(row[3])
                if size > 1 << 20:
                    found = done(waiting)
                    if found is not None:
                        yield found
                    waiting, size = waiting[-1:], 0
        found = done(waiting)
        if found is not None:
            yield found

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _followed(docs, buckets).mapInArrow(run, schema)


def op4_fingerprints(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)
