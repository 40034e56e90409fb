"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

score = sigmoid(bias + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): all pairs of features interact through
``FACTORS`` numbers each, in time linear in the features. It is fitted on the driver with a bounded sample of labelled
documents (SAMPLE, those of the smallest hash of doc_id); every document is scored where it is read, without a shuffle.

Defined results: null and empty texts have structure features only and are scored like others; without any label every score is
0.5; labels that are null or contradict each other are not used."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from rankhouse.llm.common import LOWER, SpanHashes, as_bytes, id_text, row_text, slices, word_spans
from rankhouse.llm.measures import measure

SAMPLE = 12_000  # labelled documents that the model is fitted on, at most
WORD_FEATURES = 1 << 12
FACTORS = 4
UPDATES = 1_200  # batches of BATCH documents that the model is fitted with
BATCH = 64
_BINS = np.array([0.0, 0.002, 0.01, 0.03, 0.1, 0.2, 0.4, 0.7])
_LENGTHS = np.array([1, 10, 30, 100, 300, 1000, 3000])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features of a slice of texts: owner, feature, value, ordered by owner. Words have the logarithm of their count, scaled
    to length 1 over the text; statistics are given as the bin they fall in."""
    n = len(offsets) - 1
    m = measure(data, offsets)
    starts, ends, first = word_spans(data, offsets)
    bucket = (SpanHashes(LOWER[data]).of(starts, ends) >> np.uint64(7)).astype(np.int64) % WORD_FEATURES
    owner = np.repeat(np.arange(n), np.diff(first))
    key, counts = np.unique(owner * WORD_FEATURES + bucket, return_counts=True)
    owner, feature, value = key // WORD_FEATURES, key % WORD_FEATURES, np.log1p(counts)
    norm = np.sqrt(np.bincount(owner, value * value, n))
    value = value / np.maximum(norm, 1e-9)[owner]
    words = np.maximum(m["n_words"], 1)
    shares = [
        m["n_symbols"] / words,
        m["n_repeat_words"] / words,
        m["n_stutters"] / words,
        m["n_dup_lines"] / np.maximum(m["n_lines"], 1),
        m["n_shouts"] / words,
        m["n_upper"] / np.maximum(m["n_letters"], 1),
        m["n_digits"] / np.maximum(m["n_chars"], 1),
    ]
    base, extra = WORD_FEATURES, []
    for share in shares:
        extra.append(base + np.searchsorted(_BINS, share, side="left"))
        base += len(_BINS) + 1
    extra.append(base + np.searchsorted(_LENGTHS, m["n_words"], side="right"))
    base += len(_LENGTHS) + 1
    extra.append(base + np.searchsorted(np.array([2.0, 4.0, 6.0, 9.0, 14.0]), m["word_chars"] / words))
    owner = np.concatenate([owner, *[np.arange(n)] * len(extra)])
    feature = np.concatenate([feature, *extra])
    value = np.concatenate([value, np.full(n * len(extra), 0.5)])
    order = np.argsort(owner, kind="stable")
    return owner[order], feature[order], value[order]


N_FEATURES = WORD_FEATURES + 7 * (len(_BINS) + 1) + len(_LENGTHS) + 1 + 6


class FactorisationMachine:
    """Scores everything 0.5 until it is fitted."""

    def __init__(self, bias: float = 0.0):
        self.bias = bias
        self.linear = np.zeros(N_FEATURES)
        self.pair = np.zeros((N_FEATURES, FACTORS))

    def sums(self, first: np.ndarray, feature: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins and the texts' factor sums. ``first``: where each text's features begin; none is empty."""
        scaled = self.pair[feature] * value[:, None]
        total = np.add.reduceat(scaled, first, axis=0)
        squares = np.add.reduceat(scaled * scaled, first, axis=0)
        linear = np.add.reduceat(self.linear[feature] * value, first)
        return self.bias + linear + 0.5 * (total * total - squares).sum(axis=1), total

    def score(self, owner: np.ndarray, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        if not len(owner):
            return np.zeros(0)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        return 1 / (1 + np.exp(-np.clip(self.sums(first, feature, value)[0], -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rate: float = 0.1, decay: float = 1e-5) -> None:
        """Adagrad on the logistic loss."""
        share = float(np.clip(labels.mean(), 0.01, 0.99))
        self.bias = float(np.log(share / (1 - share)))
        seen_linear, seen_pair = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, FACTORS), 1e-6)
        draw = np.random.default_rng(11)
        self.pair = draw.normal(0, 0.01, (N_FEATURES, FACTORS))
        batches = max(1, len(rows) // BATCH)
        for _ in range(-(-UPDATES // batches)):
            for some in np.array_split(draw.permutation(len(rows)), batches):
                sizes = np.array([len(rows[i][0]) for i in some])
                feature, value = (np.concatenate([rows[i][k] for i in some]) for k in (0, 1))
                margin, total = self.sums(np.cumsum(sizes) - sizes, feature, value)
                error = np.repeat((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]) / len(some), sizes)
                owner = np.repeat(np.arange(len(some)), sizes)
                by_linear = error * value
                by_pair = by_linear[:, None] * (total[owner] - self.pair[feature] * value[:, None])
                which, at = np.unique(feature, return_inverse=True)
                step = np.bincount(at, by_linear, len(which)) + decay * self.linear[which]
                seen_linear[which] += step * step
                self.linear[which] -= rate * step / np.sqrt(seen_linear[which])
                step = np.column_stack([np.bincount(at, by_pair[:, f], len(which)) for f in range(FACTORS)]) + decay * self.pair[which]
                seen_pair[which] += step * step
                self.pair[which] -= 0.3 * rate * step / np.sqrt(seen_pair[which])


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id as text leaves that remainder."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("long").cast("string"), "UTF-8")), F.lit(modulus)) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, learn: Column, most: int) -> DataFrame:
    """(doc_id, text, label) of the ``most`` labelled documents of the smallest hash among those to learn from. The labels are
    bounded first, so the texts are met by a table of at most ``most`` ids."""
    label = F.col(column).cast("int")
    known = labels.where(label.isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min(label).alias("label"), F.max(label).alias("_most")).where("label = _most").drop("_most")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return id_text(docs).join(F.broadcast(chosen), "doc_id")  # at most ``most`` rows of 12 bytes


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample: int = SAMPLE) -> FactorisationMachine:
    """``learn``: which rows of the labels may be learnt from; all if not given."""
    rows = labelled_sample(docs, labels, "quality", F.lit(True) if learn is None else learn, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, feature, value = features(*as_bytes(batch.column("text")))
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.ListArray.from_arrays(pa.array(first), pa.array(feature.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(first), pa.array(value.astype(np.float32))),
                ],
                names=["doc_id", "label", "feature", "value"],
            )

    found = rows.mapInArrow(run, "doc_id long, label int, feature array<int>, value array<float>").toArrow().sort_by("doc_id")
    model = FactorisationMachine()
    if found.num_rows:
        lists = [found[name].combine_chunks() for name in ("feature", "value")]
        cuts = np.cumsum(pc.list_value_length(lists[0]).to_numpy())[:-1]
        pairs = list(zip(*(np.split(x.flatten().to_numpy(), cuts) for x in lists)))  # views, no objects for each feature
        model.fit(pairs, found["label"].to_numpy().astype(float))
    return model


def scored(docs: DataFrame, model: FactorisationMachine, whole_rows: bool = False) -> DataFrame:
    """doc_id (or all columns, as ``row``) and score."""
    frame = row_text(docs) if whole_rows else id_text(docs)
    key = frame.columns[0]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 5 numbers for each of N_FEATURES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = shared.value.score(*features(*as_bytes(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(score)], names=[key, "score"])

    return frame.mapInArrow(run, f"{key} {frame.schema[key].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that score at least ``threshold``, with all their columns."""
    return scored(docs, fit(docs, labels), whole_rows=True).where(F.col("score") >= threshold).select("row.*")


def op5_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, learn=~held_out(5, 0))
    rows = scored(docs, model)
    return rows.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
