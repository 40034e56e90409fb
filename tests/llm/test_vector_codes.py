"""Vector codes against plain Python that compares every part with every entry."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from rankhouse.llm.common import read_table
from rankhouse.llm.vector_codes import Balls, _squares, compress, op13_vector_codes, with_label_sum

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def brute(rows, entries=256, parts=4, rounds=4):
    """(vec_id, code, error, label_error, digest) of rows (vec_id, vector, label)."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = np.array([v for _, v, _ in kept], object).reshape(len(kept), parts, width)  # Python's own whole numbers
    books = cut[:entries].transpose(1, 0, 2).copy()

    def assign():
        gaps = [((cut[:, k, None] - books[k][None]) ** 2).sum(axis=2).astype(object) for k in range(parts)]
        return [[min(range(len(g)), key=lambda e: (g[e], e)) for g in gap] for gap in gaps], gaps

    for _ in range(rounds):
        codes, _ = assign()
        for k in range(parts):
            for e in range(books.shape[1]):
                mine = [cut[i, k] for i in range(len(kept)) if codes[k][i] == e]
                if mine:
                    books[k, e] = sum(mine) // len(mine)
    codes, gaps = assign()
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    errors = [sum(int(gaps[k][i][codes[k][i]]) for k in range(parts)) for i in range(len(kept))]
    by_label = defaultdict(int)
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    return [(i, "".join(f"{codes[k][n]:02x}" for k in range(parts)), errors[n], by_label[label], digest) for n, (i, _, label) in enumerate(kept)]


@pytest.fixture(scope="module")
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], SCHEMA).repartition(3)

    return build


def drawn(seed, n, groups, spread, size=16):
    draw = np.random.default_rng(seed)
    middles = draw.normal(0, 0.4, (groups, size))
    rows = np.float32(middles[draw.integers(0, groups, n)] + draw.normal(0, spread, (n, size)))
    return [(i, [float(x) for x in row], None if i % 7 == 0 else i % 3) for i, row in enumerate(rows)]


def same(got, want):
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("groups,spread", [(1, 0.3), (300, 0.001), (40, 0.05)])
def test_whole_operator(vectors, groups, spread):
    rows = drawn(groups, 700, groups, spread)
    same(op13_vector_codes(vectors(rows)), brute(rows))


@pytest.mark.parametrize("spread", [0.0, 2.0, 60.0])
def test_rings_equal_all_comparisons(spread):
    draw = np.random.default_rng(3)
    entries = draw.integers(-200, 200, (64, 4))
    entries[40:44] = entries[3]  # equal entries: the lowest wins
    parts = np.int64(entries[draw.integers(0, 64, 3000)] + draw.normal(0, spread, (3000, 4)))
    for ball in (draw.integers(0, 64, 3000), np.zeros(3000, np.int64), Balls(entries).nearest(parts)[0]):
        by_all, by_rings = Balls(entries), Balls(entries)
        want = by_all.nearest(parts)
        got = by_rings.reassign(parts, ball)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    if spread == 2.0:
        assert by_rings.compared < by_all.compared / 3  # cores and rings spare most distances


def test_squares_are_exact_for_large_numbers():
    draw = np.random.default_rng(4)
    a, b = draw.integers(-(2**27), 2**27, (2, 5, 16))
    assert _squares(a, b).tolist() == [[sum((int(x) - int(y)) ** 2 for x, y in zip(r, s)) for s in b] for r in a]


def test_dropped_and_repeated_rows(vectors):
    rows = drawn(8, 60, 9, 0.1, 8)
    bad = [(70, None, 1), (71, [None] * 8, 1), (72, [0.0] * 7 + [math.nan], 2), (0, [math.inf] + [0.0] * 7, None), (-5, [0.0] * 7 + [-math.inf], 1)]
    again = [rows[4], rows[4], (4, [0.25] * 8, 5), (None, [0.5] * 8, None), (None, [-0.5] * 8, 1), (-9, [-0.0001] * 8, 1)]
    same(op13_vector_codes(vectors(rows + bad + again)), brute(rows + bad + again))
    same(op13_vector_codes(vectors(bad)), [])


def test_all_equal_vectors(vectors):
    rows = [(i, [0.1, -0.1] * 4, None) for i in range(300)]
    same(op13_vector_codes(vectors(rows)), brute(rows))


def test_few_rows_and_unused_entries(vectors):
    rows = [(1, [0.0] * 4, 0), (2, [0.0] * 4, 0), (3, [1.0] * 4, 1)]
    same(op13_vector_codes(vectors(rows)), brute(rows))
    assert {r.code for r in op13_vector_codes(vectors(rows)).collect()} == {"00000000", "02020202"}


def test_what_is_refused(vectors):
    for rows in ([(1, [0.5] * 4, 0), (2, [0.5] * 8, 0)], [(1, [0.5] * 6, 0)], [(1, [1e6] * 4, 0)]):
        with pytest.raises(Exception, match="length|divide|after scaling"):
            op13_vector_codes(vectors(rows)).collect()


def test_many_labels_are_joined_by_shuffling(spark):
    rows = spark.createDataFrame([(i, i % 9 or None, "00", i) for i in range(90)], "vec_id long, label int, code string, error long")
    few, many = with_label_sum(rows), with_label_sum(rows, labels=3)
    assert sorted(map(str, few.collect())) == sorted(map(str, many.select(few.columns).collect())) and few.count() == 90


def test_other_sizes(vectors):
    rows = drawn(2, 200, 10, 0.2, 12)
    codes, books = compress(vectors(rows), parts=2, entries=8, rounds=2)
    want = brute(rows, entries=8, parts=2, rounds=2)
    assert books.shape == (2, 8, 6)
    assert sorted((r.vec_id, r.code, r.error) for r in codes.collect()) == [w[:3] for w in want]


def test_empty_table(spark):
    assert op13_vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, small):
    table = read_table(spark, small, "embeddings")
    got = op13_vector_codes(table)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    same(got, brute([(r.vec_id, r.embedding, r.label) for r in table.collect()]))
