"""Periodic runs against plain Python that tries every period at every word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from llm_cases import empty, hostile_texts, table  # noqa: F401
from rankhouse.llm import periodic_runs
from rankhouse.llm.common import read_table
from rankhouse.llm.periodic_runs import PRIME, collapse, find_runs, op12_periodic_runs, restore, transform

EMPTY = hashlib.sha256(b"").hexdigest()


def brute_runs(words):
    """(start, length, period) of every run, from all stretches of equal words a period apart."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                if not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if plant and n and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for a, length, q in runs for k in range(a + q, a + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    told = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in (told, left)))


def test_transform_is_a_convolution():
    draw = np.random.default_rng(1)
    for size in (2, 8, 64):
        a, b = draw.integers(0, PRIME, (2, 3, size))
        got = restore(transform(a) * transform(b) % PRIME)
        for row in range(3):
            exact = [sum(int(a[row, i]) * int(b[row, (k - i) % size]) for i in range(size)) % PRIME for k in range(size)]
            assert got[row].tolist() == exact
        assert (restore(transform(a)) == a).all()


def _sequences():
    draw = random.Random(5)
    for _ in range(400):  # few words: runs in runs
        yield [draw.randrange(draw.choice([1, 2, 3, 4])) for _ in range(draw.randint(0, 90))]
    for _ in range(150):  # planted periods between noise, some inside others
        out = []
        for _ in range(draw.randint(1, 4)):
            unit = [draw.randrange(50) for _ in range(draw.randint(1, 25))]
            if draw.random() < 0.4:
                unit = unit[:2] * draw.randint(4, 9) + unit[2:]
            out += unit * draw.randint(1, 7) + unit[: draw.randint(0, len(unit))]
            out += [draw.randrange(50) for _ in range(draw.randint(0, 12))]
        yield out
    for k in range(1, 40):
        yield ([0] * k + [1]) * 5
    yield [0] * 700
    yield ([0, 1] * 20 + [2]) * 6


def test_all_runs_are_found():
    for words in _sequences():
        got = [tuple(r) for r in find_runs(np.array(words, np.int64), len(words)).tolist()]
        assert got == brute_runs(words), words


def test_sums_that_are_zero_by_chance_are_checked(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PRIME", 17)  # 16 = 2 ** 4: transforms of up to 16 numbers, many zeros by chance
    monkeypatch.setattr(periodic_runs, "_roots", {})
    draw = random.Random(9)
    for _ in range(60):
        words = [draw.randrange(16) for _ in range(8)] + [1, 2, 3] * 4 + [draw.randrange(16) for _ in range(8)]
        got = [tuple(r) for r in find_runs(np.array(words, np.int64), 32).tolist()]
        assert got == brute_runs(words)


def test_runs_stay_in_their_text(spark, table):
    rows = collapse(table(["a a a a a", "a a a a a", "a b a b a b a b c", "x a a a a a a y"], [1, 2, 3, 4]), with_text=True)
    got = {r.doc_id: (r.n_runs, r.collapsed, r.runs) for r in rows.collect()}
    assert got == {1: (0, "a a a a a", ""), 2: (0, "a a a a a", ""), 3: (1, "a b c", "0,8,2\n"), 4: (1, "x a y", "1,6,1\n")}


def test_awkward_rows(spark, table, hostile_texts):
    texts = hostile_texts + ["b c " * 2000 + "d", "é ü " * 9, None, " \t\n", "a\x0ba\x0ca\ra\na\ta", "\x1fa \x1fa \x1fa \x1fa \x1fa \x1fa"]
    ids = [*range(len(texts) - 3), None, None, 7]
    got = op12_periodic_runs(table(texts, ids)).collect()
    want = [brute(i, t) for i, t in zip(ids, texts)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_text_longer_than_a_slice(spark, table):
    words = [f"w{i}" for i in range(120_000)]
    text = " ".join(["p"] * 2000 + words + words[:40_000] * 5)
    (row,) = collapse(table([text] + [None])).where("doc_id = 0").collect()
    # what follows the numbers: their first 40,000 five times
    assert (row.n_runs, row.start, row.length, row.period) == (2, 0, 2000, 1)
    assert len(text) > 2 << 20


@pytest.mark.parametrize("least,times", [(5, 4), (6, 3)])
def test_bounds_of_the_method(least, times):
    with pytest.raises(ValueError):
        find_runs(np.zeros(9, np.int64), 9, least, times)


def test_empty_table(spark, empty):
    assert op12_periodic_runs(empty).count() == 0


def test_query(spark, small):
    documents = read_table(spark, small, "documents")
    texts = {r.doc_id: r.text for r in documents.collect()}
    short = {i for i, t in texts.items() if len((t or "").split()) <= 1500}  # brute force tries every period
    got = {r.doc_id: tuple(r) for r in op12_periodic_runs(documents).collect()}
    assert got.keys() == texts.keys() and len(short) > 150
    for i in short:
        assert got[i] == brute(i, texts[i])
    assert sum(r[1] > 0 for r in got.values()) > 5
