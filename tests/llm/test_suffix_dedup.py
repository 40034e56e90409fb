"""Repeated passages against counting all windows in plain Python."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from llm_cases import empty, table  # noqa: F401
from rankhouse.llm import suffix_dedup
from rankhouse.llm.suffix_dedup import RunLengthIndex, op9_suffix_dedup, repeated_windows, whole_characters, without_repeats


def brute(rows, length=400):
    raw = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        mark = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                mark[k : k + length] = b"\1" * length
        runs = sum(1 for k, m in enumerate(mark) if m and not (k and mark[k - 1]))
        out.append((i, len(b), sum(mark), runs, hashlib.sha256(bytes(x for x, m in zip(b, mark) if not m)).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    draw, rows = random.Random(2), []

    def noise(n):
        return "".join(draw.choice("abcdé \n") for _ in range(n))

    passages = [noise(draw.choice([300, 390, 400, 420, 600, 1500])) for _ in range(12)]
    for i in range(120):
        text = "".join(noise(draw.randint(0, 300)) + (draw.choice(passages) if draw.random() < 0.5 else "") for _ in range(draw.randint(0, 4)))
        if rows and draw.random() < 0.2:
            text = draw.choice(rows)[1]
        rows.append((i, text))
    return rows + [(900, None), (901, ""), (902, "a" * 1000), (903, "ab" * 600), (904, "a" * 399), (905, "a" * 400), (None, "q" * 450), (None, "q" * 450), (5, rows[5][1])]


@pytest.mark.parametrize("index_bytes", [1 << 20, 1600], ids=["indexed", "crowded anchors counted"])
def test_same_bytes(monkeypatch, table, rows, index_bytes):
    monkeypatch.setattr(suffix_dedup, "INDEX_BYTES", index_bytes)
    found = op9_suffix_dedup(table([t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_long_text_in_segments(monkeypatch, table):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1500)
    monkeypatch.setattr("rankhouse.llm.common.slices.__defaults__", ("text", 1))
    draw = random.Random(8)
    part = "".join(draw.choice("abcdef") for _ in range(700))
    text = "".join(draw.choice("abcdef") for _ in range(3000)) + part + "xyz" + part
    data = [part.encode(), text.encode()]
    windows = [len(d) - 399 for d in data]
    rows = table([part, text]).select("doc_id", "text")
    from rankhouse.llm.common import as_bytes
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"rid": [1], "text": [text]})
    covered = []
    for _, base, raw, offsets in suffix_dedup._segments(iter([batch])):
        owner, low, high, _, _ = suffix_dedup.fragments(raw, offsets)
        covered += [w for a, b in zip((base[owner] + low).tolist(), (base[owner] + high).tolist()) for w in range(a, b + 1)]
    assert sorted(covered) == list(range(windows[1])) and rows.count() == 2 and len(as_bytes(batch.column("text"))[0]) == len(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=30).map(str.encode), min_size=1, max_size=6), st.integers(1, 8))
def test_matching_statistics(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    expected = [[counts[t[i : i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]
    assert [f.tolist() for f in repeated_windows(texts, length)] == expected


def test_repetitive_text_has_few_runs():
    index = RunLengthIndex([b"abcabcabc" * 40, b"abcabcabc" * 40])
    assert len(index.runs) < index.n / 20


def test_characters_stay_whole(table, rows):
    assert whole_characters("aéb".encode(), [[0, 2]]) == "éb" and whole_characters("aéb".encode(), [[2, 4]]) == "aé"
    docs = table([t for _, t in rows], [i for i, _ in rows])
    found = without_repeats(docs)
    assert found.columns == docs.columns and found.count() == len(rows)
    assert {r.doc_id: r.text for r in found.collect()}[900] is None


def test_empty_table(empty):
    assert op9_suffix_dedup(empty).count() == 0 and without_repeats(empty).columns == empty.columns
