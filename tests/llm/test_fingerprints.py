import hashlib

import numpy as np
import pytest

from llm_cases import empty, hostile_texts, table  # noqa: F401
from rankhouse.llm import fingerprints as fp
from rankhouse.llm.fingerprints import fingerprint_all, likeness, op4_fingerprints, read, repetition, written


def test_entropy_of_every_window():
    data = np.random.default_rng(3).integers(0, 5, 3000).astype(np.uint8)
    expected = [fp._REPEATS[np.bincount(data[i : i + fp.WINDOW])].sum() for i in range(len(data) - fp.WINDOW + 1)]
    assert repetition(data).tolist() == expected


def test_strips_make_no_difference(monkeypatch):
    data = np.random.default_rng(4).integers(0, 30, 2000).astype(np.uint8)
    whole = repetition(data)
    monkeypatch.setattr(fp, "_STRIP", 100)
    assert (repetition(data) == whole).all()


def test_neighbours_make_no_difference():
    draw = np.random.default_rng(5)
    texts = [bytes(draw.integers(97, 123, n).astype(np.uint8)) for n in (0, 1, 31, 32, 33, 200, 500, 5000, 20_000)]
    together = fingerprint_all(texts)
    assert all((a == fingerprint_all([t])[0]).all() for t, a in zip(texts, together))
    assert len(together[-1]) > 1 and all((read(written(a)) == a).all() for a in together)


def test_likeness_follows_what_is_shared():
    draw = np.random.default_rng(6)
    a, b, c = (bytes(draw.integers(97, 123, 6000).astype(np.uint8)) for _ in range(3))
    near = lambda x, y: likeness(*fingerprint_all([x, y]))
    assert near(a, a) == 1 and near(a, b) < 0.1
    assert 0.35 < near(a, a[:3000] + b[:3000]) < 0.65
    assert near(a, a[:5400] + b[:600]) > near(a, a[:3000] + b[:3000]) > near(a, a[:600] + c[:5400])
    assert near(a, b) == near(b, a)


@pytest.mark.parametrize("buckets", [1, 4, 40])
def test_query(table, hostile_texts, buckets):
    texts = hostile_texts[:60] + hostile_texts[-18:]
    ids = [3 * i for i in range(len(texts) - 2)] + [None, None]
    rows = sorted(fp.fingerprints(table(texts, ids), buckets).collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.n_chars))
    ordered = sorted(zip(ids, texts), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    assert len(rows) == len(ordered)
    expected = []
    for (name, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = fingerprint_all([text.encode(), edited.encode(), following.encode()])
        expected.append((name, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, c)))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_one_and_no_document(table, empty):
    only = op4_fingerprints(table(["abc def"])).collect()
    assert [(r.n_chars, r.near_next) for r in only] == [(7, 1.0)]
    assert op4_fingerprints(empty).count() == 0
