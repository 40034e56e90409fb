"""The join against all pairs in plain Python."""

import random
import re

import numpy as np
import pytest

from llm_cases import empty, table  # noqa: F401
from rankhouse.llm import jaccard_join
from rankhouse.llm.jaccard_join import RTree, _pairs, count_vector, keep_one, op1_jaccard_join


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                parent[root(i)] = root(j)
                links[i] += 1
                links[j] += 1
    groups = {}
    for i, (name, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(name)
    lowest = {k: min((n for n in v if n is not None), default=None) for k, v in groups.items()}
    return sorted(((name, len(s), lowest[root(i)], links[i]) for i, ((name, _), s) in enumerate(zip(rows, sets))), key=str), len(groups)


@pytest.fixture(scope="module")
def rows():
    draw, words, rows = random.Random(5), [f"w{i}" for i in range(40)], []
    for _ in range(30):
        n = draw.choice([0, 1, 3, 5, 8, 30, 120, 400])
        base = [draw.choice(words) for _ in range(n)]
        for _ in range(draw.randint(1, 10)):
            copy = list(base)
            for _ in range(int(draw.choice([0, 0, 0.01, 0.02, 0.05]) * n + draw.random())):
                if copy:
                    copy[draw.randrange(n)] = draw.choice(words).upper()
            rows.append((len(rows), " ".join(copy)))
    passage = " ".join(f"c{i}" for i in range(40))
    rows += [(10_000 + i, passage + " " + " ".join(draw.choice(words) for _ in range(60))) for i in range(60)]
    return rows + [(None, "a b c d e f"), (None, "A b c d e f"), (9000, None), (9001, "  "), (9002, ""), (3, rows[3][1]), (None, "zz zz")]


SIZES = pytest.mark.parametrize(
    ("block", "common", "coordinates"), [(2048, 100, 16 << 20), (7, 3, 16 << 20), (2048, 100, 2_000)], ids=["one part", "split, common shingles last", "split by width"]
)


@SIZES
def test_every_link_once(monkeypatch, table, rows, block, common, coordinates):
    """Pairs of different texts, each in exactly one pair of parts, with the number of common shingles."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "COMMON_DOCUMENTS", common)
    monkeypatch.setattr(jaccard_join, "COORDINATES", coordinates)
    draw = random.Random(12)
    for g in range(3):
        base = [f"g{g}x{i}" for i in range(90 * (g + 1))]
        for k in range(20):
            changed = base[: len(base) - draw.randrange(12)]
            changed[draw.randrange(60)] = f"y{k}"
            rows = [*rows, (20_000 + 100 * g + k, " ".join(changed))]
    members, links = jaccard_join.class_links(table([t for _, t in rows], [i for i, _ in rows]))
    text = {i: t for i, t in rows if i is not None}
    one = {r["class"]: frozenset(shingles(text[r.doc_id])) for r in members.where("n > 0 AND doc_id IS NOT NULL").collect()}
    one |= {r["class"]: frozenset(shingles("a b c d e f" if r.n == 2 else "zz zz")) for r in members.where("doc_id IS NULL").collect()}
    found = [(frozenset((one[r.a], one[r.b])), r.common) for r in links.collect()]
    sets = sorted({s for s in one.values()}, key=sorted)
    expected = set()
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if 9 * len(a & b) >= 4 * (len(a) + len(b)):
                expected.add((frozenset((a, b)), len(a & b)))
    assert len(found) == len(set(found)) == len(expected) > 50 and set(found) == expected


@SIZES
def test_same_components(monkeypatch, table, rows, block, common, coordinates):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "COORDINATES", coordinates)
    monkeypatch.setattr(jaccard_join, "COMMON_DOCUMENTS", common)
    docs = table([t for _, t in rows], [i for i, _ in rows])
    expected, groups = brute(rows)
    assert sorted(map(tuple, op1_jaccard_join(docs).collect()), key=str) == expected
    kept = keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == groups


def test_tree_loses_no_pair():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 1 << 63, 60, dtype=np.uint64)) for _ in range(5)]
    sets = [np.unique(np.concatenate([s[draw.random(len(s)) > 0.1], draw.integers(0, 1 << 63, 4, dtype=np.uint64)])) for s in sets * 30]
    sizes = np.array(sorted(map(len, sets)))
    sets.sort(key=len)
    points = np.stack([count_vector(s).astype(np.int32) for s in sets])
    tree = RTree(points, sizes)
    assert len(tree.levels) > 1
    found = set(_pairs(tree, tree, True, lambda i, j: False))
    linked = {(i, j) for j in range(len(sets)) for i in range(j) if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (sizes[i] + sizes[j])}
    assert linked and linked <= found and len(found) < len(sets) ** 2 / 4


def test_empty_table(empty):
    assert op1_jaccard_join(empty).count() == 0 and keep_one(empty).columns == empty.columns
