"""N-gram Jaccard join with count-vector R-trees.

A text's set is its distinct five-word shingles as 64-bit hashes. Documents with equal sets are a class; classes link when
9 * common >= 4 * (size + size), which is a Jaccard similarity of 0.8 or more.

1. Blocking that loses nothing: linked sets share one of the first n - ceil(0.8 n) + 1 elements of each in any common order. The
   order puts shingles that very many documents share last (a bounded list, found from bounded summaries of all documents), so
   that common lines make no blocks unless a document consists of them. Blocks with the same members are one.
2. In a block every class is a point: its shingles are hashed into groups, the counts of the groups are its coordinates. An R-tree
   over the points bounds the common shingles of two nodes, and of two points, by the summed minima of their coordinates;
   what cannot reach the overlap that the sizes ask for is cut off. Of the pairs that survive a block passes on a spanning forest.
3. Components of these forests are clusters: linked classes are in the same one. A cluster's sets are brought together once, each
   set once, and an R-tree proposes pairs again; every one of them is verified exactly, so that no link between different texts is lost.
4. Components of the verified links are the result, with the number of links of every document: the documents of all classes that its own is
   linked with, and its copies. Links are counted where they are verified and not written as pairs; ``class_links`` writes them.

Blocks and clusters of more than BLOCK members, or more than COORDINATES coordinates, are split into pairs of parts of at most that,
which cover all pairs once. The work in a cluster grows with the number of its links.

Defined results: a text with fewer than five words is one shingle; null texts and texts without words have an empty set and are
linked with nothing; equal rows are linked like copies; a null doc_id takes part but never names a component unless all its
members are null."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankhouse.llm.common import LOWER, SpanHashes, Stages, as_bytes, give_back, id_text, mixed, shingle_hashes, slices, stage, with_row_id, word_spans
from rankhouse.llm.components import components

SHINGLE = 5
COMMON_SHINGLES = 65_536  # length of the list of very common shingles, at most
COMMON_DOCUMENTS = 100  # documents that the summaries must have named for a shingle on it
SUMMARY = 4_096  # entries of a task's summary
BLOCK = 2_048
COORDINATES = 16 << 20  # of the points that a task holds side by side: 64 MB
PAGE = 16  # points or nodes in a node of the R-tree


# ---------------------------------------------------------------- sets


def sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, shingle hash), each pair once, ordered."""
    lower = LOWER[data]
    starts, ends, first = word_spans(lower, offsets)
    hashes, owner = shingle_hashes(SpanHashes(lower).of(starts, ends), first, SHINGLE)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def prefix_length(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n - (8 * n + 9) // 10 + 1, 0)


def _dimensions(n: int) -> int:
    """Coordinates of a set of n elements: the power of two at or above n, 64 at least."""
    return max(64, 1 << max(0, n - 1).bit_length())


def count_vector(hashes: np.ndarray) -> np.ndarray:
    """How many elements fall in each group. Halving the dimensions adds neighbouring halves."""
    d = _dimensions(len(hashes))
    counts = np.bincount((hashes >> np.uint64(11)).astype(np.int64) & (d - 1), minlength=d)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint16)


def _members(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Every document: row id, doc_id, size, class, count vector and blocking keys."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for batch in slices(batches):
            owner, hashes = sets(*as_bytes(batch.column("text")))
            n = np.bincount(owner, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(n)])
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes))])
            kind = mixed((sums[first[1:]] - sums[first[:-1]]) * np.uint64(0x9E3779B97F4A7C15) + n.astype(np.uint64))
            known = np.searchsorted(last, hashes)
            known = last[np.minimum(known, len(last) - 1)] == hashes if len(last) else np.zeros(len(hashes), bool)
            order = np.lexsort((hashes, known, owner))
            place = np.arange(len(owner)) - first[owner]
            taken = place < prefix_length(n)[owner]
            keys = hashes[order][taken].view(np.int64)
            key_first = np.concatenate([[0], np.cumsum(prefix_length(n))]).astype(np.int32)
            vectors = [count_vector(hashes[a:b]) for a, b in zip(first.tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid"),
                    batch.column("doc_id"),
                    pa.array(n),
                    pa.array(kind.view(np.int64)),
                    pa.array([_packed(v) for v in vectors], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(key_first), pa.array(keys)),
                ],
                names=["rid", "doc_id", "n", "class", "vector", "keys"],
            )

    return with_row_id(docs).mapInArrow(run, "rid long, doc_id long, n long, class long, vector binary, keys array<long>")


def _packed(vector: np.ndarray) -> bytes:
    """A count vector for shuffles: most counts are 0 or 1, so it shrinks to about a fifth."""
    return bytes([vector.itemsize]) + zlib.compress(vector.tobytes(), 1)


def _vector(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw[1:]), f"u{raw[0]}").astype(np.int32)


def common_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of very many documents, sorted; at most COMMON_SHINGLES. Any list gives the same links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in slices(batches):
            _, hashes = sets(*as_bytes(batch.column("text")))
            found, n = np.unique(hashes, return_counts=True)
            seen, at = np.unique(np.concatenate([seen, found[n > 2]]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n[n > 2]]), len(seen)).astype(np.int64)
            if len(seen) > 4 * SUMMARY:
                top = np.sort(np.argsort(-counts, kind="stable")[: 2 * SUMMARY])
                seen, counts = seen[top], counts[top]
        top = np.argsort(-counts, kind="stable")[:SUMMARY]
        if len(top):
            yield pa.RecordBatch.from_arrays([pa.array(seen[top].view(np.int64)), pa.array(counts[top])], names=["shingle", "n"])

    summed = id_text(docs).select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = summed.where(F.col("n") >= COMMON_DOCUMENTS).orderBy(F.desc("n"), "shingle").limit(COMMON_SHINGLES).collect()
    return np.sort(np.array([r["shingle"] for r in rows], np.int64).view(np.uint64))


# ---------------------------------------------------------------- R-tree


class Forest:
    """Union-find over positions 0 .. n - 1; ``links`` are the pairs that joined two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))


def _folded(vector: np.ndarray, d: int) -> np.ndarray:
    return vector.reshape(-1, d).sum(axis=0) if len(vector) > d else vector


class RTree:
    """Points of equal dimensions, bulk loaded in the order given; a node keeps its points' largest coordinates and
    smallest and largest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.levels = [(points, sizes, sizes)]
        while len(self.levels[-1][0]) > PAGE:
            most, low, high = self.levels[-1]
            at = np.arange(0, len(most), PAGE)
            self.levels.append((np.maximum.reduceat(most, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))


def _pairs(one: RTree, other: RTree, same: bool, connected: Callable[[int, int], bool]) -> Iterator[tuple[int, int]]:
    """Pairs of points (the first before the second if the trees are the same) whose summed coordinate minima reach the overlap that
    their sizes ask for. ``connected``: pairs that are of no interest any more."""
    height = max(len(one.levels), len(other.levels)) - 1
    a_top, b_top = (t.levels[min(height, len(t.levels) - 1)][0] for t in (one, other))
    work = [(height, 0, len(a_top), 0, len(b_top))]
    while work:
        level, a0, a1, b0, b1 = work.pop()
        (a_most, a_low, a_high), (b_most, b_low, b_high) = (t.levels[min(level, len(t.levels) - 1)] for t in (one, other))
        fits = (100 * b_high[b0:b1][None] >= 80 * a_low[a0:a1][:, None]) & (100 * a_high[a0:a1][:, None] >= 80 * b_low[b0:b1][None])
        for i in np.flatnonzero(fits.any(axis=1)).tolist():
            js = np.flatnonzero(fits[i])
            bound = np.minimum(a_most[a0 + i], b_most[b0:b1][js]).sum(axis=1)
            js = js[9 * bound >= 4 * (a_low[a0 + i] + b_low[b0:b1][js])]
            for j in js.tolist():
                x, y = a0 + i, b0 + j
                if same and level < len(one.levels) and x > y:
                    continue
                if level:
                    spans = []
                    for tree, k in ((one, x), (other, y)):
                        below = len(tree.levels[min(level - 1, len(tree.levels) - 1)][0])
                        spans += [k * PAGE, min((k + 1) * PAGE, below)] if level < len(tree.levels) else [k, k + 1]
                    work.append((level - 1, *spans))
                elif not (same and x >= y) and not connected(x, y):
                    yield x, y


def candidates(sizes: np.ndarray, vectors: list[np.ndarray], parts: np.ndarray | None, connected: Callable[[int, int], bool]) -> Iterator[tuple[int, int]]:
    """Pairs of points that survive the bound, each once, less those that are ``connected`` when their turn comes. ``parts``: 0 or 1 for
    each point, if only pairs between the two parts are asked for."""
    order = np.argsort(sizes, kind="stable")
    dimensions = np.array([len(vectors[i]) for i in order])
    halves = [None] if parts is None else [0, 1]
    trees = {}
    for d in np.unique(dimensions).tolist():
        for half in halves:
            own = order[(dimensions == d) & (True if half is None else parts[order] == half)]
            if len(own):
                points = np.stack([vectors[i] for i in own])
                trees[d, half] = (own.tolist(), points, RTree(points, sizes[own]))
    for (d, half), (own, points, tree) in trees.items():
        for e in (d, 2 * d):  # sizes that may link differ by a factor of 1.25, so dimensions by 2
            for other_half in halves:
                if (e, other_half) not in trees or (half is not None and half == other_half) or (e == d and half == 1):
                    continue
                others, more, other = trees[e, other_half]
                if e != d:
                    other = RTree(more.reshape(len(more), 2, d).sum(axis=1), sizes[others])
                same = e == d and half == other_half
                for x, y in _pairs(tree, other, same, lambda x, y: connected(own[x], others[y])):
                    yield own[x], others[y]


def forest(sizes: np.ndarray, vectors: list[np.ndarray], parts: np.ndarray | None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that survive the bound."""
    found = Forest(len(sizes))
    for i, j in candidates(sizes, vectors, parts, lambda i, j: found.root(i) == found.root(j)):
        found.join(i, j)
    return found.links


def verified(elements: list[np.ndarray], parts: np.ndarray | None) -> list[tuple[int, int, int]]:
    """All pairs of sets of a similarity of 0.8 or more, with the number of common elements. The bound proposes; the proposals of a set are counted
    together, by marking its elements among all."""
    sizes = np.array([len(e) for e in elements])
    proposed: dict[int, list[int]] = {}
    for i, j in candidates(sizes, [count_vector(e).astype(np.int32) for e in elements], parts, lambda i, j: False):
        proposed.setdefault(i, []).append(j)
    first = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.unique(np.concatenate(elements), return_inverse=True)[1]
    marked, links = np.zeros(int(ids.max(initial=0)) + 1, bool), []
    for i, others in proposed.items():
        mine = ids[first[i] : first[i + 1]]
        marked[mine] = True
        js = np.array(others)
        if 2 * sizes[js].sum() > len(ids):
            common = np.add.reduceat(marked[ids], first[:-1], dtype=np.int64)[js]
        else:
            common = np.array([np.count_nonzero(marked[ids[first[j] : first[j + 1]]]) for j in others])
        marked[mine] = False
        linked = 9 * common >= 4 * (sizes[i] + sizes[js])
        links += zip([i] * int(linked.sum()), js[linked].tolist(), common[linked].tolist())
    return links


# ---------------------------------------------------------------- groups


def _in_parts(rows: DataFrame, group: str, member: str) -> DataFrame:
    """Rows of a group, once for each pair of parts they take part in: columns ``pair`` (which two parts) and ``part`` (0 or 1; null in
    a pair of a part with itself). A group of at most BLOCK rows and COORDINATES coordinates has one part."""
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)), F.ceil(F.sum(F.greatest(2 * F.col("n"), F.lit(64))) / F.lit(COORDINATES)))
    large = stage(rows.groupBy(group).agg(parts.alias("parts")).where("parts > 1"), "large-groups")
    rows = rows.join(large, group, "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64(member), F.col("parts"))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pair = F.least("own", "other") * F.col("parts") + F.greatest("own", "other")
    part = F.when(F.col("own") != F.col("other"), (F.col("own") > F.col("other")).cast("int"))
    return rows.withColumn("pair", pair).withColumn("part", part).drop("own", "other", "parts")


def _solved(rows: DataFrame, group: str, content: list[str], solve: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """``solve`` over every pair of parts of every group: it takes rows (group, pair, class, part, n, *content) and returns rows of the schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(len(names))], names=names)

        pile: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if pile and pile[0][:2] != row[:2]:
                    out += solve(pile)
                    pile = []
                pile.append(row)
            yield batch_of(out)
        if pile:
            yield batch_of(solve(pile))
        give_back()

    names, columns = [c.split()[0] for c in schema.split(", ")], [group, "pair", "class", "part", "n", *content]
    dealt = _in_parts(rows, group, "class").repartition(F.col(group), F.col("pair")).sortWithinPartitions(group, "pair", "class")
    return dealt.select(*columns).mapInArrow(run, schema)


def _between(pile: list[tuple]) -> np.ndarray | None:
    parts = [r[3] for r in pile]
    return None if None in parts else np.array(parts)


def _forests(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes: the spanning forests of what survives the bound in each block."""

    def solve(pile: list[tuple]) -> list[tuple[int, int]]:
        found = forest(np.array([r[4] for r in pile]), [_vector(r[5]) for r in pile], _between(pile))
        return [(pile[i][2], pile[j][2]) for i, j in found]

    return _solved(rows, "block", ["vector"], solve, "a long, b long")


def _exact(rows: DataFrame, pairs: bool) -> DataFrame:
    """All links of each cluster, verified. With ``pairs`` (a, b, common); without, (a, b, links): b is not null in the links that span the
    components, and null in the number of documents that a class is linked with here."""

    def solve(pile: list[tuple]) -> list[tuple]:
        links = verified([np.frombuffer(r[5], np.uint64) for r in pile], _between(pile))
        kinds = [r[2] for r in pile]
        if pairs:
            return [(kinds[i], kinds[j], common) for i, j, common in links]
        spanning, linked = Forest(len(pile)), [0] * len(pile)
        for i, j, _ in links:
            spanning.join(i, j)
            linked[i] += pile[j][6]
            linked[j] += pile[i][6]
        return [(kinds[i], kinds[j], None) for i, j in spanning.links] + [(kinds[i], None, n) for i, n in enumerate(linked) if n]

    return _solved(rows, "cluster", ["elements", "copies"], solve, "a long, b long, common long" if pairs else "a long, b long, links long")


def _blocks(members: DataFrame, stages: Stages) -> DataFrame:
    """(block, class): the classes that share a blocking key, for keys of at least two classes; equal blocks once."""
    rows = members.where("n > 0").select(F.explode("keys").alias("key"), "class")
    keys = stages.write(rows.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("key"), "block-keys")
    rows = stages.write(rows.join(keys, "key").distinct(), "block-rows")
    same = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("class")).alias("x"), F.sum(F.shiftright(F.xxhash64("class", F.lit(1)), 16)).alias("s"))
    once = stages.write(same.groupBy("n", "x", "s").agg(F.min("key").alias("key")).select("key"), "blocks")
    return rows.join(once, "key").withColumnRenamed("key", "block")


def _clustered(docs: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """All documents (rid, doc_id, n, class), and the set of each class that may be linked: (cluster, class, n, copies, elements)."""
    first = Stages()
    wide = first.write(_members(docs, common_shingles(docs)), "members")
    members = stage(wide.select("rid", "doc_id", "n", "class"), "classes")
    blocks = _blocks(wide, first)
    one = members.where("n > 0").groupBy("class").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies"))
    points = wide.where("n > 0").select("class", "n", "vector").dropDuplicates(["class"])
    wanted = first.write(blocks.join(points, "class"), "points")
    clusters = components(_forests(wanted)).select(F.col("node").alias("class"), F.col("root").alias("cluster"))
    first.drop()  # clusters are a written table

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, hashes = sets(*as_bytes(batch.column("text")))
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1)).tolist()
            raw = [hashes[a:b].tobytes() for a, b in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:4]), pa.array(raw, pa.binary())], names=names)

    names = ["cluster", "class", "n", "copies", "elements"]
    chosen = clusters.join(one, "class").join(members.select("rid", "n").dropDuplicates(["rid"]), "rid")
    texts = with_row_id(docs).join(chosen, "rid").dropDuplicates(["class"]).select("cluster", "class", "n", "copies", "text")
    whole = texts.mapInArrow(elements, "cluster long, class long, n long, copies long, elements binary")
    return members, stages.write(whole, "clustered-sets")


def class_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents (rid, doc_id, n, class), and every link between classes once: (a, b, common), two classes and their common shingles."""
    members, whole = _clustered(docs, stages := Stages())
    links = stage(_exact(whole, pairs=True), "class-links")
    stages.drop()
    return members, links


def classes_and_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All documents (rid, doc_id, n, class), and (class, root, links) of the classes that are linked with another."""
    members, whole = _clustered(docs, stages := Stages())
    found = stages.write(_exact(whole, pairs=False), "verified")
    roots = components(found.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("class"), "root")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = stage(roots.join(links, "class"), "roots")
    stages.drop()
    return members, roots


def linked_documents(docs: DataFrame) -> DataFrame:
    """rid, doc_id, n_shingles, component_id, n_links and root (the component's class, null for an empty set) of every document."""
    members, roots = classes_and_links(docs)
    several = members.where("n > 0").groupBy("class").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    known = roots.join(several, "class", "full").select("class", "root", (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"))
    rows = members.join(known, "class", "left").withColumns({"root": F.coalesce("root", "class"), "n_links": F.coalesce("n_links", F.lit(0))})
    names = rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    columns = ["rid", "doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", "root"]
    filled = rows.where("n > 0").join(names, "root").select(*columns)
    empty = members.where("n = 0").withColumns({"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("long"), "root": F.lit(None).cast("long")})
    return filled.union(empty.select(*columns))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all its columns. Of equal rows one stays; documents without words
    all stay."""
    rows = linked_documents(docs).where("n_shingles > 0")
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("best"))
    keepers = best.select(F.col("best.rid").alias("_rid"))
    keyed = docs.withColumn("_rid", F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    has_word = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = keyed.where(has_word).join(keepers, "_rid", "left_semi").dropDuplicates(["_rid"])
    return kept.unionByName(keyed.where(~has_word)).select(docs.columns)


def op1_jaccard_join(docs: DataFrame) -> DataFrame:
    return linked_documents(docs).select("doc_id", "n_shingles", "component_id", "n_links")
