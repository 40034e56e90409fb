"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are runs of letters in lower case. Every term of a text has a weight: one plus the logarithm of its count, times its inverse document
frequency over all documents, times the square of its relevance (how much more often toxic examples have it than clean ones; one for
terms that at most one toxic example has). A bounded sample of labelled documents (EXAMPLES) are the examples, with all their terms; equal
vectors are one example with several votes. Examples stand in blocks of BLOCK, similar ones together, and every term has its largest
weight in each block: as rows for terms that many examples have (COMMON), as posting lists with an entry for each block for the others.
A query bounds every block by these weights, works out the blocks of the best bounds, and then those whose bound reaches the
NEIGHBOURS-th best product so far, so the neighbours are exact. Terms that no example has change no order but the text's length:
their frequencies are joined in afterwards.
Neighbours vote with a power of their cosine. Votes become scores by a monotone fit to the votes that examples get from all others.

Defined results: null and empty texts, and texts that share no term with any example, get the rate of the examples without a term, or of all
if there are none; without labels every score is 0.5; labels that are null or contradict each other for a doc_id are not used; equal
products are ordered by the content of the examples; every row gives one row."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from rankhouse.llm.common import LOWER, SpanHashes, as_bytes, give_back, id_text, slices, stage, word_spans
from rankhouse.llm.quality_classifier import held_out, labelled_sample

EXAMPLES = 40_000  # labelled documents that are learnt from, at most
NEIGHBOURS = 24
BLOCK = 64
ORDERING = 256  # terms by which examples are dealt to blocks; changes time only
COMMON = 16  # a term is common if more than one in so many examples has it
POWER = 4
PRIOR_VOTES = 0.2
QUERIES = 64  # texts that meet the index at once
PIECE = 1 << 18  # postings that are sorted at once; a term with more has a piece of its own
SLACK = 1e-4  # beyond what sums of weights of one sign lose in single precision

_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = False


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, term hash) of every term in the texts."""
    starts, ends, first = word_spans(data, offsets, _OUTSIDE)
    return np.repeat(np.arange(len(offsets) - 1), np.diff(first)), SpanHashes(LOWER[data]).of(starts, ends)


def counted(owner: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs in order, and how often each occurs."""
    order = np.lexsort((term, owner))
    owner, term = owner[order], term[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return owner[at], term[at], np.diff(np.append(at, len(owner)))


class Vocabulary:
    """The examples' terms with a factor each: the idf from ``documents``, how many of ``of`` documents have the term, times the square of
    its relevance for toxic texts, log2(2 + (toxic - 1) / max(1, clean)), counted over the examples that have it; one toxic example is left
    out, so that no example makes its own words relevant."""

    def __init__(self, hashes: np.ndarray, documents: np.ndarray, of: int, toxic: np.ndarray, clean: np.ndarray):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.factor = ((np.log((of + 1) / (documents + 1)) + 1) * np.log2(2 + np.maximum(toxic - 1, 0) / np.maximum(1, clean)) ** 2)[order]
        self.of = of

    def weighed(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, term, weight) of each text's terms of the vocabulary, ascending, and (first, hash, count) of its other terms."""
        n = len(offsets) - 1
        owner, hashes, counts = counted(*words(data, offsets))
        at = np.searchsorted(self.hashes, hashes)
        known = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes if len(self.hashes) else np.zeros(len(at), bool)
        first, other = (np.searchsorted(owner[which], np.arange(n + 1)) for which in (known, ~known))
        weight = (1 + np.log(counts[known])) * self.factor[at[known]]
        return first, at[known], weight, other, hashes[~known], counts[~known]


def lengths(first: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum of the squared weights of each text."""
    return np.bincount(np.repeat(np.arange(len(first) - 1), np.diff(first)), weight * weight, len(first) - 1)


def _name(term: np.ndarray, weight: np.ndarray) -> bytes:
    return hashlib.blake2b(term.astype(np.int32).tobytes() + weight.astype(np.float32).tobytes(), digest_size=16).digest()


def ranges(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32) + np.repeat((start - (ends - sizes)).astype(np.int32), sizes)


def coherent(rows: np.ndarray, size: int) -> np.ndarray:
    """An order of the rows in which similar ones share blocks of ``size``: halved along the principal direction until a block is left."""
    order, spans = np.arange(len(rows)), [(0, len(rows))]
    while spans:
        low, high = spans.pop()
        if high - low <= size:
            continue
        part = rows[order[low:high]]
        part -= part.mean(axis=0)
        direction = part[np.argmax(np.einsum("ij,ij->i", part, part))]
        for _ in range(4):
            direction = part.T @ (part @ direction)
            direction /= max(float(np.linalg.norm(direction)), 1e-30)
        order[low:high] = order[low:high][np.argsort(part @ direction, kind="stable")]
        middle = low + -(-(high - low) // (2 * size)) * size
        spans += [(low, middle), (middle, high)]
    return order


class BlockMaxIndex:
    """Exact nearest distinct vectors, from posting lists cut into blocks of BLOCK examples with each block's largest weight."""

    def __init__(self, first: np.ndarray, term: np.ndarray, weight: np.ndarray, toxic: np.ndarray, ids: np.ndarray, n_terms: int):
        groups: dict[bytes, list] = {}
        self.blank = np.zeros(2)  # examples without a term: how many, how many toxic
        term, weight = term.astype(np.int32, copy=False), weight.astype(np.float32, copy=False)
        for i in range(len(first) - 1):
            span = slice(first[i], first[i + 1])
            if first[i] == first[i + 1]:
                self.blank += (1, toxic[i])
                continue
            group = groups.setdefault(_name(term[span], weight[span]), [span, 0, 0, ids[i]])
            group[1] += 1
            group[2] += int(toxic[i])
            group[3] = min(group[3], ids[i])
        names = sorted(groups)  # by content: doc_ids order nothing
        rank = coherent(self._heavy([groups[name][0] for name in names], term, weight, n_terms), BLOCK)
        ordered = [groups[names[r]] for r in rank.tolist()]
        self.n_terms, self.rank = n_terms, rank.astype(np.int32)
        self.votes = np.array([g[1] for g in ordered], float)
        self.toxic = np.array([g[2] for g in ordered], float)
        self.ids = np.array([g[3] for g in ordered], np.int64)
        self.names = np.array(names, "S16")
        self.places = np.argsort(rank).astype(np.int32)
        self.given: tuple | None = ([g[0] for g in ordered], term, weight)
        del groups, names, ordered
        give_back()
        self._build(*self.given)

    def __getstate__(self) -> dict:
        """Workers get the blocks, not the vectors they were made of."""
        return {name: value for name, value in self.__dict__.items() if name != "given"}

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([span.stop - span.start for span in self.given[0]])]).astype(np.int64)

    @property
    def term(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int32), *(self.given[1][span] for span in self.given[0])])

    @property
    def weight(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.float32), *(self.given[2][span] for span in self.given[0])])

    @staticmethod
    def _heavy(spans: list[slice], term: np.ndarray, weight: np.ndarray, n_terms: int) -> np.ndarray:
        """The vectors' weights of the ORDERING terms that carry most of all lengths."""
        carried, rows = np.zeros(n_terms), np.zeros((len(spans), min(ORDERING, n_terms)), np.float32)
        for span in spans:
            carried[term[span]] += weight[span] ** 2
        column = np.full(n_terms, -1, np.int32)
        heavy = np.argsort(-carried, kind="stable")[:ORDERING]
        column[heavy] = np.arange(len(heavy))
        for row, span in zip(rows, spans):
            at = column[term[span]]
            row[at[at >= 0]] = weight[span][at >= 0]
        return rows

    def place(self, term: np.ndarray, weight: np.ndarray) -> int:
        """Position of an example's vector, -1 if it has none."""
        name = np.array(_name(term, weight), "S16")
        at = int(np.searchsorted(self.names, name))
        return int(self.places[at]) if at < len(self.names) and self.names[at] == name else -1

    def _build(self, spans: list[slice], term: np.ndarray, weight: np.ndarray) -> None:
        """Rows of the common terms, posting lists of the others, both by blocks. ``spans``: the examples' vectors, in the index's order. Postings
        are sorted for a range of terms at a time, straight from the vectors, so that only what the index keeps is held whole."""
        n = len(self.ids)
        self.blocks = -(-n // BLOCK)
        documents = np.zeros(self.n_terms, np.int64)
        for span in spans:
            documents[term[span]] += 1  # a vector has a term once
        common = np.flatnonzero(documents * COMMON > n)
        self.column = np.full(self.n_terms, -1, np.int32)
        self.column[common] = np.arange(len(common))
        self.rows = np.zeros((self.blocks * BLOCK, len(common)), np.float32)  # the last block is filled up with blanks
        for i, span in enumerate(spans):
            column = self.column[term[span]]
            self.rows[i, column[column >= 0]] = weight[span][column >= 0]
        self.block_max = self.rows.reshape(self.blocks, BLOCK, -1).max(axis=1)
        self.block_length = np.sqrt(np.einsum("ij,ij->i", self.rows, self.rows, dtype=np.float64)).reshape(self.blocks, BLOCK).max(axis=1)
        documents[common] = 0
        ends = np.cumsum(documents)
        total = int(ends[-1]) if len(ends) else 0
        self.posting, self.posting_weight = np.empty(total, np.uint8), np.empty(total, np.float32)  # place in the block
        start = np.fromiter((span.start for span in spans), np.int64, n)
        by_start = np.argsort(start)
        start, stop = start[by_start], np.fromiter((span.stop for span in spans), np.int64, n)[by_start]
        heads, blocks, most, entries = [], [], [], np.zeros(self.n_terms + 1, np.int64)  # of the entries, one for each term and block
        low = done = 0
        while done < total:
            high = max(int(np.searchsorted(ends, done + PIECE, side="right")), int(np.searchsorted(ends, done, side="right")) + 1)
            at, owner = self._between(term, low, high, start, stop)
            here, place = term[at], by_start[owner]
            rare = self.column[here] < 0
            at, here, place = at[rare], here[rare], place[rare]
            order = np.argsort((here - low).astype(np.int64) * n + place)
            here, place = here[order], place[order]
            self.posting[done : done + len(at)] = place % BLOCK
            self.posting_weight[done : done + len(at)] = weight[at[order]]
            block = (place // BLOCK).astype(np.int32)
            new = np.ones(len(at), bool)
            new[1:] = (here[1:] != here[:-1]) | (block[1:] != block[:-1])
            entry = np.flatnonzero(new)
            heads.append((entry + done).astype(np.int32))
            blocks.append(block[entry])
            most.append(np.maximum.reduceat(self.posting_weight[done : done + len(at)], entry))
            entries[low + 1 : high + 1] = np.bincount(here[entry] - low, minlength=high - low)
            low, done = high, done + len(at)
        self.entry_posting = np.concatenate([*heads, [total]], dtype=np.int32)
        heads.clear()
        self.entry_block = np.concatenate([np.zeros(0, np.int32), *blocks])
        blocks.clear()
        self.entry_max = np.concatenate([np.zeros(0, np.float32), *most])
        self.by_term = np.cumsum(entries).astype(np.int32)

    @staticmethod
    def _between(term: np.ndarray, low: int, high: int, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the terms from low to below high that lie in one of the ascending spans, and which span each lies in."""
        found = []
        for a in range(0, len(term), 4 * PIECE):
            part = term[a : a + 4 * PIECE]
            found.append(np.flatnonzero((part >= low) & (part < high)) + a)
        at = np.concatenate(found)
        owner = np.searchsorted(start, at, side="right") - 1
        inside = (owner >= 0) & (at < stop[owner])
        return at[inside], owner[inside]

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and products of the k nearest, nearest first; equal products by content. With weights of length 1 the products
        are cosines."""
        return self.nearest_of_all([(term, weight)], k)[0]

    def nearest_of_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """As nearest, for some queries at once. The largest weights bound every block; the blocks of the best bounds give a product that
        the k-th best reaches at least; only blocks whose bound reaches it too are worked out."""
        if not len(self.ids) or not queries:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        n, blocks = len(queries), self.blocks
        common = np.zeros((n, self.rows.shape[1]))
        by_rare = np.zeros((n, blocks))  # bounds of what the rare terms add
        listed = []  # for each query its entries in the posting lists, their blocks and the query's weights
        for q, (term, weight) in enumerate(queries):
            column = self.column[term]
            common[q, column[column >= 0]] = weight[column >= 0]
            rare = term[column < 0]
            start = self.by_term[rare]
            sizes = self.by_term[rare + 1] - start
            entry = ranges(start, sizes)
            listed.append((entry, self.entry_block[entry], np.repeat(weight[column < 0].astype(np.float32), sizes)))
            by_rare[q] = np.bincount(listed[q][1], listed[q][2] * self.entry_max[entry], blocks)
        single = common.astype(np.float32)
        length = np.sqrt((common * common).sum(axis=1))
        bound = by_rare + np.minimum(single @ self.block_max.T, length[:, None] * self.block_length)

        def products(need: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The needed pairs of a query and a block that can reach the query's floor; for each the products by the rare terms and, in
            single precision, by all. The common terms come first: their products replace their bound before any posting is read."""
            pairs, slots = np.flatnonzero(need), np.zeros(need.shape, np.int32)
            slots.reshape(-1)[pairs] = np.arange(len(pairs))
            total = np.empty((len(pairs), BLOCK), np.float32)
            for block in np.flatnonzero(need.any(axis=0)).tolist():
                which = np.flatnonzero(need[:, block])
                total[slots[which, block]] = single[which] @ self.rows[block * BLOCK : (block + 1) * BLOCK].T
            kept = total.max(axis=1) + by_rare.reshape(-1)[pairs] >= floor[pairs // blocks]
            pairs, total = pairs[kept], total[kept]
            need = np.zeros_like(need)
            need.reshape(-1)[pairs] = True
            slots.reshape(-1)[pairs] = np.arange(len(pairs))
            cuts = np.searchsorted(pairs, np.arange(n + 1) * blocks)
            exact = np.empty((len(pairs), BLOCK))
            for q, (entry, block, by) in enumerate(listed):
                inside = np.flatnonzero(need[q][block])
                start = self.entry_posting[entry[inside]]
                each = self.entry_posting[entry[inside] + 1] - start
                at = ranges(start, each)
                where = np.repeat((slots[q, block[inside]] - cuts[q]) * np.int32(BLOCK), each) + self.posting[at]
                value = np.repeat(by[inside], each) * self.posting_weight[at]
                exact[cuts[q] : cuts[q + 1]] = np.bincount(where, value, (cuts[q + 1] - cuts[q]) * BLOCK).reshape(-1, BLOCK)
            return pairs, exact, total + exact.astype(np.float32)

        need, floor = bound > 0, np.zeros(n)
        some = -(-2 * k // BLOCK) + 1
        if blocks > some:
            best = np.zeros_like(need)
            np.put_along_axis(best, np.argpartition(bound, blocks - some, axis=1)[:, -some:], True, axis=1)
            reached = products(best, floor)[2].reshape(n, -1)
            floor = np.partition(reached, some * BLOCK - k, axis=1)[:, some * BLOCK - k] * (1 - SLACK)
            need &= bound >= floor[:, None]
        pairs, exact, total = products(need, floor)
        cuts = np.searchsorted(pairs, np.arange(n + 1) * blocks)
        results = []
        for q in range(n):  # single precision chose them; the products of the common terms are worked out again
            mine = total[cuts[q] : cuts[q + 1]].reshape(-1)
            least = np.partition(mine, len(mine) - k)[len(mine) - k] * (1 - SLACK) if len(mine) > k else 0.0
            at = np.flatnonzero(mine >= max(least, 1e-12))
            chosen = (pairs[cuts[q] + at // BLOCK] % blocks) * BLOCK + at % BLOCK
            found = exact[cuts[q] : cuts[q + 1]].reshape(-1)[at] + self.rows[chosen] @ common[q]
            top = np.lexsort((self.rank[chosen], -np.round(found, 6)))[:k]
            results.append((chosen[top], found[top]))
        return results


class ToxicityModel:
    """Scores texts; ``levels`` is the monotone map from the share of votes to a score."""

    def __init__(self, vocabulary: Vocabulary, index: BlockMaxIndex | None, rate: float):
        self.vocabulary, self.index, self.rate = vocabulary, index, rate
        self.levels = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
        self.frequencies: DataFrame | None = None  # of terms that several documents have
        self.shared: Broadcast | None = None  # this model as it was before the fit of the levels
        n, toxic = index.blank if index else (0, 0)
        self.blank = float((toxic + PRIOR_VOTES * rate) / (n + PRIOR_VOTES))

    def votes(self, near: tuple[np.ndarray, np.ndarray], own: int = -1, label: int = 0) -> tuple[float, float]:
        """Votes for toxic and all votes of the neighbours, by products; ``own``: the place of an example whose own vote, ``label``, is left out."""
        found, product = near
        leave = found == own
        power = product**POWER
        return float(power @ (self.index.toxic[found] - label * leave)), float(power @ (self.index.votes[found] - leave))

    def share(self, toxic: np.ndarray, votes: np.ndarray, length: np.ndarray | float) -> np.ndarray:
        """Share of votes for toxic, beside PRIOR_VOTES of the examples' rate; products over the text's length are cosines."""
        return (toxic / length**POWER + PRIOR_VOTES * self.rate) / (votes / length**POWER + PRIOR_VOTES)

    def left_out(self, first: np.ndarray, term: np.ndarray, weight: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """The share of votes that each example gets from all others."""
        sums = []
        for i, near in enumerate(self.near(first, term, weight)):
            span = slice(first[i], first[i + 1])
            sums.append(self.votes(near, self.index.place(term[span], weight[span]), int(toxic[i])))
        return self.share(*np.array(sums).reshape(-1, 2).T, 1.0)

    def calibrate(self, shares: np.ndarray, labels: np.ndarray) -> None:
        """Pool adjacent violators over the votes that examples get without their own."""
        if not len(shares):
            return
        order = np.lexsort((-labels, shares))  # equal shares fall in one pool
        pools: list[list[float]] = []  # sum of labels, count, sum of shares
        for share, label in zip(shares[order].tolist(), labels[order].tolist()):
            pools.append([label, 1, share])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        self.levels = (np.array([p[2] / p[1] for p in pools]), np.array([(p[0] + self.rate) / (p[1] + 1) for p in pools]))

    def near(self, first: np.ndarray, term: np.ndarray, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Neighbours of each text, and the products with them."""
        names, queries = [], {}
        for a, b in zip(first.tolist(), first[1:].tolist()):
            names.append(_name(term[a:b], weight[a:b]))
            queries[names[-1]] = (term[a:b], weight[a:b])
        known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        keys = list(queries)
        for at in range(0, len(keys), QUERIES):
            some = keys[at : at + QUERIES]
            known.update(zip(some, self.index.nearest_of_all([queries[key] for key in some], NEIGHBOURS)))
        return [known[name] for name in names]


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, n): how many documents have each term, over all documents; terms of a single document are left out, as there n is known."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, hashes, _ = counted(*words(*as_bytes(batch.column("text"))))
            which, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(which.view(np.int64)), pa.array(n)], names=["term", "n"])

    return id_text(docs).select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).where("n > 1")


def _mapped(file: BinaryIO, kind: type) -> np.ndarray:
    """The file's values, read as they are needed."""
    file.flush()
    return np.memmap(file, kind, "r") if file.tell() else np.zeros(0, kind)


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, examples: int = EXAMPLES) -> ToxicityModel:
    """``learn``: which rows of the labels may be learnt from; all if not given."""
    rows = labelled_sample(docs, labels, "toxic", F.lit(True) if learn is None else learn, examples)

    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    if not total["n"]:
        return ToxicityModel(Vocabulary(np.zeros(0, np.uint64), np.zeros(0), 0, np.zeros(0), np.zeros(0)), None, 0.5)
    frequencies = stage(document_frequencies(docs), "document-frequencies")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, hashes, _ = counted(*words(*as_bytes(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column("label").take(pa.array(owner))], names=["term", "label"])

    rows = stage(rows, "examples")
    sides = rows.mapInArrow(terms, "term long, label int").groupBy("term").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    own = sides.join(frequencies, "term", "left").select("term", F.coalesce("n", F.lit(1)).alias("n"), "toxic", "clean").toArrow()  # terms of ``examples`` texts
    counts = [own[name].to_numpy().astype(float) for name in ("n", "toxic", "clean")]
    vocabulary = Vocabulary(own["term"].to_numpy().view(np.uint64), counts[0], docs.count(), *counts[1:])
    del own, counts
    give_back()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            first, term, weight, *_ = shared.value.weighed(*as_bytes(batch.column("text")))
            weight = weight / np.repeat(np.sqrt(lengths(first, weight)), np.diff(first))
            packed = [[x[i:j].tobytes() for i, j in zip(first, first[1:])] for x in (term.astype(np.int32), weight.astype(np.float32))]
            columns = [batch.column("doc_id"), batch.column("label"), *(pa.array(x, pa.binary()) for x in packed)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "term", "weight"])

    # at most ``examples`` rows, one partition at a time; their vectors lie in files, of which memory holds what is just looked at
    ids, toxic, sizes = [], [], []
    with tempfile.TemporaryFile() as term_file, tempfile.TemporaryFile() as weight_file:
        for row in rows.mapInArrow(vectors, "doc_id long, label int, term binary, weight binary").toLocalIterator():
            ids.append(row["doc_id"])
            toxic.append(row["label"])
            sizes.append(len(row["term"]) // 4)
            term_file.write(row["term"])
            weight_file.write(row["weight"])
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        give_back()
        index = BlockMaxIndex(first, _mapped(term_file, np.int32), _mapped(weight_file, np.float32), np.array(toxic), np.array(ids, np.int64), len(vocabulary.hashes))
        index.given = None  # the files go
    model = ToxicityModel(vocabulary, index, total["toxic"] / total["n"])
    del first, ids, toxic, sizes
    give_back()
    model.shared = whole = docs.sparkSession.sparkContext.broadcast(model)  # bounded by EXAMPLES
    model.frequencies = frequencies

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            first, term, weight, *_ = whole.value.vocabulary.weighed(*as_bytes(batch.column("text")))
            weight = (weight / np.repeat(np.sqrt(lengths(first, weight)), np.diff(first))).astype(np.float32)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            some = np.flatnonzero(np.diff(first))
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (whole.value.left_out(first, term, weight, label), label)], names=["share", "label"])

    # two numbers for each example that has a vector
    votes = rows.select("text", "label").mapInArrow(left_out, "share double, label int").toArrow()
    model.calibrate(votes["share"].to_numpy(), votes["label"].to_numpy())
    return model


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and evidence: the nearest examples, their cosines and the share of toxic ones among their equals."""
    schema = "array<struct<doc_id:long,similarity:double,toxic_share:double>>"
    if model.index is None:
        return id_text(docs).select("doc_id", F.lit(0.5).alias("score"), F.array().cast(schema).alias("evidence"))
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic_share", pa.float64())]))
    shared, levels, rate, blank = model.shared, model.levels, model.rate, model.blank

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            here = shared.value
            first, term, weight, other, hashes, counts = here.vocabulary.weighed(*as_bytes(batch.column("text")))
            near = here.near(first, term, weight)
            sums = np.array([here.votes(x) for x in near]).reshape(-1, 2)
            evidence = [
                [{"doc_id": i, "similarity": p, "toxic_share": s} for i, p, s in zip(here.index.ids[f[:3]].tolist(), p[:3].tolist(), (here.index.toxic[f[:3]] / here.index.votes[f[:3]]).tolist())]
                for f, p in near
            ]
            other = pa.array(other.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sums[:, 0]),
                    pa.array(sums[:, 1]),
                    pa.array(evidence, kind),
                    pa.array(lengths(first, weight)),
                    pa.ListArray.from_arrays(other, pa.array(hashes.view(np.int64))),
                    pa.ListArray.from_arrays(other, pa.array(counts.astype(np.int32))),
                ],
                names=["doc_id", "toxic", "votes", "evidence", "square", "other", "times"],
            )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = ToxicityModel(Vocabulary(np.zeros(0, np.uint64), np.zeros(0), 0, np.zeros(0), np.zeros(0)), None, rate)
        for batch in batches:
            toxic, votes, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("toxic", "votes", "length"))
            score = np.where(votes > 0, np.clip(np.interp(plain.share(toxic, votes, length), *levels), 0, 1), blank)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), batch.column("evidence")], names=["doc_id", "score", "evidence"])

    near = id_text(docs).mapInArrow(look, f"doc_id long, toxic double, votes double, evidence {schema}, square double, other array<long>, times array<int>")
    near = stage(near.withColumn("row", F.monotonically_increasing_id()), "near")
    others = near.select("row", F.explode(F.arrays_zip("other", "times")).alias("o")).select("row", F.col("o.other").alias("term"), F.col("o.times").alias("times"))
    # a term that stands in a text and not among the frequencies is this document's alone
    idf = F.log(F.lit(model.vocabulary.of + 1.0) / (F.coalesce("n", F.lit(1)) + 1)) + 1
    weight = (1 + F.log("times")) * idf
    outside = others.join(model.frequencies, "term", "left").groupBy("row").agg(F.sum(weight * weight).alias("outside"))
    length = F.sqrt(F.greatest(F.col("square") + F.coalesce("outside", F.lit(0.0)), F.lit(1e-300)))
    whole = near.join(outside, "row", "left").withColumn("length", length)
    cosines = F.transform("evidence", lambda e: e.withField("similarity", F.least(e["similarity"] / F.col("length"), F.lit(1.0))))
    rows = whole.select("doc_id", "toxic", "votes", "length", cosines.alias("evidence"))
    return rows.mapInArrow(finish, f"doc_id long, score double, evidence {schema}")


def op3_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = scored(docs, fit(docs, labels, learn=~held_out(3, 1)))
    return rows.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")
