"""Periodic runs of words: stretches that repeat with a smallest period q over at least ``least`` words and ``times`` periods.

Block convolution. At the scale s (a power of two) the words are cut into blocks of s. A run of a period d in [s, 2s) holds a whole
block together with that block d words on, so every block is laid over the window that follows it: the squared differences
of both, summed for all d at once by a number-theoretic transform modulo a prime, are zero where the block occurs again. Zeros are checked word
by word; neighbouring blocks with the same distance are one seed, which is extended word by word to both sides and kept if it is
long enough and no divisor of its distance is a period.

Two exact tests spare blocks the transform. In a run every three words occur again a period on, so a block is only tried if each of its
words begins three words that occur again within 2s. A block that lies with its window in a run of a smaller period is skipped: what
it would find has that smaller period too.

All texts of a slice are handled as one row of words; equal words of different texts have different numbers, so no run leaves its text.
A single text longer than a slice is held whole. Nothing is shuffled.

Defined results: null or empty text and text without words has no words, no run, four nulls and the digests of empty text; a null doc_id
leaves the text as it is; every row gives one row, also with equal doc_ids; other columns are ignored."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rankhouse.llm.common import id_text, mixed, slices

#: A prime p with 2**23 dividing p - 1, and a generator of its multiplicative group.
PRIME, GENERATOR, ORDER = 998_244_353, 3, 23
#: Numbers that a batch of transforms, of checks or of extensions holds at once.
BATCH = 1 << 20
_ROW = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)

_roots: dict[tuple[int, bool], np.ndarray] = {}


def _root_powers(size: int, inverse: bool) -> np.ndarray:
    """1, w, w ** 2 ... for half a turn of the root of unity of the size."""
    if (size, inverse) not in _roots:
        root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
        root = pow(root, PRIME - 2, PRIME) if inverse else root
        powers = np.ones(max(1, size // 2), np.int64)
        filled, step = 1, root
        while filled < len(powers):  # doubling: the powers so far times the next one
            powers[filled : 2 * filled] = powers[: len(powers[filled : 2 * filled])] * step % PRIME
            filled, step = 2 * filled, step * step % PRIME
        _roots[size, inverse] = powers
    return _roots[size, inverse]


def transform(rows: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of each row (a power of two of numbers below PRIME), in bit-reversed order."""
    count, size = rows.shape
    rows, width = rows.copy(), size
    while width > 1:
        parts = rows.reshape(count, size // width, 2, width // 2)
        low, high = parts[:, :, 0], parts[:, :, 1]
        total, gap = low + high, (low - high) * _root_powers(width, False) % PRIME
        parts[:, :, 0], parts[:, :, 1] = np.where(total >= PRIME, total - PRIME, total), gap
        width //= 2
    return rows


def restore(rows: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``."""
    count, size = rows.shape
    rows, width = rows.copy(), 2
    while width <= size:
        parts = rows.reshape(count, size // width, 2, width // 2)
        low, high = parts[:, :, 0].copy(), parts[:, :, 1] * _root_powers(width, True) % PRIME
        total, gap = low + high, low - high
        parts[:, :, 0], parts[:, :, 1] = np.where(total >= PRIME, total - PRIME, total), np.where(gap < 0, gap + PRIME, gap)
        width *= 2
    return rows * pow(size, PRIME - 2, PRIME) % PRIME


def _distances(words: np.ndarray, blocks: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance): where each block of s words occurs again, s to 2s - 1 words on, as far as the transform tells."""
    if 2 * s > 1 << ORDER:
        raise ValueError(f"a text of over {1 << ORDER + 1} words in a block scale beyond the transform's size")
    found_block, found_distance = [], []
    for low in range(0, len(blocks), max(1, BATCH // (2 * s))):
        some = blocks[low : low + max(1, BATCH // (2 * s))]
        block = words[some[:, None] * s + np.arange(s)]
        at = some[:, None] * s + s + np.arange(2 * s)
        window = np.where(at < len(words), words[np.minimum(at, len(words) - 1)], PRIME - 1)  # beyond the end: no word's number
        padded = np.zeros((len(some), 2 * s), np.int64)
        padded[:, :s] = block[:, ::-1]
        product = restore(transform(padded) * transform(window) % PRIME)[:, s - 1 : 2 * s - 1]
        squares = np.zeros((len(some), 2 * s + 1), np.int64)
        np.cumsum(window * window % PRIME, axis=1, out=squares[:, 1:])
        own = (block * block % PRIME).sum(axis=1)
        mismatch = (own[:, None] + squares[:, s : 2 * s] - squares[:, :s] - 2 * product) % PRIME
        b, d = np.nonzero(mismatch == 0)
        found_block.append(some[b])
        found_distance.append(d + s)
    return np.concatenate(found_block), np.concatenate(found_distance)


def _verified(words: np.ndarray, block: np.ndarray, distance: np.ndarray, s: int) -> np.ndarray:
    """Which blocks really occur again at their distance: a sum can be zero modulo the prime without being zero."""
    right = np.zeros(len(block), bool)
    step = max(1, BATCH // s)
    for low in range(0, len(block), step):
        at = block[low : low + step, None] * s + np.arange(s)
        on = at + distance[low : low + step, None]
        inside = on[:, -1] < len(words)
        right[low : low + step] = inside & (words[at] == words[np.minimum(on, len(words) - 1)]).all(axis=1)
    return right


def _reach(words: np.ndarray, first: np.ndarray, second: np.ndarray, direction: int) -> np.ndarray:
    """How many words from ``first`` and ``second`` on (direction 1) or back (-1) are equal in pairs."""
    n, length = len(words), np.zeros(len(first), np.int64)
    active, width = np.arange(len(first)), 8
    while len(active):
        grown = []
        step = max(1, BATCH // width)
        for low in range(0, len(active), step):
            some = active[low : low + step]
            move = (length[some, None] + np.arange(width)) * direction
            a, b = first[some, None] + move, second[some, None] + move
            inside = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < n)
            same = inside & (words[np.clip(a, 0, n - 1)] == words[np.clip(b, 0, n - 1)])
            same = np.where(same.all(axis=1), width, same.argmin(axis=1))
            length[some] += same
            grown.append(some[same == width])
        active, width = np.concatenate(grown), min(2 * width, 1 << 14)
    return length


def _primes_of(n: int) -> list[int]:
    found, factor = [], 2
    while factor * factor <= n:
        if n % factor == 0:
            found.append(factor)
            while n % factor == 0:
                n //= factor
        factor += 1
    return found + [n] * (n > 1)


def _next_triple(words: np.ndarray) -> np.ndarray:
    """How far on the three words from each word on occur again; very far if they do not. A collision of the hash can only bring an
    occurrence nearer, which costs time and changes nothing."""
    n = len(words)
    far = np.full(n, np.iinfo(np.int64).max)
    if n < 3:
        return far
    w = words.astype(np.uint64)
    keys = mixed(mixed(w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1]) * np.uint64(0x9E3779B97F4A7C15) + w[2:])
    order = np.argsort(keys, kind="stable")
    again = keys[order[1:]] == keys[order[:-1]]
    far[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return far


def find_runs(words: np.ndarray, longest: int, least: int = 6, times: int = 4) -> np.ndarray:
    """All runs among the numbers ``words``, as rows (start, length, period) ordered by start and period. ``longest``: words of the longest
    text, which bounds the periods. ``least`` is at least ``times`` + 2 and ``times`` at least 4, as blocks and tests rely on both."""
    if times < 4 or least < times + 2:
        raise ValueError("blocks find runs of at least four periods and six words")
    n = len(words)
    words = words.astype(np.int64)
    runs = np.zeros((0, 3), np.int64)
    recur = _next_triple(words)  # at each scale: the largest of the block
    covered = np.zeros(n + 1, np.int64)  # at each word: how far a run that begins there or before goes
    s = 1
    while times * s <= longest and len(recur):
        blocks = np.flatnonzero(recur < 2 * s)
        blocks = blocks[covered[blocks * s] < (blocks + 3) * s]
        if len(blocks):
            fresh = _at_scale(words, blocks, s, least, times)
            runs = np.concatenate([runs, fresh])
            np.maximum.at(covered, fresh[:, 0], fresh[:, 0] + fresh[:, 1])
            covered = np.maximum.accumulate(covered)
        recur = recur[: len(recur) // 2 * 2].reshape(-1, 2).max(axis=1)
        s *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _at_scale(words: np.ndarray, blocks: np.ndarray, s: int, least: int, times: int) -> np.ndarray:
    """The runs of periods s to 2s - 1 that the blocks find."""
    block, distance = _distances(words, blocks, s)
    real = _verified(words, block, distance, s)
    block, distance = block[real], distance[real]
    order = np.lexsort((block, distance))
    block, distance = block[order], distance[order]
    heads = np.ones(len(block), bool)  # a seed: neighbouring blocks of one distance
    heads[1:] = (distance[1:] != distance[:-1]) | (block[1:] != block[:-1] + 1)
    first = np.flatnonzero(heads)
    last = np.append(first[1:], len(block))[: len(first)] - 1
    low, high, d = block[first] * s, (block[last] + 1) * s, distance[first]
    start = low - _reach(words, low - 1, low - 1 + d, -1)
    end = high + d + _reach(words, high, high + d, 1)
    fits = end - start >= np.maximum(least, times * d)
    found = np.unique(np.stack([start, end - start, d], axis=1)[fits], axis=0)
    smallest = [
        not any(np.array_equal(words[a : a + d - d // f], words[a + d // f : a + d]) for f in _primes_of(d)) for a, _, d in found.tolist()
    ]
    return found[np.array(smallest, bool)] if len(found) else found


def number_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts one after another, equal for equal words of a text and different between texts, and the n + 1
    positions of the texts among them. Null texts have no words."""
    texts = pc.ascii_trim_whitespace(pc.cast(pc.fill_null(texts, ""), pa.large_string()))
    lists = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    some = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
    found = pc.list_flatten(lists.filter(pa.array(some)))
    codes = found.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.where(some, counts, 0))])
    owner = np.repeat(np.arange(len(some)), np.diff(offsets))
    _, numbers = np.unique(owner << 32 | codes, return_inverse=True)
    return numbers.astype(np.int64), offsets


def planted_period(doc_id: int | None, n: int) -> tuple[int, int]:
    """(first word, period) of the stretch that the contract makes periodic in a text of n words; (n, 1) where it changes nothing."""
    if doc_id is None or not n:
        return n, 1
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return n, 1
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _summary(runs: np.ndarray) -> tuple:
    """start, length, period and 1000 times the exponent of the most repeated run; nulls without one."""
    if not len(runs):
        return (None,) * 4
    start, length, period = min(runs.tolist(), key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]))
    return start, length, period, 1000 * length // period


def collapse(docs: DataFrame, least: int = 6, times: int = 4, source=None, with_text: bool = False) -> DataFrame:
    """A row for each document: number of runs, the most repeated one, digests of all runs and of the words that stay when each run keeps its
    first period; ``with_text`` adds these words and the runs. ``source(doc_id, n)`` gives (a, p): from word a on, words come from the p
    words there (None: texts as they are)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            numbers, offsets = number_words(batch.column("text"))
            ids, n = batch.column("doc_id").to_pylist(), np.diff(offsets)
            changed = {}
            for i, (doc_id, words) in enumerate(zip(ids, n.tolist())) if source else ():
                a, p = source(doc_id, words)
                if a < words:
                    changed[i] = np.concatenate([np.arange(a), a + np.arange(words - a) % p])
                    numbers[offsets[i] : offsets[i + 1]] = numbers[offsets[i] + changed[i]]
            runs = find_runs(numbers, int(n.max(initial=0)), least, times)
            owner = np.searchsorted(offsets, runs[:, 0], side="right") - 1
            edges = np.searchsorted(owner, np.arange(len(ids) + 1))
            columns = [[] for _ in names]
            for i, (doc_id, text) in enumerate(zip(ids, batch.column("text").cast(pa.large_binary()).to_pylist())):
                own = runs[edges[i] : edges[i + 1]] - [offsets[i], 0, 0]
                words = (text or b"").split()  # on the six ASCII spaces
                if i in changed:
                    words = [words[k] for k in changed[i].tolist()]
                if len(own):
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, own[:, 0] + own[:, 2], 1)
                    np.add.at(cover, own[:, 0] + own[:, 1], -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]
                told = "".join(f"{a},{length},{p}\n" for a, length, p in own.tolist())
                left = b" ".join(words)
                row = [doc_id, len(own), *_summary(own), hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(left).hexdigest()]
                row += [left.decode(), told] if with_text else []
                for column, value in zip(columns, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    schema = _ROW + ", collapsed string, runs string" * with_text
    names, kinds = zip(*((c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in schema.split(", ")))
    return id_text(docs).mapInArrow(run, schema)


def op12_periodic_runs(docs: DataFrame) -> DataFrame:
    return collapse(docs, source=planted_period)
