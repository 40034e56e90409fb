"""Counts of whole texts, a slice of texts at a time: words, symbols, lines, repetition, letters."""

from __future__ import annotations

import numpy as np

from rankhouse.llm.common import IS_SPACE, SpanHashes, mixed, shingle_hashes, word_spans

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True  # fixed value: the symbols that are counted
_UPPER, _LETTER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC3, 0xF5)]] = True
_DIGIT[48:58] = True


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _seen(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every (text, hash): which distinct one it is, and how often each occurs."""
    keys = mixed(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return inverse, counts


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Long columns, one entry for each text. Empty texts have zeros."""
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    hashes = SpanHashes(data)
    words = hashes.of(starts, ends)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(n), n_words)
    head = (data & 0xC0) != 0x80
    inside = ~IS_SPACE[data]
    out = {
        "n_words": n_words,
        "word_chars": per_text(head & inside, offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_upper": per_text(_UPPER[data], offsets),
        "n_letters": per_text(_LETTER[data], offsets),
        "n_digits": per_text(_DIGIT[data], offsets),
        "n_shouts": per_text(data == ord("!"), offsets),
        "n_chars": per_text(head, offsets),
    }
    # lines: between line breaks, within a text
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_owner = np.searchsorted(offsets, line_start, side="right") - 1
    line_end = np.minimum(offsets[line_owner + 1], np.append(breaks, len(data))[np.searchsorted(breaks, line_start)])
    with_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_owner, line_start, line_end = line_owner[with_word], line_start[with_word], line_end[with_word]
    out["n_lines"] = np.bincount(line_owner, minlength=n)
    which, counts = _seen(line_owner, hashes.of(line_start, line_end))
    distinct = np.zeros(len(counts), np.int64)
    distinct[which] = line_owner
    out["n_dup_lines"] = out["n_lines"] - np.bincount(distinct, minlength=n)
    # windows of five words found twice or more
    long_enough = np.where(n_words >= 5, n_words, 0)
    keep = np.repeat(n_words >= 5, n_words)
    window, window_owner = shingle_hashes(words[keep], np.concatenate([[0], np.cumsum(long_enough)]))
    which, counts = _seen(window_owner, window)
    n_windows = np.maximum(n_words - 4, 0)
    place = first[:-1][window_owner] + np.arange(len(window)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    cover = np.zeros(len(words) + 1, np.int64)
    twice = place[counts[which] > 1] if len(window) else place
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + 5, -1)
    repeated = np.cumsum(cover[:-1]) > 0
    out["n_repeat_words"] = np.bincount(owner[repeated], minlength=n)
    stutter = np.zeros(len(words), bool)
    stutter[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    out["n_stutters"] = np.bincount(owner[stutter], minlength=n)
    return {k: v.astype(np.int64) for k, v in out.items()}
