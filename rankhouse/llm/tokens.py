"""Exact token ids of whole text columns. Texts are cut where every encoder cuts anyway, equal pieces of a batch are
found by Arrow, and only pieces a worker has not met are encoded by the tokenizers library.

Byte-level BPE (its fixed pattern gives a space to what follows it): a cut before a space is certain unless that
space stands inside or at the end of a longer run of white space. Texts with such a run, or with a special token's
string, are given to the library whole."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces and bytes in each of a cache's two generations, whichever is reached first.
CACHE_PIECES, CACHE_BYTES = 200_000, 64 << 20
#: A piece of more characters is not kept: where words are not spaced, pieces are whole texts and hardly come again.
KEPT_CHARS = 96
#: The most bytes of an entry with its string and value: so many, and for each character 4 and its value's 16 (4 ids of 4 bytes).
_ENTRY, _EACH = 220, 20
#: Text bytes encoded at once: the larger, the more equal pieces meet.
SLICE_BYTES = 8 << 20

# White space, letters, digits as the encoders' pattern sees them below U+0250.
_SPACES = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_PLAIN = re.compile("[\t\n\r -~¡-ɏ]*")
_WORD = re.compile(f" ?[{_LETTERS}]+")
_TAIL = ".,;:!?"  # fixed value: marks that a word is followed by; the pattern cuts between a letter or digit and these
_PATTERN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+")


class PieceCache(dict):
    """piece -> value, bounded in entries and bytes: when the young generation is full it becomes the old one, which is dropped."""

    def __init__(self, encode: Callable, most: int = CACHE_PIECES, most_bytes: int = CACHE_BYTES):
        super().__init__()
        self.encode, self.most, self.most_bytes, self.held, self.old = encode, most, most_bytes, 0, {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            value = self.encode(piece)
        if len(piece) > KEPT_CHARS:
            return value
        size = _ENTRY + _EACH * len(piece)
        if len(self) >= self.most or self.held + size > self.most_bytes:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self[piece] = value
        self.held += size
        return value


def byte_letters() -> dict[int, int]:
    """Byte -> code point of the letter that byte-level vocabularies write for it: printable bytes stand for
    themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 0x100 + i for i, b in enumerate(rest)}


def gathered(values: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[codes] one after another as uint32, and the length of each."""
    lengths = np.fromiter(map(len, values), np.int64, len(values)) >> 2
    flat = np.frombuffer(b"".join(values), "<u4")
    n = lengths[codes]
    end = np.cumsum(n)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.repeat(((np.cumsum(lengths) - lengths)[codes] - (end - n)).astype(kind), n)
    at += np.arange(total, dtype=kind)
    return flat.take(at), n


class ByteTokens:
    """Ids of a byte-level BPE tokenizer file for whole columns, equal to its encode(text, add_special_tokens=False)."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = PieceCache(self._encode)

    def _encode(self, piece: str) -> bytes:
        if _WORD.fullmatch(piece):
            spelled = piece.replace(" ", "Ġ") if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        if not _PLAIN.fullmatch(piece):
            return self.whole(piece)
        parts = _PATTERN.findall(piece)
        if len(parts) != 1:
            return b"".join([self.cache[p] for p in parts])
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def piece(self, piece: str) -> bytes:
        """The ids of a piece. Marks after a word and a line break between words are pieces of their own, so that words are met again
        whatever follows them."""
        if "\n" in piece:
            head, _, rest = piece.partition("\n")
            if head and rest and not head[-1].isspace() and not rest[0].isspace():
                return self.piece(head) + self.cache["\n"] + self.piece(rest)
        core = piece.rstrip(_TAIL)
        if len(core) < len(piece) and core.isascii() and core[-1:].isalnum():
            return self.cache[core] + self.cache[piece[len(core) :]]
        return self.cache[piece]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        end = np.cumsum(counts)
        later = pc.list_flatten(pieces).dictionary_encode()
        codes = later.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = pc.list_element(pieces, 0).dictionary_encode()
        after_space = np.ones(len(codes), bool)
        after_space[end - counts] = False
        used = np.zeros(len(later.dictionary), bool)
        used[codes[after_space]] = True  # a piece that only begins texts has no space before it
        value = self.piece
        values = [value(" " + p) if u else b"" for p, u in zip(later.dictionary.to_pylist(), used.tolist())]
        codes[end - counts] = len(values) + first.indices.to_numpy(zero_copy_only=False)
        values += [value(p) if p else b"" for p in first.dictionary.to_pylist()]
        del pieces, later, first, after_space
        ids, n = gathered(values, codes)
        return ids, np.add.reduceat(n, end - counts) if len(n) else n

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column one after another (uint32), and the number of ids of each text."""
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        odd = pc.match_substring_regex(texts, rf"{_SPACES} (?:{_SPACES}|\z)")
        for content in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        odd = odd.to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._run(texts)
        edges = [0, *(np.flatnonzero(odd[1:] | odd[:-1]) + 1).tolist(), len(texts)]
        ids, lengths = [], []
        for low, high in zip(edges, edges[1:]):
            if odd[low]:
                found = [np.frombuffer(self.whole(t), "<u4") for t in texts.slice(low, high - low).to_pylist()]
                ids += found
                lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            elif high > low:
                some, n = self._run(texts.slice(low, high - low))
                ids.append(some)
                lengths.append(n)
        return np.concatenate(ids), np.concatenate(lengths)


_held: dict[tuple[str, str], object] = {}


def held(kind: Callable, path: str):
    """One encoder for each worker process and file; its cache serves all the worker's tasks."""
    key = (kind.__name__, path)
    if key not in _held:
        _held[key] = kind(path)
    return _held[key]
