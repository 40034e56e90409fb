"""BPE encoding and decoding with forced boundaries.

Two bytes that stand side by side in no token of the vocabulary can never be merged, so a cut between them is certain. No
token holds white space, so texts are first cut at spaces; what is between is normalised and split by the
tokenizer's fixed pattern and then cut at every forced boundary. Fragments are encoded independently by the tokenizers library's
BPE model and concatenated. The vocabulary marks word ends, so a fragment that ends its word takes the model with that mark and
any other takes the same merges without it. Fragments met before come from a bounded cache in the worker.

Defined results: null or empty text has no ids and decodes to an empty text; every row gives one row."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models

from rankhouse.llm import tokens
from rankhouse.llm.common import id_text, slices

# The tokenizer's pattern for texts whose letters are below U+0250, in lower case.
_LATIN = re.compile("[\t\n\r -~¡-ɏ]*")
_PATTERN = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{tokens._LETTERS}]+|[{tokens._DIGITS}]|[^\s{tokens._LETTERS}{tokens._DIGITS}]+")


class FragmentBpe:
    """A tokenizer file with a word-end BPE model, encoded fragment by fragment."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)["model"]
        self.suffix = spec["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["merges"]]
        inner = [m for m in merges if not m[1].endswith(self.suffix)]
        self.last = models.BPE(vocab=spec["vocab"], merges=merges, end_of_word_suffix=self.suffix)
        self.inner = models.BPE(vocab=spec["vocab"], merges=inner)
        self.letters = tokens.byte_letters()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.joined = bytearray(1 << 16)
        byte_of = {chr(letter): byte for byte, letter in self.letters.items()}
        for token in spec["vocab"]:
            if token not in self.special:
                spelled = [byte_of[c] for c in token.removesuffix(self.suffix)]
                for pair in zip(spelled, spelled[1:]):
                    self.joined[pair[0] << 8 | pair[1]] = 1
        size = max(max(spec["vocab"].values()), *added) + 1
        self.token = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.pieces = tokens.PieceCache(self.encode_piece)
        self.fragments = tokens.PieceCache(self.encode_fragment, tokens.CACHE_PIECES // 4, tokens.CACHE_BYTES // 4)

    def cuts(self, word: bytes) -> list[int]:
        """Where a forced boundary stands in the word."""
        return [i + 1 for i in range(len(word) - 1) if not self.joined[word[i] << 8 | word[i + 1]]]

    def encode_fragment(self, fragment: str) -> bytes:
        """``fragment`` in byte letters, with the word-end mark if it ends its word."""
        if fragment.endswith(self.suffix):
            found = self.last.tokenize(fragment[: -len(self.suffix)])
        else:
            found = self.inner.tokenize(fragment)
        return array("I", [t.id for t in found]).tobytes()

    def words(self, text: str) -> list[str]:
        """The normalised words of a text without special tokens, in byte letters."""
        if text.isascii():
            text = text.lower()
        else:
            text = self.tokenizer.normalizer.normalize_str(text)
        if _LATIN.fullmatch(text):
            found = _PATTERN.findall(text)
            return [w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in found]
        return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encode_piece(self, piece: str) -> bytes:
        out = []
        for part in self.at_special.split(piece) if self.at_special and "<" in piece else [piece]:
            if part in self.special:
                out.append(array("I", [self.special[part]]).tobytes())
                continue
            for word in self.words(part):
                raw = word.encode("latin-1") if word.isascii() else bytes(map(self.byte_of_letter, word))
                start = 0
                for cut in self.cuts(raw):
                    out.append(self.fragments[word[start:cut]])
                    start = cut
                out.append(self.fragments[word[start:] + self.suffix])
        return b"".join(out)

    def byte_of_letter(self, letter: str) -> int:
        if not hasattr(self, "_bytes"):
            self._bytes = {chr(v): k for k, v in self.letters.items()}
        return self._bytes[letter]

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column one after another (uint32), and the number of ids of each text."""
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        pieces = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        found = pc.list_flatten(pieces).dictionary_encode()
        values = [self.pieces[p] if p else b"" for p in found.dictionary.to_pylist()]
        ids, n = tokens.gathered(values, found.indices.to_numpy(zero_copy_only=False))
        return ids, np.add.reduceat(n, np.cumsum(counts) - counts) if len(counts) else counts

    def decode(self, ids: np.ndarray) -> str:
        """As the library: this file names no decoder, so its tokens are joined with spaces."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))


def bpe_round_trip(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Per document: n_tokens and digests of the ids and of the decoded text; ``with_ids`` adds both themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.held(FragmentBpe, tokenizer)
        for batch in slices(batches, most=tokens.SLICE_BYTES // 2):
            ids, n = encoder.column(batch.column("text"))
            per_text = np.split(ids, np.cumsum(n)[:-1])
            decoded = [encoder.decode(x) for x in per_text]
            columns = [
                batch.column("doc_id"),
                pa.array(n),
                pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in per_text]),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
            ]
            if with_ids:
                columns += [pa.array([x.tolist() for x in per_text], pa.list_(pa.int32())), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    return id_text(docs).mapInArrow(run, schema)


def op6_bpe_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    return bpe_round_trip(docs, tokenizer)
