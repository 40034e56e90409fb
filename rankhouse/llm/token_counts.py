"""Token counts by a sentencepiece BPE model without shuffling pre-tokens.

A pre-token is a run of spaces with what follows it up to the next space. No piece of such a vocabulary has a space after
another character (checked when the model is loaded), so no merge crosses from one pre-token into the next and counts add up.
First tier: a table of the corpus's frequent pre-tokens and their counts, at most FREQUENT entries, broadcast; each
task summarises what it reads in at most SUMMARY entries, and only these summaries are added up. Second tier: a bounded
cache in each worker, which encodes what it has not met. Any table gives the same counts; a better one is only faster.

Defined results: null or empty text has 0 bytes and 0 tokens; every row gives one row, also with null or equal doc_ids."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from rankhouse.llm import tokens
from rankhouse.llm.common import id_text, slices

FREQUENT = 32_768  # entries of the broadcast table, about 3 MB
SUMMARY = 8_192  # entries of a task's summary
_MARK = "▁"  # fixed value: the letter that sentencepiece writes for a space
_PRETOKEN = re.compile(" *[^ ]+| +")


class PieceCounter:
    """pre-token without its first space -> number of tokens, with a bounded cache."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces):
            raise ValueError("this vocabulary has pieces that cross from one pre-token into the next")
        self.cache = tokens.PieceCache(self.count)

    def count(self, piece: str) -> int:
        return len(self.model.encode(piece, num_threads=1)) if piece else 1  # the space alone


def pretokens(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All pre-tokens without their first spaces, as a dictionary array, and the number of them in each text. The model puts a
    space before every text that isn't empty."""
    texts = pc.replace_substring(pc.cast(pc.fill_null(texts, ""), pa.large_string()), _MARK, " ")
    odd = pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " "))
    pieces = pc.split_pattern(texts, " ")
    if pc.any(odd).as_py():  # runs of spaces stay with the pre-token that they begin
        rows = pieces.to_pylist()
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            rows[i] = [p[1:] for p in _PRETOKEN.findall(" " + texts[i].as_py())]
        pieces = pa.array(rows, pa.large_list(pa.large_string()))
    counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    found = pc.list_flatten(pieces)
    return found.dictionary_encode(), np.where(pc.equal(texts, "").to_numpy(zero_copy_only=False), -counts, counts)


def frequent_pretokens(texts: DataFrame, entries: int = FREQUENT, summary: int = SUMMARY) -> list[str]:
    """The pre-tokens that the tasks' summaries name most often, at most ``entries``, most frequent first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in slices(batches, most=tokens.SLICE_BYTES):
            found, _ = pretokens(batch.column("text"))
            n = np.bincount(found.indices.to_numpy(zero_copy_only=False), minlength=len(found.dictionary))
            top = np.argsort(-n, kind="stable")[: 4 * summary]
            seen.update(dict(zip(found.dictionary.take(pa.array(top)).to_pylist(), n[top].tolist())))
            if len(seen) > 8 * summary:
                seen = Counter(dict(seen.most_common(4 * summary)))
        if seen:
            best = seen.most_common(summary)
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in best]), pa.array([n for _, n in best], pa.int64())], names=["piece", "n"])

    counted = texts.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return [r["piece"] for r in counted.orderBy(F.desc("n"), "piece").limit(entries).collect()]


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the tokens exceed ``limit``."""
    texts = id_text(docs)
    counter = PieceCounter(model)
    table = docs.sparkSession.sparkContext.broadcast({p: counter.count(p) for p in frequent_pretokens(texts)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = table.value, tokens.held(PieceCounter, model).cache
        for batch in slices(batches, most=tokens.SLICE_BYTES):
            found, per_text = pretokens(batch.column("text"))
            n = np.array([first[p] if p in first else second[p] for p in found.dictionary.to_pylist()], np.int64)
            sums = np.concatenate([[0], np.cumsum(n[found.indices.to_numpy(zero_copy_only=False)])])
            end = np.cumsum(np.abs(per_text))
            total = np.where(per_text < 0, 0, sums[end] - sums[end - np.abs(per_text)])
            size = pc.cast(pc.binary_length(batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(total), pa.array(total > limit)], names=names)

    names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op8_token_counts(docs: DataFrame, model: str) -> DataFrame:
    return token_counts(docs, model)
