"""Token operators against the libraries they stand in for."""

import hashlib
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm_cases import empty, hostile_texts, table  # noqa: F401
from rankhouse.llm.archive import decode, encode, op2_token_archive, read_archive, write_archive
from rankhouse.llm.bpe import FragmentBpe, op6_bpe_round_trip
from rankhouse.llm.packing import op10_best_fit_packing, pack, plan, sequences
from rankhouse.llm.token_counts import op8_token_counts
from rankhouse.llm.tokens import ByteTokens, PieceCache
from rankhouse.sources.staging import fresh_path

BYTES, WORDS, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def expected_ids(hostile_texts):
    tokenizer = Tokenizer.from_file(BYTES)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in hostile_texts]


def test_archive(table, hostile_texts, expected_ids):
    rows = {r.doc_id: r for r in op2_token_archive(table(hostile_texts), BYTES).collect()}
    assert len(rows) == len(hostile_texts)
    start = 0
    for i, ids in enumerate(expected_ids):
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_archive_gives_the_ids_back(spark, table):
    path = fresh_path(spark, "archive-test")
    write_archive(table(["b c", "a", None], [2, 1, None]), path, BYTES)
    rows = read_archive(spark, path, with_ids=True).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(BYTES)
    assert [(r.doc_id, r.ids) for r in rows] == [(None, [2]), (1, [*tokenizer.encode("a").ids, 2]), (2, [*tokenizer.encode("b c").ids, 2])]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300), st.integers(1, 60))
def test_codec_round_trip(ids, repeat):
    ids = np.array(ids * repeat, "<u4")
    assert (decode(encode(ids)) == ids).all()


def test_codec_over_blocks_and_checksum():
    ids = (np.random.default_rng(1).zipf(1.3, 30_000) % 50_000).astype("<u4")
    ids[10_000:20_000] = ids[:10_000]
    payload = encode(ids)
    assert (decode(payload) == ids).all() and len(payload) < 2 * len(ids)
    broken = bytearray(payload)
    broken[-40] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        decode(bytes(broken))


@pytest.mark.parametrize("kinds", [65_536, 65_537, 300_000])
def test_codec_of_large_vocabularies(kinds):
    """As many different ids as a vocabulary may have: the code space follows."""
    draw = np.random.default_rng(kinds)
    ids = np.concatenate([draw.permutation(kinds), draw.integers(0, kinds, 9_000), np.full(5_000, 7)]).astype("<u4") * 3
    assert (decode(encode(ids)) == ids).all()


def test_bpe_round_trip(table, hostile_texts):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = {r.doc_id: r for r in op6_bpe_round_trip(table(hostile_texts), WORDS).collect()}
    for i, text in enumerate(hostile_texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        digests = (hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (len(ids), *digests), text


def test_forced_boundaries_stand_in_no_token():
    encoder = FragmentBpe(WORDS)
    cut = [(a, b) for a in range(256) for b in range(256) if not encoder.joined[a << 8 | b]]
    assert 30_000 < len(cut) < 65_536
    byte_of = {chr(v): k for k, v in encoder.letters.items()}
    pairs = {(byte_of[x], byte_of[y]) for t in encoder.tokenizer.get_vocab() if not t.startswith("<|") for x, y in zip(t.removesuffix("</w>"), t.removesuffix("</w>")[1:])}
    assert not pairs & set(cut)


def test_token_counts(table, hostile_texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = {r.doc_id: r for r in op8_token_counts(table(hostile_texts), PIECES).collect()}
    for i, text in enumerate(hostile_texts):
        n = len(model.encode(text or ""))
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len((text or "").encode()), n, n > 4096), text


def test_packing(table, hostile_texts, expected_ids):
    rows = op10_best_fit_packing(table(hostile_texts), BYTES).collect()
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, ids in enumerate(expected_ids):
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, crc(ids[at : at + r.length]))
            assert r.length == 1024 or k == 0
            at += r.length
        assert at == len(ids)
    for seats in places.values():
        at = 0
        for offset, length in sorted(seats):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(map(len, expected_ids))
    assert len(places) <= -(-total // 1024) + 1


def test_packed_sequences_hold_the_ids(table):
    found = sequences(pack(table(["a b c", "d", ""]), BYTES, with_ids=True)).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    assert sorted(found[0].ids) == sorted([*tokenizer.encode("a b c").ids, *tokenizer.encode("d").ids, 2, 2, 2]) and len(found) == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=20, max_size=20))
def test_plan_seats_every_rank_once(counts):
    capacity, counts = 20, np.array([0, *counts])
    rows = plan(counts, capacity).tolist()
    filled = {}
    for k, (length, rank, first, each, offset) in enumerate(rows):
        following = rows[k + 1][1] if k + 1 < len(rows) and rows[k + 1][0] == length else counts[length]
        for r in range(rank, following):
            filled.setdefault(first + (r - rank) // each, []).append((offset + (r - rank) % each * length, length))
    assert sum(map(len, filled.values())) == counts.sum()
    for seats in filled.values():
        at = 0
        for offset, length in sorted(seats):
            assert offset == at
            at += length
        assert at <= capacity
    total = int((counts * np.arange(capacity + 1)).sum())
    assert len(filled) <= max(-(-total // capacity), 11 * -(-total // capacity) // 9 + 1)


def test_piece_cache_is_bounded():
    cache = PieceCache(len, 3)
    assert [cache["x" * i] for i in range(20)] == list(range(20)) and len(cache) + len(cache.old) <= 6


def test_piece_cache_is_bounded_in_bytes():
    cache = PieceCache(lambda piece: piece.encode(), most_bytes=50_000)
    held = lambda: sum(sys.getsizeof(k) + sys.getsizeof(v) for part in (cache, cache.old) for k, v in part.items())
    for i in range(3_000):
        piece = chr(0x4E00 + i) * (i % 400)
        assert cache[piece] == piece.encode() and held() < 100_000
    assert all(len(k) < 100 for k in cache)


def test_unspaced_texts(table):
    """Pieces are whole texts there: exact, encoded once, and not kept."""
    texts = [chr(0x4E00 + i) * 3 + "的" * (i % 3_000) + "日本語テキスト" * (i % 50) for i in range(120)] + ["ไทย" * 2_000]
    encoder, calls = ByteTokens(BYTES), []
    encode = encoder.cache.encode
    encoder.cache.encode = lambda piece: calls.append(piece) or encode(piece)
    ids, n = encoder.column(pa.array(texts))
    tokenizer = Tokenizer.from_file(BYTES)
    assert np.split(ids, np.cumsum(n)[:-1])[-1].tolist() == tokenizer.encode(texts[-1], add_special_tokens=False).ids
    assert ids.tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
    assert calls == texts  # none with a space in front
    assert sum(map(len, encoder.cache)) < 60_000
    model, words = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(WORDS)
    counted = {r.doc_id: r.n_tokens for r in op8_token_counts(table(texts), PIECES).collect()}
    round_trip = {r.doc_id: r.n_tokens for r in op6_bpe_round_trip(table(texts), WORDS).collect()}
    for i, text in enumerate(texts):
        assert (counted[i], round_trip[i]) == (len(model.encode(text)), len(words.encode(text, add_special_tokens=False).ids))


def test_empty_table(empty):
    for frame in (op2_token_archive(empty, BYTES), op6_bpe_round_trip(empty, WORDS), op8_token_counts(empty, PIECES), op10_best_fit_packing(empty, BYTES)):
        assert frame.count() == 0


def test_single_block_of_a_segment():
    from rankhouse.llm.archive import BLOCK

    ids = np.random.default_rng(8).integers(0, 300, 3 * BLOCK + 17).astype(np.uint32)
    payload = encode(ids)
    for block in range(4):
        assert np.array_equal(decode(payload, only=block), ids[block * BLOCK : (block + 1) * BLOCK])
    last = payload[:-12] + bytes([payload[-12] ^ 255]) + payload[-11:]
    assert np.array_equal(decode(last, only=0), ids[:BLOCK])
    with pytest.raises(ValueError, match="block 3"):
        decode(last, only=3)
