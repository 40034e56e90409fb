"""Measures, rules and classifiers: brute force for what is exact, held-out accuracy for what is learnt."""

import math
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_cases import empty, hostile_texts, table  # noqa: F401
from rankhouse.llm import quality_classifier, quality_rules, toxicity
from rankhouse.llm.common import as_bytes
from rankhouse.llm.measures import measure
from rankhouse.llm.quality_classifier import FactorisationMachine, N_FEATURES, held_out, op5_quality_classifier
from rankhouse.llm.quality_rules import CUTOFFS, DOUBT, PENALTY, RISK, STRATA, choose_cutoffs, exceeds, judge, lower_tail, op7_quality_rules, upper_bound
from rankhouse.llm.toxicity import BlockMaxIndex, op3_toxicity

MEDIUM = "/root/testdata/sf0.1"


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    seen, same = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            same += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), same, len(repeated)


@pytest.fixture(scope="module")
def texts(hostile_texts):
    draw = random.Random(9)
    lines = ["a b c", "x\ty", " ", "", "a b c d e f g", "é#& |", "a b c d e a b c d e"]
    return hostile_texts + ["\n".join(draw.choice(lines) for _ in range(draw.randint(0, 9))) for _ in range(150)]


def test_measures(texts):
    found = measure(*as_bytes(pa.array(texts)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(texts):
        assert tuple(int(found[n][i]) for n in names) == brute_measures(text), text


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_rules_query(spark, table, texts):
    labels = labels_of(spark, [(0, 1, 0), (0, 0, 0), (1, None, 0), (None, 1, 0)])
    rows = {r.doc_id: r for r in op7_quality_rules(table(texts), labels).collect()}
    for i, text in enumerate(texts):
        n, *rest, repeat = brute_measures(text)
        failed = n < 10 or 100 * repeat > 20 * n
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, *rest, repeat, failed)
        assert r.kept == (not failed)  # two labels cannot admit any cutoff


def test_upper_bound_is_exact():
    for k, n, doubt in ((0, 50, 0.05), (3, 40, 0.01), (10, 12, 0.2), (0, 1, 0.5)):
        p = upper_bound(k, n, doubt)
        assert math.isclose(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), doubt, rel_tol=1e-6)
    assert upper_bound(5, 5, 0.1) == 1.0


def test_tail_is_the_sum_of_its_terms():
    for most, of, share in ((0, 9, 0.1), (4, 30, 0.1), (4, 30, 0.02), (25, 30, 0.4), (12, 700, 0.008), (3, 900, 0.008), (29, 30, 0.99)):
        exact = math.fsum(math.comb(of, k) * share**k * (1 - share) ** (of - k) for k in range(most + 1))
        assert math.isclose(lower_tail(most, of, share), exact, rel_tol=1e-9), (most, of, share)
    assert lower_tail(5, 5, 0.3) == 1.0 and lower_tail(2, 9, 1.0) == 0.0


def test_bounds_of_very_many_labels():
    """Steps grow with the square root of the labels: a sum over the rejected documents would be 800,000 terms long."""
    started = time.monotonic()
    for rejected, above in ((700_000, False), (833_000, True), (0, False)):
        assert exceeds(rejected, 100_000_000, 0.05 / 18, 0.05 / 6) == above
    assert time.monotonic() - started < 5


def brute_rules(text):
    """The six measures of the rules in plain Python."""
    n, _, symbols, same, repeat = brute_measures(text)
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) for line in text.split("\n"))
    upper = len(re.findall("[A-Z]", text))
    letters = sum(c.isascii() and c.isalpha() or 0xC0 <= ord(c) <= 0x10FFFF for c in text)
    stutters = sum(a == b for a, b in zip(words, words[1:]))
    shares = {"symbols": (symbols, n), "repeats": (repeat, n), "stutters": (stutters, n), "same_lines": (same, lines)}
    shares |= {"shouts": (text.count("!"), n), "capitals": (upper, letters)}
    return n, repeat, {name: part / max(whole, 1) for name, (part, whole) in shares.items()}


def test_kept_equals_plain_python(spark):
    """Cutoffs that are admitted, and what they keep, from documents and labels alone."""
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: brute_rules(r.text) for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    failed = {i: n < 10 or 100 * repeat > 20 * n for i, (n, repeat, _) in texts.items()}
    stratum = {i: sum(n >= bound for bound in STRATA) for i, (n, _, _) in texts.items()}
    names, chosen = list(texts[0][2]), {}
    for rule in names:
        for s in range(len(STRATA) + 1):
            own = [i for i in texts if i in quality and not failed[i] and stratum[i] == s]
            good, best = sum(quality[i] for i in own), 0
            for cutoff in CUTOFFS:
                hit = [i for i in own if texts[i][2][rule] >= cutoff]
                lost = sum(quality[i] for i in hit)
                allowed = RISK / len(names)
                tail = math.fsum(math.comb(good, k) * allowed**k * (1 - allowed) ** (good - k) for k in range(lost + 1))
                if not good or lost > allowed * good or tail > DOUBT / (len(names) * (len(STRATA) + 1)):
                    break
                gain = len(hit) - lost - PENALTY * lost
                if gain > best:
                    best, chosen[rule, s] = gain, cutoff
    assert chosen  # some are admitted here
    expected = {i: not failed[i] and not any(s == stratum[i] and texts[i][2][rule] >= c for (rule, s), c in chosen.items()) for i in texts}
    assert {r.doc_id: r.kept for r in op7_quality_rules(docs, labels).select("doc_id", "kept").collect()} == expected
    assert sum(not failed[i] and not expected[i] for i in texts) > 100


def test_rules_of_an_empty_table(spark, empty):
    assert op7_quality_rules(empty, labels_of(spark, [(0, 1, 0)])).count() == 0
    assert op7_quality_rules(empty, labels_of(spark, [])).count() == 0


def test_cutoffs_keep_their_promise():
    draw, broken = np.random.default_rng(2), 0
    for _ in range(60):
        good, bad = draw.beta(1, 30, 3000), draw.beta(3, 3, 600)
        table = np.array([[(good >= c).sum(), len(good), (bad >= c).sum()] for c in CUTOFFS])
        cutoff = choose_cutoffs({("rule", 0): table}, risk=0.02, doubt=0.05)["rule", 0]
        assert (bad >= cutoff).mean() > 0.7
        broken += (1 - cutoff) ** 30 > 0.02  # the true share of good documents beyond the cutoff
    assert broken <= 60 * 0.05 + 3


def test_no_cutoff_without_evidence():
    assert choose_cutoffs({("rule", 0): np.array([[0, 40, 9]] * len(CUTOFFS))}) == {}
    assert choose_cutoffs({("rule", 0): np.zeros((len(CUTOFFS), 3), np.int64)}) == {}


def test_rules_find_junk_and_spare_good_documents(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    counts = judge(docs, labels).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    counts = {(r.quality, r.kept): r["count"] for r in counts}
    assert counts.get((1, False), 0) <= 0.02 * counts[1, True]
    assert counts.get((0, False), 0) > counts.get((0, True), 0)


def test_pairs_in_linear_time():
    model = FactorisationMachine(0.3)
    draw = np.random.default_rng(5)
    model.linear, model.pair = draw.normal(size=N_FEATURES), draw.normal(size=model.pair.shape)
    feature, value = np.array([3, 70, 9, 4000, 12]), draw.normal(size=5)
    margins, _ = model.sums(np.array([0, 3]), feature, value)
    for (low, high), margin in zip(((0, 3), (3, 5)), margins):
        expected = model.bias + sum(model.linear[feature[i]] * value[i] for i in range(low, high))
        expected += sum(model.pair[feature[i]] @ model.pair[feature[j]] * value[i] * value[j] for i in range(low, high) for j in range(low, i))
        assert math.isclose(margin, expected)


def auc(rows, column):
    ranked = sorted(rows, key=lambda r: r.score)
    positive = [i for i, r in enumerate(ranked) if r[column]]
    n, m = len(positive), len(ranked) - len(positive)
    return (sum(positive) - n * (n - 1) / 2) / (n * m)


@pytest.mark.parametrize(("query", "column", "least"), [(op5_quality_classifier, "quality", 0.99), (op3_toxicity, "toxic", 0.93)], ids=["quality", "toxicity"])
def test_held_out_accuracy(spark, query, column, least):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    scored = query(docs, labels).cache()
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert scored.count() == docs.count() and auc(rows, column) > least
    assert all(0 <= r.score <= 1 for r in rows)
    scored.unpersist()


@pytest.mark.parametrize("query", [op5_quality_classifier, op3_toxicity])
def test_without_labels_and_with_hostile_texts(spark, table, empty, hostile_texts, query):
    none = labels_of(spark, [])
    found = query(table(hostile_texts), none).collect()
    assert len(found) == len(hostile_texts) and {r.score for r in found} == {0.5}
    some = labels_of(spark, [(i, i % 2, int(i % 3 == 0)) for i in range(60)] + [(5, 1 - 5 % 2, 0), (None, 1, 1), (7, None, None)])
    found = query(table(hostile_texts), some).collect()
    assert len(found) == len(hostile_texts) and all(0 <= r.score <= 1 for r in found)
    assert query(empty, some).count() == 0 and query(empty, none).count() == 0


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out(5, 0).alias("h"), held_out(3, 1).alias("t")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.t == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_nearest_is_exact():
    draw, n, n_terms = np.random.default_rng(6), 700, 40
    sizes = draw.integers(0, 6, n)
    first = np.concatenate([[0], np.cumsum(sizes)])
    term = np.concatenate([np.sort(draw.choice(n_terms, s, replace=False)) for s in sizes]).astype(np.int64)
    weight = draw.random(len(term)) + 0.1
    for a, b in zip(first, first[1:]):
        weight[a:b] /= np.linalg.norm(weight[a:b]) or 1
    index = BlockMaxIndex(first, term, weight, draw.integers(0, 2, n), np.arange(n), n_terms)
    dense = np.zeros((len(index.ids), n_terms))
    for i in range(len(index.ids)):
        span = slice(index.first[i], index.first[i + 1])
        dense[i, index.term[span]] = index.weight[span]
    for i in np.flatnonzero(sizes)[:80]:
        query = np.zeros(n_terms)
        query[term[first[i] : first[i + 1]]] = weight[first[i] : first[i + 1]]
        _, cosine = index.nearest(term[first[i] : first[i + 1]], weight[first[i] : first[i + 1]], 10)
        expected = np.sort(dense @ query)[::-1][:10]
        assert np.allclose(cosine, expected[expected > 0][: len(cosine)]) and len(cosine) == min(10, (dense @ query > 0).sum())


def test_nearest_is_exact_over_posting_lists():
    """Many blocks, common and rare terms, weights that differ widely, several queries at once; ties do not depend on doc_ids."""
    draw, n, n_terms = np.random.default_rng(8), 1_500, 4_000
    share = 1 / np.arange(1, n_terms + 1)
    sizes = draw.integers(1, 60, n)
    first = np.concatenate([[0], np.cumsum(sizes)])
    term = np.concatenate([np.sort(draw.choice(n_terms, s, replace=False, p=share / share.sum())) for s in sizes])
    weight = draw.random(len(term)) ** 4 * 50 + 0.1
    weight /= np.repeat(np.sqrt(np.add.reduceat(weight * weight, first[:-1])), sizes)
    toxic, ids = draw.integers(0, 2, n), np.arange(n)
    index = BlockMaxIndex(first, term, weight, toxic, ids, n_terms)
    assert index.blocks > 20 and 0 < index.rows.shape[1] < n_terms / 10 and len(index.posting)
    dense = np.zeros((len(index.ids), n_terms))
    for i in range(len(index.ids)):
        span = slice(index.first[i], index.first[i + 1])
        dense[i, index.term[span]] = index.weight[span]
    queries = [(term[a:b], weight[a:b]) for a, b in zip(first[:150], first[1:151])]
    found = index.nearest_of_all(queries, 24)
    for (t, w), (at, product) in zip(queries, found):
        every = dense[:, t] @ w
        expected = np.sort(every)[::-1][:24]
        assert np.allclose(product, expected[expected > 1e-12], rtol=1e-5) and np.allclose(product, every[at], rtol=1e-5)
    turned = BlockMaxIndex(first, term, weight, toxic, ids[::-1], n_terms)  # other doc_ids, the same neighbours
    for (at, _), (other, _) in zip(found, turned.nearest_of_all(queries, 24)):
        assert (at == other).all()  # positions; equal vectors are one example, known by its lowest doc_id


def test_index_is_built_in_little_memory(monkeypatch):
    """The driver builds the index: beside the vectors it holds little more than what it keeps. Pieces of any size give the same index."""
    draw, n, each, n_terms = np.random.default_rng(9), 3_000, 200, 60_000
    term = np.concatenate([np.sort(draw.choice(n_terms, each, replace=False)) for _ in range(n)]).astype(np.int32)
    weight = draw.random(n * each).astype(np.float32)
    weight[:each], term[:each] = weight[each : 2 * each], term[each : 2 * each]  # two examples with one vector
    first, toxic = np.arange(n + 1) * each, draw.integers(0, 2, n)
    monkeypatch.setattr(toxicity, "PIECE", 20_000, raising=False)
    tracemalloc.start()
    index = BlockMaxIndex(first, term, weight, toxic, np.arange(n), n_terms)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * len(term), peak / len(term)
    # every posting: the term's examples in the index's order, and its entries' largest weights
    assert len(index.ids) == n - 1 and index.votes.sum() == n and len(index.posting) == (n - 1) * each
    owner = np.repeat(np.arange(n - 1), np.diff(index.first))
    order = np.lexsort((owner, index.term))
    block = np.repeat(index.entry_block, np.diff(index.entry_posting))
    assert (block * toxicity.BLOCK + index.posting == owner[order]).all() and (index.posting_weight == index.weight[order]).all()
    assert (index.entry_max == np.maximum.reduceat(index.weight[order], index.entry_posting[:-1])).all()
    by_entry = np.repeat(np.arange(n_terms), np.diff(index.by_term))
    assert (np.repeat(by_entry, np.diff(index.entry_posting)) == index.term[order]).all()


def test_labels_are_no_inputs(spark, table):
    texts = ["one two three four five six seven eight nine ten"] * 4 + ["you idiot loser moron"] * 4
    labels = labels_of(spark, [(i, 1, int(i > 3)) for i in range(8)])
    assert len({(r.score) for r in toxicity.scored(table(texts[:4]), toxicity.fit(table(texts), labels)).collect()}) == 1
    kept = quality_classifier.keep_good(table(texts).withColumn("extra", F.lit(1)), labels)
    assert kept.columns[-1] == "extra" and quality_rules.keep_good(table(texts), labels).columns == table(texts).columns


def test_every_term_counts(spark, table):
    """Rare toxic wording finds its example, and a text's other words lower the cosine."""
    draw = random.Random(4)
    clean = [" ".join(f"w{draw.choice('abcdefghij')}{draw.choice('klmnopqrst')}" for _ in range(30)) for _ in range(60)]
    texts = [*clean, "zorblat quenk mivvit", "zorblat quenk mivvit unseenword", "zorblat " + clean[0]]
    labels = labels_of(spark, [(i, 1, int(i == 60)) for i in range(61)])
    rows = {r.doc_id: r for r in toxicity.scored(table(texts), toxicity.fit(table(texts), labels)).collect()}
    counts = [Counter(re.findall("[a-z]+", t)) for t in texts]
    documents = Counter(w for c in counts for w in c)
    weight = lambda c: {w: (1 + math.log(n)) * (math.log((len(texts) + 1) / (documents[w] + 1)) + 1) for w, n in c.items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    for i in (61, 62):
        a = weight(counts[i])
        cosine = {j: sum(a.get(w, 0) * x for w, x in b.items()) / length(a) / length(b) for j, b in enumerate(map(weight, counts[:61]))}
        best = sorted(cosine, key=lambda j: -cosine[j])[:3]
        for found, j in zip(rows[i].evidence, best):
            assert math.isclose(found.similarity, cosine[j], rel_tol=1e-5) and (cosine[j] < 1e-9 or found.doc_id == j)
    assert rows[61].evidence[0].doc_id == 60 and 0 < rows[62].evidence[0].similarity < 1


def test_calibration_uses_every_example(spark, table, monkeypatch):
    """Labels that differ along doc_id: all examples' votes reach the fit, each without its own."""
    seen, texts = [], [f"even odd{i % 7} t{i % 11}" for i in range(3_400)]
    monkeypatch.setattr(toxicity.ToxicityModel, "calibrate", lambda self, shares, labels, *_: seen.extend(zip(shares, labels)))
    toxicity.fit(table(texts), labels_of(spark, [(i, 1, int(i >= 3_200)) for i in range(3_400)]))
    assert len(seen) == 3_400 and sum(label for _, label in seen) == 200


def test_calibrated_beyond_the_first_examples(spark, table):
    """Only examples of high doc_id are toxic, by one word: their like scores high."""
    texts = [f"w{i % 7} v{i % 11}" + (" vile" if i >= 3_200 else "") for i in range(3_401)]
    labels = labels_of(spark, [(i, 1, int(i >= 3_200)) for i in range(3_400)])
    rows = {r.doc_id: r.score for r in toxicity.scored(table(texts), toxicity.fit(table(texts), labels)).collect()}
    assert rows[3_400] > 0.7 and max(rows[i] for i in range(3_200)) < 0.3
