"""The pipeline on the smallest tables, stage by stage, and on what must not stop it."""

import corpus_pipeline
import pytest
from llm_cases import empty, hostile_texts, table  # noqa: F401
from rankhouse.llm.common import read_table
from test_jaccard_join import brute as components
from test_quality import brute_measures
from test_suffix_dedup import brute as removals

import __spark_entry__ as driver


def test_stages(spark, small):
    documents = read_table(spark, small, "documents")
    docs, seen = documents, {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, function(spark, docs, small).cache()
        seen[name] = (before.collect(), docs.collect())
        if name != "best_fit_packing":
            assert docs.columns == documents.columns
    judged, kept = seen["quality_rules"]
    left = {r.doc_id for r in kept}
    for r in judged:
        n, _, _, _, repeat = brute_measures(r.text)
        assert r.doc_id not in left or not (n < 10 or 100 * repeat > 20 * n)
    joined, kept = seen["jaccard_join"]
    found, _ = components([(r.doc_id, r.text) for r in joined])
    assert sorted(r.doc_id for r in kept) == sorted({lowest for _, n, lowest, _ in found if n} | {i for i, n, *_ in found if not n})
    whole, cut = seen["suffix_dedup"]
    texts = {r.doc_id: r.text for r in cut}
    expected = {i: size - gone for i, size, gone, _, _ in removals([(r.doc_id, r.text) for r in whole])}
    assert all(0 <= len(texts[i].encode()) - size <= 12 for i, size in expected.items())  # characters cut in part stay
    packed = seen["best_fit_packing"][1]
    assert {r.doc_id for r in packed} == set(texts)
    for frame in (documents,):
        frame.unpersist()


def test_run_is_the_chain(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and rows.count() > 0


def test_awkward_rows(spark, table, small, hostile_texts):
    docs = table(hostile_texts + ["a b c d e f g h i j k"] * 2, [*range(len(hostile_texts)), None, 4])
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, small)
    assert docs.count() > 0


@pytest.mark.parametrize("stage", range(5))
def test_empty_table(spark, small, empty, stage):
    assert corpus_pipeline.STAGES[stage][1](spark, empty, small).count() == 0


def test_registered():
    names = [name for name in driver.queries() if name.startswith("op") or name == "pipeline"]
    assert {name.split("_")[0] for name in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
