"""From documents to training sequences: junk goes, one of each group of near copies stays, repeated passages are cut out, and what is
left is packed. Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; the labels come from sf_dir.

An empty table passes through every stage; documents with null or empty texts are judged like others, never linked, and packed as a
single end id if they are kept; columns beside doc_id and text are carried along up to the last stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rankhouse.llm import jaccard_join, packing, quality_classifier, quality_rules, suffix_dedup
from rankhouse.llm.common import read_table, written
from rankhouse.sources.staging import owned, remove, staged_path


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below 0.3 go."""
    return quality_classifier.keep_good(docs, read_table(spark, sf_dir, "labels"), 0.3)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a risk-controlled cutoff go."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 stays, that of the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes and more that start anywhere else are cut out of the texts; every document stays."""
    return suffix_dedup.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids with their places in the training sequences."""
    return packing.op10_best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", classify_quality),
    ("quality_rules", apply_rules),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the classifier nor the rest of the chain; tests/llm holds it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet to the shared folder and read again by the next. What a stage has staged on
    its way goes when its documents are written, and these when the next stage's are. The last one's rows are read from what it staged."""
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        path = staged_path(spark, f"llm-{name}")
        with owned(spark):
            docs = written(function(spark, docs, sf_dir), path)
        if last:
            remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
