"""The registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rankhouse.llm.archive import op2_token_archive
from rankhouse.llm.bpe import op6_bpe_round_trip
from rankhouse.llm.chat_format import op11_chat_format
from rankhouse.llm.common import read_table
from rankhouse.llm.fingerprints import op4_fingerprints
from rankhouse.llm.jaccard_join import op1_jaccard_join
from rankhouse.llm.packing import op10_best_fit_packing
from rankhouse.llm.periodic_runs import op12_periodic_runs
from rankhouse.llm.quality_classifier import op5_quality_classifier
from rankhouse.llm.quality_rules import op7_quality_rules
from rankhouse.llm.suffix_dedup import op9_suffix_dedup
from rankhouse.llm.token_counts import op8_token_counts
from rankhouse.llm.toxicity import op3_toxicity
from rankhouse.llm.vector_codes import op13_vector_codes


def _over(operator: Callable, table: str = "documents", tokenizer: str | None = None, labels: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = [read_table(spark, sf_dir, table)]
        if labels:
            inputs.append(read_table(spark, sf_dir, "labels"))
        if tokenizer:
            inputs.append(public_tokenizers.path(tokenizer))
        return operator(*inputs)

    return query


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": _over(op1_jaccard_join),
    "op2_token_archive": _over(op2_token_archive, tokenizer="byte_bpe_50k.json"),
    "op3_toxicity": _over(op3_toxicity, labels=True),
    "op4_fingerprints": _over(op4_fingerprints),
    "op5_quality_classifier": _over(op5_quality_classifier, labels=True),
    "op6_bpe_round_trip": _over(op6_bpe_round_trip, tokenizer="word_bpe_49k.json"),
    "op7_quality_rules": _over(op7_quality_rules, labels=True),
    "op8_token_counts": _over(op8_token_counts, tokenizer="piece_bpe_32k.model"),
    "op9_suffix_dedup": _over(op9_suffix_dedup),
    "op10_best_fit_packing": _over(op10_best_fit_packing, tokenizer="byte_bpe_50k.json"),
    "op11_chat_format": _over(op11_chat_format, "conversations"),
    "op12_periodic_runs": _over(op12_periodic_runs),
    "op13_vector_codes": _over(op13_vector_codes, "embeddings"),
}
LLM_ORACLE: dict[str, str] = {}
