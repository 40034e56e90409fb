import random

import pytest

HOSTILE = "ab 1'\n\t é日\xa0 .,sT▁İΣ́e²ǅ"


@pytest.fixture(scope="session")
def hostile_texts():
    """Short random texts of awkward characters, and cases that every operator must survive."""
    draw = random.Random(3)
    texts = ["".join(draw.choice(HOSTILE) for _ in range(draw.randint(0, 14))) for _ in range(400)]
    return texts + [
        None, "", "   ", " x", "<|endoftext|>", "a<|startoftext|>b <|endoftext|> C", "x\n <|endoftext|>", "<s> </s>",
        "word " * 3000, "é" * 5000, "ABC Don't WE'LL 123", "a\t b\n\n  c", "x   y", "same", "same", "same",
    ]


@pytest.fixture(scope="session")
def table(spark):
    """Documents from texts, with columns whose names the operators use themselves."""

    def build(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "x", 7, "y") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, rid string, n_tokens int, score string").repartition(3)

    return build


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_chars long")
