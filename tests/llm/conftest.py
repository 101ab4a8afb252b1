"""Rows that operators must not stumble over."""

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row int, key string, size string,"
    " shard string, slot int, node string, rank string, kept string, place int, copies int, bucket long, quality string"
)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(words)) + "."


LONG = prose(99, 40_000)
TEXTS = [
    (1, prose(1, 120)),
    (1, prose(1, 120)),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, LONG),
    (6, prose(6, 3)),
    (None, prose(7, 80)),
    (None, prose(8, 80)),
    (7, prose(1, 120)),
    (8, prose(1, 120).upper() + " \n"),
    (9, "日本語 テキスト é̀ ß 𝒳 " * 30),
    (10, "#$% | *** " * 40),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like those operators make."""
    rows = [
        (doc_id, text, None, None if n % 3 == 0 else f"s{n % 3}", None, n, "k", None, "x", n, "x", "x", None, n, n, n, "q")
        for n, (doc_id, text) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
