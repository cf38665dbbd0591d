from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names the operators use themselves
        T.StructField("n", T.IntegerType()),
        T.StructField("node", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_tokens", T.StringType()),
        T.StructField("at", T.StringType()),
    ]
)
CLASHES = len(DOCS) - 5


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(5)
    shared = "\n".join(sentence(rng, 8) for _ in range(4))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "s1", 0),
        (None, "no id here at all", "en", "s1", 17),
        (None, "no id here at all", "en", "s1", 17),
        (3, "   \n\t ", "en", None, 6),
        (4, "12345 67890 !!", None, "s2", 14),
        (5, "x", "fr", "s2", 1),
        (6, shared + "\n" + sentence(rng, 20), "en", "s1", 1),
        (7, "its own first line\n" + shared, "en", "s1", 1),
        (7, "its own first line\n" + shared, "en", "s1", 1),
        (8, "same line\n" * 6 + "end", "en", "s2", 1),
        (9, sentence(rng, 60_000), "en", "s1", 1),
        (10, "é" * 5_000 + "日本語 🎉 ​", "fr", "s1", 1),
        (11, "word " * 3_000, "en", "s2", 1),
    ]
    rows.append(rows[7])
    rows += [(100 + i, sentence(rng, 60), "en", "s1", 1) for i in range(12)]
    return [r + (7,) + ("x",) * (CLASHES - 1) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    from conftest import SF_DIR

    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
