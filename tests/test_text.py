import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.functions.text import clean_text, keyword_phrases, segment_label, truncate
from sessionloom.operators.textsignals import embed_texts, embedding_pipeline, normalised, process_sessions_text


def _one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr("t")).first()[0]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("AI Laptops | Gaming Mice | Best Deals", "AI Laptops Gaming Mice Best Deals"),
        ("hello   world  |  foo", "hello world foo"),
        ("", ""),
        (None, ""),
        ("||a||b||", "a b"),
        ("a  b\tc\n\x0b\x1cd\x85e", "a b c d e"),
    ],
)
def test_clean(spark, raw, cleaned):
    assert _one(spark, raw, clean_text) == cleaned


@pytest.mark.parametrize(
    "raw, phrases",
    [
        ("Best Laptops 2025 | iPhone Review", ["laptops", "iphone review"]),
        ("The quick brown fox, the lazy dog and the quick brown fox", ["quick brown fox", "lazy dog"]),
        ("food_beverage ok x1y", ["food", "beverage"]),
        ("Économie française — à Paris", ["économie française", "paris"]),
        ("a an it", []),
        (None, []),
    ],
)
def test_keyword_phrases(spark, raw, phrases):
    assert _one(spark, raw, keyword_phrases) == phrases


def test_keywords_cover_whole_text(spark):
    text = " and ".join(f"{a}{b}{c}word" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh")
    assert len(_one(spark, text, keyword_phrases)) == 512


def test_truncate(spark):
    assert _one(spark, "x" * 40, truncate) == "x" * 40
    assert _one(spark, "x" * 41, truncate) == "x" * 40 + "…"


def test_segment_label(spark):
    df = spark.createDataFrame(
        [(["food_beverage", "gaming", "travel"], ["laptop"], 1), (["gaming"], [], 2), ([], ["deal"], 3), (None, None, 4)],
        "c array<string>, k array<string>, i int",
    )
    got = [r[0] for r in df.select(segment_label(F.col("c"), F.col("k"), F.col("i"))).collect()]
    assert got == ["Food Beverage & Gaming & Laptop", "Gaming", "Deal", "Segment 4"]


def test_embeddings_have_unit_length_and_fixed_size(spark):
    df = spark.createDataFrame([(1, "red blue red"), (2, "blue green"), (3, ""), (4, "red blue red")], "i int, t string")
    rows = {r["i"]: np.array(r["embedding"]) for r in embed_texts(df, "t", 32).collect()}
    assert all(len(v) == 32 for v in rows.values())
    assert abs(np.linalg.norm(rows[1]) - 1) < 1e-6 and np.linalg.norm(rows[3]) == 0
    assert (rows[1] == rows[4]).all()


def test_fitted_embedding_is_reusable(spark):
    df = spark.createDataFrame([("red blue",), ("green red",)], "clean_text string")
    model = embedding_pipeline(16).fit(df)
    assert len(embed_texts(df.limit(1), dim=16, model=model).first()["embedding"]) == 16


def test_normalised(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "embedding array<double>")
    assert [r[0] for r in normalised(df).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_text_pass(spark, sessions):
    row = process_sessions_text(sessions, 16).first()
    assert "|" not in row["clean_text"] and row["keywords"] == " ".join(row["keyword_list"])
    assert row["n_keywords"] == len(row["keyword_list"]) and len(row["embedding"]) == 16
