"""Text signals per session: clean text, keyword phrases, dense vectors."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, keyword_phrases


def text_columns(df: DataFrame, text_col: str = "interaction_text") -> DataFrame:
    """Add clean_text, keyword_list, keywords and n_keywords in one narrow projection."""
    return (
        df.withColumn("clean_text", clean_text(text_col))
        .withColumn("keyword_list", keyword_phrases(text_col))
        .withColumns({"keywords": F.array_join("keyword_list", " "), "n_keywords": F.size("keyword_list")})
    )


def embedding_pipeline(dim: int = 384, text_col: str = "clean_text") -> Pipeline:
    """Hashed TF-IDF to a fixed dimension with unit length: one counting pass to fit, none to apply."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=dim),
            IDF(inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol="_unit", p=2.0),
        ]
    )


def embed_texts(
    df: DataFrame, text_col: str = "clean_text", dim: int = 384, model: PipelineModel | None = None
) -> DataFrame:
    """Add ``embedding``: array<float> of ``dim`` values with unit length (all zero for empty text)."""
    fitted = model or embedding_pipeline(dim, text_col).fit(df)
    embedded = fitted.transform(df).withColumn("embedding", vector_to_array("_unit", dtype="float32"))
    return embedded.drop("_tokens", "_counts", "_weighted", "_unit")


def unit_features(df: DataFrame, col: str = "embedding", out: str = "features") -> DataFrame:
    """Add the unit-length ML vector of an array column; a zero vector stays zero."""
    raw = df.withColumn("_raw", array_to_vector(F.col(col).cast("array<double>")))
    return Normalizer(inputCol="_raw", outputCol=out, p=2.0).transform(raw).drop("_raw")


def normalised(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Unit-length copy of an array column; zero vectors stay zero."""
    return unit_features(df, col, "_unit").withColumn(col, vector_to_array("_unit")).drop("_unit")


def process_sessions_text(sessions: DataFrame, dim: int = 384, model: PipelineModel | None = None) -> DataFrame:
    """The full text pass: cleaned text, keywords and embedding on one DataFrame."""
    return embed_texts(text_columns(sessions), "clean_text", dim, model)
