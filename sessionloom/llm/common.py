"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

# A word is a run of anything but the six ASCII white-space characters (fixed value).
WORD = r"[^\x20\x09-\x0D]+"

# Rows per Arrow batch: texts can be long, so batches stay small.
ARROW_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of the library, with Arrow batches sized for whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_words(text: Column | str) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hex_fraction(digest: Column, digits: int = 13) -> Column:
    """Leading hex digits of a digest as a number in (0, 1): exact in double precision."""
    value = F.conv(F.substring(digest, 1, digits), 16, 10).cast("double")
    return (value + F.lit(0.5)) / F.lit(float(16**digits))
