"""Catalog tables, parquet and CSV: read, write, test, sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import array_to_json, doubles_from_json, strings_from_json
from ..operators.ranking import sample_rows
from ..schemas import RAW_SESSIONS_SCHEMA, SEGMENTS_SCHEMA, SESSIONS_SCHEMA

_WRITE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def read_table(spark: SparkSession, table: str, query: str | None = None) -> DataFrame:
    """A catalog table, or the result of ``query`` when one is given."""
    return spark.sql(query) if query else spark.table(table)


def write_table(
    df: DataFrame,
    table: str,
    if_exists: str = "replace",
    path: str | None = None,
    bucket_by: str | None = None,
    buckets: int | None = None,
) -> None:
    """Write a catalog table from the executors.

    ``bucket_by`` with ``buckets`` stores the table hash-clustered and sorted on a key, so
    later joins on it need no shuffle of this side; rows are sent to their bucket first, which
    gives one file per bucket. ``path`` makes it an external table.
    """
    if if_exists not in _WRITE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(_WRITE_MODES)}, not {if_exists!r}")
    bucketed = bool(bucket_by and buckets)
    placed = df.repartition(buckets, bucket_by) if bucketed else df
    writer = placed.write.mode(_WRITE_MODES[if_exists]).format("parquet")
    if path:
        writer = writer.option("path", path)
    if bucketed:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _to_csv_columns(df: DataFrame) -> DataFrame:
    """Arrays and maps as JSON text, timestamps as ISO text: CSV has no nested types."""
    edges = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            edges[field.name] = array_to_json(field.name)
        elif isinstance(field.dataType, T.TimestampType):
            edges[field.name] = F.date_format(field.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.withColumns(edges) if edges else df


# Line breaks in text, and the mark itself, become two characters: files stay one row a line and splittable.
_BREAKS = {"\\": "\\e", "\n": "\\n", "\r": "\\r"}


def escape_breaks(text: Column) -> Column:
    for plain, coded in _BREAKS.items():
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape_breaks(text: Column) -> Column:
    for plain, coded in reversed(_BREAKS.items()):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; line breaks in text are escaped (``escape_breaks``)."""
    texts = {f.name: escape_breaks(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    _to_csv_columns(df.withColumns(texts) if texts else df).write.mode("overwrite").csv(path, header=True, escape='"', nullValue="")


def read_sessions_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = False,
    escaped: bool = True,
) -> DataFrame:
    """Sessions from CSV with header: columns are matched by name and cast to the contract.

    Array columns arrive as JSON text; a value that does not parse becomes null. Files of ``write_csv``
    have their line breaks escaped; for files of others set ``escaped=False``, and ``multi_line`` where
    they hold line breaks inside quotes (such files cannot be split).
    """
    wanted = schema or SESSIONS_SCHEMA
    raw = spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=multi_line)
    columns = []
    for field in wanted.fields:
        if field.name not in raw.columns:
            continue
        col = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            text = isinstance(field.dataType.elementType, T.StringType)
            col = strings_from_json(col) if text else doubles_from_json(col)
        elif isinstance(field.dataType, T.TimestampType):
            col = F.try_to_timestamp(col)
        elif not isinstance(field.dataType, T.StringType):
            col = col.try_cast(field.dataType)
        elif escaped:
            col = unescape_breaks(col)
        columns.append(col.alias(field.name))
    return raw.select(*columns)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Any CSV with header; types are inferred only when no schema is given."""
    reader = spark.read.option("header", True).option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def session_sample(sessions: DataFrame, n: int = 5000, seed: int = 42) -> DataFrame:
    """min(n, N) seeded random sessions."""
    return sample_rows(sessions, n, "session_id", seed, tag="sample")


def save_sample(sessions: DataFrame, path: str, n: int = 5000, seed: int = 42) -> None:
    write_csv(session_sample(sessions, n, seed), path)


def bounded_scan(table: DataFrame, n: int = 20_000, id_col: str = "session_id") -> DataFrame:
    """At most n rows of a table; always the same ones."""
    return sample_rows(table, n, id_col, seed=0, tag="scan")


def load_report_tables(
    spark: SparkSession,
    sessions_table: str = "sessions",
    segments_table: str = "audience_segments",
    sample_csv: str | None = None,
    limit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Sessions (all, or a bounded scan with ``limit``) and segments for reports.

    Falls back to the CSV sample, if one is named, when the sessions table is missing; a named sample
    that cannot be read raises. Segments are optional and empty when missing, or when the sample is used.
    """
    no_segments = spark.createDataFrame([], SEGMENTS_SCHEMA)
    if table_exists(spark, sessions_table):
        sessions = spark.table(sessions_table)
        sessions = sessions if limit is None else bounded_scan(sessions, limit)
        segments = spark.table(segments_table) if table_exists(spark, segments_table) else no_segments
        return sessions, segments
    if sample_csv is not None:
        return read_sessions_csv(spark, sample_csv), no_segments
    return spark.createDataFrame([], RAW_SESSIONS_SCHEMA), no_segments


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames under table names for ad-hoc SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[n for n in names if n in df.columns])
