"""Deterministic hash order: the replacement for a driver-side random generator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col

PREFIX_DIGITS = 4


def hash_key(*parts: Column | str | int | float) -> Column:
    """md5 of the parts joined by ``|``; plain strings and numbers are literals, columns are columns."""
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *cols))


def hash_prefix(key: Column | str) -> Column:
    """Leading hex digits: at most 16^4 evenly filled groups."""
    return F.substring(as_col(key), 1, PREFIX_DIGITS)


def hash_number(key: Column | str, digits: int = 8) -> Column:
    """Leading hex digits as a number."""
    return F.conv(F.substring(as_col(key), 1, digits), 16, 10).cast("bigint")
