"""Scalar expressions shared by the operators: tolerant casts, hashes, sentinels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Open ends of validity windows.
BEGINNING, FOREVER = datetime(1900, 1, 1), datetime(9999, 12, 31)
#: Stands for NULL among hashed values, and parts them.
NULL_MARK, SEPARATOR = "␀", "\u0001"


def typed(raw: Column, sql_type: str) -> Column:
    """Text to a declared type; what doesn't parse is NULL, never an error.  Booleans: only 'true' is true."""
    if sql_type == "BOOLEAN":
        return raw == "true"
    return raw if sql_type == "STRING" else raw.try_cast(sql_type)


def row_hash(columns: tuple[str, ...]) -> Column:
    """SHA-256 over the columns' text; a NULL differs from an empty text."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]), 256)


def surrogate_key(key: str, lsn: str = "source_lsn") -> Column:
    """A version's key, the same in every replay."""
    return F.xxhash64(F.col(key), F.col(lsn))


def beginning() -> Column:
    return F.lit("1900-01-01 00:00:00").cast("timestamp")


def forever() -> Column:
    return F.lit("9999-12-31 00:00:00").cast("timestamp")
