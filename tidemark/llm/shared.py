"""Helpers that several operators use: reading tables, shared storage, cutting lineage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import fresh_path

BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table of a data folder, through Spark's readers only (any store works)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor costs a re-read only."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with batches of about ``BATCH_BYTES`` at most (a single longer row is a batch of its own).

    What a task holds of its rows in the JVM and in Python is then bounded however long the texts are, and
    what its Python worker has freed goes back to the system when the task ends.  Every operator of this
    subpackage maps through here.  Spark has the limit for a session only: it is lowered there, never raised.
    """
    now = df.sparkSession._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= BATCH_BYTES:
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def give_back() -> None:
    """Returns free memory of this Python worker to the system, for what runs beside or after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_or_empty(name: str = "text"):
    """The text column with null taken as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))
