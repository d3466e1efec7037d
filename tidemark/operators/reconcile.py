"""Comparison of two keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare(source: DataFrame, target: DataFrame, keys: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """Keys with ``status``: missing (only in source), extra (only in target) or differs; equal rows are left out."""
    a = source.select(*keys, F.struct(*columns).alias("_a"))
    b = target.select(*keys, F.struct(*columns).alias("_b"))
    both = a.join(b, list(keys), "full_outer")
    status = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(~F.col("_a").eqNullSafe(F.col("_b")), "differs")
    return both.select(*keys, status.alias("status")).filter("status is not null")


def keys_only_in(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return a.select(*keys).join(b.select(*keys), list(keys), "left_anti")
