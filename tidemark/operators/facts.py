"""Current state by key from the change log, ordered by commit LSN, with soft deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import typed
from tidemark.specs import Table

META = ("op", "source_lsn", "source_ts_ms", "is_deleted", "kafka_offset")


def parse(log: DataFrame, spec: Table) -> DataFrame:
    """Declared columns of the payload with their types, and the row's metadata; a payload is parsed once."""
    raw = [f"__{c}" for c in spec.column_names]
    fields = log.select(*META, F.json_tuple("payload", *spec.column_names).alias(*raw))
    return fields.select(*[typed(F.col(f"__{c}"), t).alias(c) for c, t in spec.columns], *META)


def distinct_keys(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return rows.select(*keys).distinct()


def latest_per_key(events: DataFrame, spec: Table) -> DataFrame:
    """One row per key: position and deletion of its newest event, values of its newest live one.

    ``has_values`` is false where only deletes are known; then the newest delete's values stand in.
    ``live_lsn`` is the LSN that the values come from.  Greatest rows are aggregates, so each input task
    sends one row a key however often a key occurs, and ties of position resolve by the values alike in
    every run.
    """
    rest = [c for c in spec.column_names if c not in spec.keys]
    row = F.struct("source_lsn", "kafka_offset", "is_deleted", "source_ts_ms", *rest)
    best = events.groupBy(*spec.keys).agg(F.max(row).alias("_newest"), F.max(F.when(~F.col("is_deleted"), row)).alias("_live"))
    has_values = F.col("_live").isNotNull()
    value = {c: F.when(has_values, F.col(f"_live.{c}")).otherwise(F.col(f"_newest.{c}")).alias(c) for c in rest}
    return best.select(
        *[value.get(c, F.col(c)) for c in spec.column_names],
        *[F.col(f"_newest.{c}").alias(c) for c in ("source_lsn", "source_ts_ms", "is_deleted")],
        has_values.alias("has_values"),
        F.col("_live.source_lsn").alias("live_lsn"),
    )


def apply_latest(target: DataFrame, latest: DataFrame, spec: Table) -> DataFrame:
    """The target after the batch: newer rows win, a delete without values only marks, unseen keys enter.

    A batch row that isn't newer than the stored one changes nothing.  Values older than the stored row
    are not taken either, even if a newer delete comes with them.
    """
    t, s = target.alias("t"), latest.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in spec.keys]
    both = t.join(s, on, "full_outer")
    is_new = F.col("t.source_lsn").isNull()
    newer = F.coalesce(F.col("s.source_lsn") > F.col("t.source_lsn"), F.lit(False))
    revalued = newer & F.coalesce(F.col("s.live_lsn") > F.col("t.source_lsn"), F.lit(False))

    def pick(take: Column, c: str) -> Column:
        return F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    business = [pick(is_new | revalued, c) for c in spec.column_names]
    meta = [pick(is_new | newer, c) for c in ("source_lsn", "source_ts_ms", "is_deleted")]
    stamp = F.when(is_new | newer, F.current_timestamp()).otherwise(F.col("t.silver_updated_at")).alias("silver_updated_at")
    return both.select(*business, *meta, stamp)


def live(rows: DataFrame) -> DataFrame:
    return rows.filter("not is_deleted")
