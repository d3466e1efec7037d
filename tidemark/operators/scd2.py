"""Slowly changing dimensions, type 2: versions with exact validity windows.

Two forms with one meaning: ``scd2_history`` over a whole log and ``scd2_apply`` batch by batch.  A
delete closes the version it ends and resets the chain, so the same values opened again after it are a
new version, in one batch or in two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import beginning, forever, row_hash, surrogate_key
from tidemark.specs import Table

#: A batch's keys are broadcast to find their stored versions up to so many; beyond, a shuffled semi join.
BROADCAST_KEYS = 100_000


def _ordered(events: DataFrame, spec: Table) -> DataFrame:
    """Events with their hash, one per (key, LSN): that of the greatest offset.

    Dealt by key alone, which serves this window, the chain's windows and the joins by key after it.
    """
    newest = Window.partitionBy(spec.key, "source_lsn").orderBy(F.desc("kafka_offset"))
    once = events.repartition(spec.key).withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")
    return once.withColumn("row_hash", row_hash(spec.tracked))


def _versions(chain: DataFrame, spec: Table) -> DataFrame:
    """Versions of a chain of events in LSN order.

    ``chain`` also has ``_anchor`` (the stored current version, which opened earlier) and ``_known``
    (the key has stored versions).  Two passes over one partitioning by key.
    """
    order = Window.partitionBy(spec.key).orderBy("source_lsn")
    alive = F.when(~F.col("is_deleted"), F.col("row_hash"))
    stepped = chain.withColumns({"_before": F.lag(alive).over(order), "_first": F.row_number().over(order) == 1, "_gone": F.lag("is_deleted").over(order)})
    opens = ~F.col("is_deleted") & (F.col("_anchor") | F.col("_before").isNull() | (F.col("_before") != F.col("row_hash")))
    closes = F.col("is_deleted") & ~F.coalesce(F.col("_gone"), F.lit(False))
    bounds = stepped.filter(opens | closes | (F.col("is_deleted") & F.col("_first")))
    start = F.when(F.col("_anchor"), F.col("valid_from")).otherwise(F.timestamp_millis("source_ts_ms"))
    bounds = bounds.withColumn("_start", start).withColumns({"_next": F.lead(F.timestamp_millis("source_ts_ms")).over(order), "_next_gone": F.lead("is_deleted").over(order)})
    first_ever = F.col("_first") & ~F.col("_known") & (F.col("op") == "r")
    return bounds.filter(~F.col("is_deleted")).withColumns(
        {
            "valid_from": F.when(~F.col("_anchor") & first_ever, beginning()).otherwise(F.col("_start")),
            "valid_to": F.coalesce("_next", forever()),
            "is_current": F.col("_next").isNull(),
            "is_deleted": F.coalesce("_next_gone", F.lit(False)),
            spec.surrogate: surrogate_key(spec.key),
            "silver_updated_at": F.current_timestamp(),
        }
    )


def output_columns(spec: Table) -> list[str]:
    return [spec.surrogate, *spec.column_names, *[c.split(" ")[0] for c in spec.meta_ddl.split(", ")]]


def scd2_history(events: DataFrame, spec: Table) -> DataFrame:
    """All versions from a complete log."""
    chain = _ordered(events, spec).withColumns({"_anchor": F.lit(False), "_known": F.lit(False), "valid_from": F.lit(None).cast("timestamp")})
    return _versions(chain, spec).select(*output_columns(spec))


def stored_of_batch(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored rows of the batch's keys; the keys are broadcast only if few enough."""
    keys = batch.select(key).distinct()
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return stored.join(F.broadcast(keys) if few else keys, key, "left_semi")


def scd2_changes(events: DataFrame, stored: DataFrame, spec: Table, seen: DataFrame | None = None) -> DataFrame:
    """Rows to merge: the stored current version where it closes, and new versions.

    ``stored``: versions of the batch's keys.  ``seen`` (key, high_lsn): the highest LSN applied to each
    key, which also covers events that left no version; without it, the stored versions' own count.
    """
    high = stored.groupBy(spec.key).agg(F.max("source_lsn").alias("_version_lsn"))
    if seen is not None:
        high = high.join(seen.select(spec.key, F.col("high_lsn").alias("_seen")), spec.key, "full_outer").withColumn("_version_lsn", F.greatest("_version_lsn", "_seen")).drop("_seen")
    fresh = _ordered(events, spec).join(high, spec.key, "left").filter(F.col("_version_lsn").isNull() | (F.col("source_lsn") > F.col("_version_lsn")))
    fresh = fresh.withColumns({"_anchor": F.lit(False), "_known": F.col("_version_lsn").isNotNull(), "valid_from": F.lit(None).cast("timestamp")})
    columns = [*spec.column_names, "op", "source_lsn", "source_ts_ms", "is_deleted", "row_hash", "_anchor", "_known", "valid_from"]
    touched = fresh.select(spec.key).distinct()
    anchors = stored.filter("is_current").join(touched, spec.key, "left_semi").withColumns({"op": F.lit(None).cast("string"), "_anchor": F.lit(True), "_known": F.lit(True)})
    made = _versions(fresh.select(*columns).unionByName(anchors.select(*columns)), spec)
    # An anchor without a boundary after it is as it was.
    return made.filter(~F.col("_anchor") | ~F.col("is_current")).select(*output_columns(spec))


def scd2_merge(stored: DataFrame, changes: DataFrame, spec: Table) -> DataFrame:
    """Stored versions after a batch: closed ones take their end from the batch, new ones are added."""
    moved = ("valid_to", "is_current", "is_deleted", "silver_updated_at")
    t, s = stored.alias("t"), changes.alias("s")
    both = t.join(s, F.col(f"t.{spec.surrogate}") == F.col(f"s.{spec.surrogate}"), "full_outer")
    old, new = F.col(f"t.{spec.surrogate}"), F.col(f"s.{spec.surrogate}")
    pick = lambda c: (F.when(new.isNotNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in moved else F.when(old.isNotNull(), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))).alias(c)
    return both.select(*[pick(c) for c in output_columns(spec)])


def scd2_apply(stored: DataFrame, events: DataFrame, spec: Table, seen: DataFrame | None = None) -> DataFrame:
    """Stored versions after a batch of events."""
    return scd2_merge(stored, scd2_changes(events, stored_of_batch(stored, events, spec.key), spec, seen), spec)


def high_water(seen: DataFrame, events: DataFrame, spec: Table) -> DataFrame:
    """(key, high_lsn) after a batch."""
    both = seen.unionByName(events.select(spec.key, F.col("source_lsn").alias("high_lsn")))
    return both.groupBy(spec.key).agg(F.max("high_lsn").alias("high_lsn"))


def violations(versions: DataFrame, key: str) -> DataFrame:
    """Versions that break an invariant, with the reason."""
    by_key = Window.partitionBy(key)
    order = by_key.orderBy("valid_from", "source_lsn")
    seen = versions.withColumns({"_next": F.lead("valid_from").over(order), "_current": F.sum(F.col("is_current").cast("int")).over(by_key)})
    last = F.col("_next").isNull()
    reason = (
        F.when(F.col("_current") > 1, "several current versions")
        .when(F.col("valid_from") > F.col("valid_to"), "ends before it begins")
        .when(~last & ~F.col("is_deleted") & (F.col("valid_to") != F.col("_next")), "gap or overlap")
        .when(~last & F.col("is_deleted") & (F.col("valid_to") > F.col("_next")), "gap or overlap")
        .when(~last & F.col("is_current"), "current with a successor")
        .when(last & ~((F.col("is_current") & (F.col("valid_to") == forever())) | (~F.col("is_current") & F.col("is_deleted"))), "last neither open nor deleted")
    )
    return seen.withColumn("violation", reason).filter("violation is not null").drop("_next", "_current")


def summary(versions: DataFrame, key: str) -> DataFrame:
    """One row: keys, versions, current, deleted, and the most versions of a key."""
    each = versions.groupBy(key).agg(F.count("*").alias("n"), F.count_if("is_current").alias("current"), F.count_if("is_deleted").alias("deleted"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return each.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("versions"), total("current"), total("deleted"), F.coalesce(F.max("n"), F.lit(0)).alias("most_versions"))
