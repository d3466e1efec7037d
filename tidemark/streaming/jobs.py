"""Streaming jobs: records to change-log tables, change log to current state and to versions.

Each job is a ``foreachBatch`` query.  Change-log tables are Parquet under ``<root>/<table>`` in
``batch_id=N/ingest_date=D`` partitions; a replayed batch overwrites all that its id wrote, also on a
later date, so it is written once.  Keyed tables take a batch of a query once by its recorded id.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bronze, facts, scd2
from tidemark.sources.keyed_table import KeyedTable
from tidemark.specs import Table, ddl

#: Buckets of a new keyed table unless told otherwise: for tables of some gigabytes.
BUCKETS = 16


def write_bronze(root: str):
    """A batch handler that writes each table's rows and the quarantine beside each other."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = bronze.parse_cdc(batch).persist()
        try:
            counts = bronze.batch_counts(parsed).collect()
            writes = [(f"{root}/{t}", bronze.accepted(parsed, t)) for t in sorted({r["table"] for r in counts if not r["is_bad"]})]
            if any(r["is_bad"] for r in counts):
                writes.append((f"{root}/_quarantine", bronze.quarantined(parsed)))

            def write(job: tuple[str, DataFrame]) -> None:
                path, rows = job
                # Static: what an earlier run of this batch wrote on another date goes too.
                rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("ingest_date").parquet(f"{path}/batch_id={batch_id}")

            if writes:
                with ThreadPoolExecutor(len(writes)) as pool:
                    list(pool.map(write, writes))
        finally:
            parsed.unpersist()

    return handle


def writer_of(batch: DataFrame) -> str:
    """The id of the streaming query that a batch comes from, which its checkpoint keeps; empty outside of one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}")


def upsert_facts(spec: Table, table: KeyedTable):
    """A batch handler that brings a current-state table up to date."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        latest = facts.latest_per_key(facts.parse(batch, spec), spec).persist()
        try:
            if not latest.isEmpty():
                table.upsert(latest, lambda now, new: facts.apply_latest(now, new, spec), batch_id, writer_of(batch))
        finally:
            latest.unpersist()

    return handle


def version_dimension(spec: Table, table: KeyedTable, seen: KeyedTable):
    """A batch handler that brings a versioned table and its per-key high-water LSNs up to date."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        events = facts.parse(batch, spec).persist()
        try:
            if not events.isEmpty():
                marks = seen.read_buckets_of(events)
                table.upsert(events, lambda now, new: scd2.scd2_apply(now, new, spec, marks.join(new.select(spec.key).distinct(), spec.key, "left_semi")), batch_id, writer_of(batch))
                seen.upsert(events, lambda now, new: scd2.high_water(now, new, spec), batch_id, writer_of(batch))
        finally:
            events.unpersist()

    return handle


def fact_table(spark: SparkSession, root: str, spec: Table, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, f"{root}/{spec.name}", ddl(spec), spec.keys, buckets)


def dimension_tables(spark: SparkSession, root: str, spec: Table, buckets: int = BUCKETS) -> tuple[KeyedTable, KeyedTable]:
    kind = dict(spec.columns)[spec.key]
    marks = f"{spec.key} {kind}, high_lsn BIGINT"
    return KeyedTable(spark, f"{root}/{spec.name}", ddl(spec), spec.keys, buckets), KeyedTable(spark, f"{root}/{spec.name}_seen", marks, (spec.key,), buckets)


def checkpoint_of(root: str, table: str) -> str:
    """Where a table's job keeps its checkpoint unless told otherwise; ``reset_tables`` deletes it with the table."""
    return f"{root}/_checkpoints/{table}"


def start(stream: DataFrame, handler, checkpoint: str, name: str, seconds: int | None = 30):
    """Starts a query; ``seconds`` None: all that is there now, then stop."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint).queryName(name)
    return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()


def wait_for(spark: SparkSession, path: str, seconds: float = 10, most: float = 3600) -> bool:
    """Waits until ``path`` exists."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    end = time.time() + most
    while not fs.exists(where):
        if time.time() >= end:
            return False
        time.sleep(seconds)
    return True
