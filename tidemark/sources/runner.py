"""Live events over time: Poisson arrivals, each event one commit of change records.

The folder of records is the only durable truth.  A run begins by rebuilding the source's tables from
it (or by seeding it), so a run that was killed anywhere goes on where its records end.  An event's
records are one file, so it is there as a whole or not at all; what the tables hold afterwards is read
from the same records.  The tables lie in the shared folder for as long as the run lasts.
"""

from __future__ import annotations

import random
import threading
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bronze, facts
from tidemark.session import fresh_path
from tidemark.sources.keyed_table import KeyedTable
from tidemark.sources.live import Live, draw_events
from tidemark.sources.streams import RECORD_SCHEMA
from tidemark.sources.workload import Workload
from tidemark.specs import DIMENSIONS, FACTS

SOURCES = FACTS | DIMENSIONS


@dataclass
class Window:
    """What a stretch of a run did: events by kind, those that found nothing to do, how far the last one was late."""

    applied: Counter = field(default_factory=Counter)
    skipped: Counter = field(default_factory=Counter)
    late: float = 0.0

    def __str__(self) -> str:
        shown = ", ".join(f"{n} {kind}" for kind, n in sorted(self.applied.items())) or "nothing"
        return f"{shown}; {sum(self.skipped.values())} skipped; {self.late:.1f} s late"


def _replaced(now: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows after the newest of each key in ``new`` (latest rows with ``is_deleted``)."""
    kept = now.join(new.select(*keys), list(keys), "left_anti").select(*now.columns)
    return kept.unionByName(facts.live(new).select(*now.columns))


class Runner:
    """Applies events to the source whose records lie in ``folder``; an empty folder is seeded first."""

    def __init__(self, spark: SparkSession, folder: str, workload: Workload) -> None:
        self.spark, self.folder, self.workload = spark, folder, workload
        self.root = fresh_path(spark, "source")
        self.tables = {name: KeyedTable(spark, f"{self.root}/{name}", spec.columns_ddl, spec.keys, 4) for name, spec in SOURCES.items()}
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        there = fs.exists(path)
        # A seed that was cut short left some tables out; those are written now.
        known = {r["table"] for r in self._log().select("table").distinct().collect()} if there else set()
        for name in SOURCES:
            if name not in known:
                workload.snapshot(name).coalesce(1).write.mode("append").parquet(folder)
        log = self._log()
        for name, spec in SOURCES.items():
            latest = facts.latest_per_key(facts.parse(log.filter(F.col("table") == name), spec), spec)
            self.tables[name].write(facts.live(latest))
        self.lsn = log.agg(F.max("source_lsn")).first()[0]

    def _log(self) -> DataFrame:
        return bronze.accepted(bronze.parse_cdc(self.spark.read.schema(RECORD_SCHEMA).parquet(self.folder)))

    def apply(self, event: str, now: str | None = None) -> bool:
        """One event at ``now`` (UTC; default: the workload's): its records, then the tables; False if there is nothing to do."""
        workload = replace(self.workload, now=now) if now else self.workload
        first = self.lsn + 1
        live = Live(workload, {name: t.read() for name, t in self.tables.items()}, first)
        made = live.log(event, first, workload._now()).coalesce(1).persist()
        try:
            if made.isEmpty():
                return False
            made.write.mode("append").parquet(self.folder)
            log = bronze.accepted(bronze.parse_cdc(made)).persist()
            last = {r["table"]: r["lsn"] for r in log.groupBy("table").agg(F.max("source_lsn").alias("lsn")).collect()}
            for name in sorted(last):
                spec = SOURCES[name]
                latest = facts.latest_per_key(facts.parse(log.filter(F.col("table") == name), spec), spec)
                self.tables[name].upsert(latest, lambda now, new, keys=spec.keys: _replaced(now, new, keys))
            log.unpersist()
            # Only now: a lost executor's part of the records is computed again from the versions before.
            for name in last:
                self.tables[name].vacuum(1)
            self.lsn = max(last.values())
            return True
        finally:
            made.unpersist()

    def run(self, rate: float, seconds: float, stop: threading.Event | None = None, window: float = 10, say: Callable[[str], None] = print) -> Window:
        """Events at ``rate`` a second on average until ``seconds`` are over or ``stop`` is set; an event is never cut short.

        Arrivals and kinds are drawn from the workload's seed and the last LSN.  Events that take longer
        than the gap to the next are late, not lost.  Every ``window`` seconds what was done is said;
        the whole run's counts are returned.
        """
        if rate <= 0 or seconds < 0:
            raise ValueError("the rate must be above 0 and seconds not below")
        stop = stop or threading.Event()
        gaps = random.Random(f"{self.workload.seed}:{self.lsn}:gaps")
        kinds = iter(())
        begin = time.monotonic()
        due, told, total, part = gaps.expovariate(rate), window, Window(), Window()
        while due < seconds and not stop.wait(max(0.0, begin + due - time.monotonic())):
            event = next(kinds, None)
            if event is None:
                kinds = iter(draw_events(hash_of(self.workload.seed, self.lsn), 1000))
                event = next(kinds)
            done = self.apply(event, f"{datetime.now(UTC):%Y-%m-%d %H:%M:%S}")
            late = max(0.0, time.monotonic() - begin - due)
            for w in (total, part):
                (w.applied if done else w.skipped)[event] += 1
                w.late = late
            if time.monotonic() - begin >= told:
                say(str(part))
                part, told = Window(), time.monotonic() - begin + window
            due += gaps.expovariate(rate)
        stop.wait(max(0.0, begin + seconds - time.monotonic()))
        say(f"in all: {total}")
        return total

    def close(self) -> None:
        """Deletes the run's tables; the records stay."""
        for t in self.tables.values():
            t.delete()


def hash_of(*parts: int) -> int:
    """A seed from several numbers, the same in every process."""
    return random.Random(":".join(map(str, parts))).getrandbits(32)
