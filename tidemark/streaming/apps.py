"""The jobs as programs: python -m tidemark.streaming.apps ingest_cdc|upsert_facts|scd2_dimensions [--once]

Settings come from the environment: TIDEMARK_ROOT (folder of all tables), TIDEMARK_BROKERS (broker
addresses) or TIDEMARK_RECORDS (folder of record files), TIDEMARK_TRIGGER_SECONDS, TIDEMARK_WAIT_SECONDS
(how long a job waits for the log of its tables), TIDEMARK_BUCKETS (of a keyed table, when it is first
written: about a bucket for each gigabyte it will hold, as a batch rewrites whole buckets).  ``--once`` takes what is there now and ends.
"""

from __future__ import annotations

import os
import sys
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidemark.session import build_session
from tidemark.sources import streams
from tidemark.specs import DIMENSIONS, FACTS
from tidemark.streaming import jobs


@dataclass(frozen=True)
class Settings:
    root: str
    brokers: str = ""
    records: str = ""
    trigger_seconds: int | None = 30
    wait_seconds: float = 3600
    buckets: int = jobs.BUCKETS

    @classmethod
    def from_environment(cls, once: bool = False) -> Settings:
        get = os.environ.get
        return cls(get("TIDEMARK_ROOT", ""), get("TIDEMARK_BROKERS", ""), get("TIDEMARK_RECORDS", ""), None if once else int(get("TIDEMARK_TRIGGER_SECONDS", "30")), float(get("TIDEMARK_WAIT_SECONDS", "3600")), int(get("TIDEMARK_BUCKETS", str(jobs.BUCKETS))))

    @property
    def log(self) -> str:
        return f"{self.root}/bronze"

    @property
    def tables(self) -> str:
        return f"{self.root}/silver"


def ingest_cdc(spark: SparkSession, s: Settings) -> list:
    """One query: records of all topics to the change-log tables and the quarantine."""
    stream = streams.kafka_stream(spark, s.brokers) if s.brokers else streams.record_stream(spark, s.records)
    return [jobs.start(stream, jobs.write_bronze(s.log), jobs.checkpoint_of(s.log, "ingest_cdc"), "ingest_cdc", s.trigger_seconds)]


def _logged(spark: SparkSession, s: Settings, table: str) -> bool:
    return jobs.wait_for(spark, f"{s.log}/{table}", 1, s.wait_seconds)


def upsert_facts(spark: SparkSession, s: Settings) -> list:
    """A query for each current-state table whose log there is."""
    found = [spec for spec in FACTS.values() if _logged(spark, s, spec.name)]
    return [jobs.start(streams.bronze_stream(spark, f"{s.log}/{spec.name}"), jobs.upsert_facts(spec, jobs.fact_table(spark, s.tables, spec, s.buckets)), jobs.checkpoint_of(s.tables, spec.name), spec.name, s.trigger_seconds) for spec in found]


def scd2_dimensions(spark: SparkSession, s: Settings) -> list:
    """A query for each versioned table whose log there is."""
    found = [spec for spec in DIMENSIONS.values() if _logged(spark, s, spec.source)]
    return [jobs.start(streams.bronze_stream(spark, f"{s.log}/{spec.source}"), jobs.version_dimension(spec, *jobs.dimension_tables(spark, s.tables, spec, s.buckets)), jobs.checkpoint_of(s.tables, spec.name), spec.name, s.trigger_seconds) for spec in found]


APPS = {"ingest_cdc": ingest_cdc, "upsert_facts": upsert_facts, "scd2_dimensions": scd2_dimensions}


def run(spark: SparkSession, name: str, settings: Settings) -> int:
    """Starts a job's queries and waits: for all of them to end (once), or for any to stop or fail."""
    queries = APPS[name](spark, settings)
    if not queries:
        print(f"{name}: no log to read")
        return 1
    if settings.trigger_seconds is None:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    failed = [q.name for q in queries if q.exception() is not None]
    print(f"{name}: ended" + (f"; failed: {', '.join(failed)}" if failed else ""))
    return int(bool(failed))


def main(args: list[str]) -> int:
    names = [a for a in args if a != "--once"]
    settings = Settings.from_environment("--once" in args)
    if len(names) != 1 or names[0] not in APPS or not settings.root:
        print(__doc__)
        return 2
    return run(build_session(names[0]), names[0], settings)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
