"""Command line: python -m tidemark.tools bronze_check|scd2_check|reconcile|reset_tables|spark_sql|smoke_test|seed|scenario|run ...

Exit 0 when a check passes, 1 when it fails, 2 for wrong usage.
"""

from __future__ import annotations

import signal
import sys
import threading
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bronze, facts, reconcile, scd2
from tidemark.session import build_session, fresh_path
from tidemark.sources.keyed_table import KeyedTable
from tidemark.sources.runner import Runner
from tidemark.sources.streams import jdbc_table
from tidemark.sources.workload import Workload
from tidemark.specs import DIMENSIONS, FACTS
from tidemark.streaming.jobs import checkpoint_of, dimension_tables, fact_table, read_bronze, wait_for


def list_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables under a folder, in order; quarantine and hidden folders are none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(where) if fs.exists(where) else []
    return sorted(f.getPath().getName() for f in found if f.isDirectory() and f.getPath().getName()[0] not in "_.")


def bronze_check(spark: SparkSession, root: str, *tables: str) -> int:
    """Rows per op and repeated offsets of the named tables, by default of all under ``root``."""
    tables = tables or tuple(list_tables(spark, root))
    if not tables:
        print("no tables")
        return 1
    bad = 0
    for t in tables:
        log = read_bronze(spark, root, t)
        bronze.counts_by_op(log).show()
        bad += bronze.duplicate_offsets(log).count()
    if wait_for(spark, f"{root}/_quarantine", 0, 0):
        bronze.quarantine_reasons(read_bronze(spark, root, "_quarantine")).show(truncate=False)
    return int(bad > 0)


def scd2_check(spark: SparkSession, root: str) -> int:
    bad = 0
    for spec in DIMENSIONS.values():
        rows = dimension_tables(spark, root, spec)[0].read()
        scd2.summary(rows, spec.key).show()
        found = scd2.violations(rows, spec.key)
        found.orderBy(spec.key, "valid_from").show(10)
        bad += found.count()
    return int(bad > 0)


def reconcile_table(spark: SparkSession, root: str, name: str, source: str, seconds: str = "0") -> int:
    """Compares a current-state table with its source: a Parquet copy, or a live table by a jdbc: url.

    A live pipeline lags behind its source, so the comparison is repeated until nothing differs or
    ``seconds`` have passed; then counts and five samples of each kind of difference are printed.
    """
    spec = FACTS[name]
    rest = tuple(c for c in spec.column_names if c not in spec.keys)
    end = time.time() + float(seconds)
    while True:
        rows = jdbc_table(spark, source, name) if source.startswith("jdbc:") else spark.read.parquet(source)
        out = reconcile.compare(rows, facts.live(fact_table(spark, root, spec).read()), spec.keys, rest)
        counts = {r["status"]: r["n"] for r in out.groupBy("status").agg(F.count("*").alias("n")).collect()}
        if not counts or time.time() >= end:
            break
        time.sleep(min(5, max(0.0, end - time.time())))
    print(f"{name}: " + (", ".join(f"{n} {status}" for status, n in sorted(counts.items())) or "equal"))
    for status in sorted(counts):
        out.filter(F.col("status") == status).orderBy(*spec.keys).show(5)
    return int(bool(counts))


def _delete(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def reset_tables(spark: SparkSession, root: str, *names: str) -> int:
    """Deletes tables so that their stopped jobs rebuild them: data, a dimension's high-water marks, checkpoint.

    Checkpoints are those of ``jobs.checkpoint_of``; ``--checkpoints=<folder>``: ``<folder>/<table>``.
    """
    folders = [n.split("=", 1)[1] for n in names if n.startswith("--checkpoints=")]
    names = tuple(n for n in names if not n.startswith("--checkpoints="))
    if not names:
        print("usage: reset_tables <root> [--checkpoints=<folder>] <table>...")
        return 2
    dimensions = {spec.name: spec for spec in DIMENSIONS.values()}
    for n in names:
        # Marks first: without the table they would filter out what is replayed.
        marks = n in dimensions and _delete(spark, dimension_tables(spark, root, dimensions[n])[1].path)
        data = _delete(spark, f"{root}/{n}")
        checkpoint = _delete(spark, f"{folders[-1]}/{n}" if folders else checkpoint_of(root, n))
        print(f"{n}: data deleted={data}; marks deleted={marks}; checkpoint deleted={checkpoint}")
    return 0


def spark_sql(spark: SparkSession, text: str) -> int:
    spark.sql(text).show(100, truncate=False)
    return 0


def smoke_test(spark: SparkSession, root: str | None = None) -> int:
    """Writes a keyed table twice under ``root`` (default: the shared folder), reads it back and checks its detail and history."""
    path = f"{root}/_smoke-{uuid.uuid4().hex}" if root else fresh_path(spark, "smoke")
    table = KeyedTable(spark, path, "id BIGINT, square BIGINT", ("id",))
    rows = spark.range(1, 11).select("id", (F.col("id") * F.col("id")).alias("square"))
    try:
        table.write(rows.filter("id <= 5"), 0)
        table.upsert(rows.filter("id > 5"), lambda now, new: now.unionByName(new), 1)
        again = KeyedTable(spark, path, table.schema, table.keys)
        sums = [tuple(again.read(v).agg(F.count("*"), F.sum("square")).first()) for v in (None, 0)]
        detail, history = again.detail(), again.history()
    finally:
        table.delete()
    print(f"rows and sums={sums}; detail={detail}; history={history}")
    first, last = {"version": 0, "batch_id": 0, "operation": "write"}, {"version": 1, "batch_id": 1, "operation": "merge"}
    return int((sums, detail, history) != ([(10, 385), (5, 55)], last, [first, last]))


def seed(spark: SparkSession, out: str) -> int:
    """Snapshot records of every source table, appended to a folder that the record stream reads."""
    w = Workload(spark)
    for name in (*FACTS, *DIMENSIONS):
        w.snapshot(name).write.mode("append").parquet(out)
    return 0


def scenario(spark: SparkSession, out: str, name: str) -> int:
    Workload(spark).scenario(name).write.mode("append").parquet(out)
    return 0


def run(spark: SparkSession, out: str, *options: str) -> int:
    """Live events appended to a folder of records: ``--rate`` a second, for ``--duration`` seconds, drawn from ``--seed``.

    An interrupt or a termination ends the run after the event at hand.
    """
    given = {"rate": 0.5, "duration": 60.0, "seed": 42.0}
    for o in options:
        name, _, value = o.removeprefix("--").partition("=")
        if not o.startswith("--") or name not in given or not value:
            print("usage: run <records> [--rate=0.5] [--duration=60] [--seed=42]")
            return 2
        given[name] = float(value)
    stop = threading.Event()
    if threading.current_thread() is threading.main_thread():
        for s in (signal.SIGINT, signal.SIGTERM):
            signal.signal(s, lambda *_: stop.set())
    runner = Runner(spark, out, Workload(spark, seed=int(given["seed"])))
    try:
        runner.run(given["rate"], given["duration"], stop)
    finally:
        runner.close()
    return 0


COMMANDS = {"seed": seed, "scenario": scenario, "run": run, "bronze_check": bronze_check, "scd2_check": scd2_check, "reconcile": reconcile_table, "reset_tables": reset_tables, "spark_sql": spark_sql, "smoke_test": smoke_test}


def main(args: list[str]) -> int:
    if not args or args[0] not in COMMANDS:
        print(__doc__)
        return 2
    return COMMANDS[args[0]](build_session(args[0]), *args[1:])


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
