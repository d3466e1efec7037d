"""The jobs as programs, exactly-once writes, bucketed upserts and the catalog."""

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark import tools
from tidemark.operators import bronze, facts
from tidemark.sources import catalog
from tidemark.sources.keyed_table import KeyedTable
from tidemark.specs import DIMENSIONS, FACTS
from tidemark.streaming import apps, jobs


def records(spark, *rows):
    shape = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
    return spark.createDataFrame([(b"k", v.encode() if v else None, "fmcg.public.regions", 1, i, datetime(2026, 1, 2)) for i, v in enumerate(rows)], shape)


def region(i, lsn, name="North", op="c"):
    return json.dumps({"region_id": i, "name": name, "country": "KE", "__op": op, "__source_lsn": lsn, "__source_ts_ms": lsn, "__deleted": "true" if op == "d" else "false"})


def test_a_batch_replayed_on_a_later_date_is_there_once(spark, tmp_path, monkeypatch):
    root, days = f"file://{tmp_path}/log", iter(["2026-11-26", "2026-11-27"])
    parse = bronze.parse_cdc
    monkeypatch.setattr(bronze, "parse_cdc", lambda rows: parse(rows).withColumn("ingest_date", F.lit(next(days)).cast("date")))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for _ in range(2):
            jobs.write_bronze(root)(records(spark, region(1, 10), region(2, 11), None), 4)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    log = jobs.read_bronze(spark, root, "regions")
    assert bronze.duplicate_offsets(log).isEmpty() and {r["ingest_date"] for r in log.collect()} == {date(2026, 11, 27)}
    assert jobs.read_bronze(spark, root, "_quarantine").count() == 1


def test_an_upsert_rewrites_the_buckets_of_its_keys(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", "k INT, v STRING", ("k",), buckets=8)
    newest = lambda now, new: now.join(new, "k", "left_anti").union(new)
    rows = lambda *x: spark.createDataFrame(x, "k int, v string")
    table.write(rows(*[(i, "a") for i in range(100)]), 0, writer="q")
    assert table.upsert(rows((5, "b")), newest, 1, "q") and not table.upsert(rows((6, "c")), newest, 1, "q")
    assert len(list((tmp_path / "t" / "v=0").glob("bucket=*"))) == 8 and len(list((tmp_path / "t" / "v=1").glob("bucket=*"))) == 1
    assert table.read().count() == 100 and [tuple(r) for r in table.read().filter("v = 'b'").collect()] == [(5, "b")]
    assert table.read(0).filter("v = 'b'").isEmpty()
    beside = {r["k"] for r in table.read_buckets_of(rows((5, ""))).collect()}
    assert 5 in beside and len(beside) < 50 and {tuple(r) for r in table.read_buckets_of(rows((5, ""), (6, ""))).collect()} <= {tuple(r) for r in table.read().collect()}
    # A bucket is one file, however many tasks its rows come from.
    many = KeyedTable(spark, f"file://{tmp_path}/m", "k INT, v STRING", ("k",), buckets=3)
    assert many.read_buckets_of(rows((1, ""))).isEmpty()
    many.write(rows(*[(i, "a") for i in range(100)]).repartition(20))
    assert [len(list(b.glob("*.parquet"))) for b in (tmp_path / "m" / "v=0").glob("bucket=*")] == [1, 1, 1]
    # Another query's batches count for themselves; the replay of the first query's still does nothing.
    assert table.upsert(rows((7, "d")), newest, 0, "other") and not table.upsert(rows((8, "e")), newest, 0, "q")
    table.vacuum(1)
    assert table.versions() == [2] and table.read().count() == 100 and table.read().filter("v = 'd'").count() == 1
    gone = lambda now, new: now.join(new, "k", "left_anti")
    assert table.upsert(rows(*[(i, "") for i in range(100)]), gone, 1, "other") and table.read().isEmpty()


def test_the_programs_build_all_tables(spark, tmp_path, capsys):
    folder, root = f"file://{tmp_path}/in", f"file://{tmp_path}/lake"
    s = apps.Settings(root, records=folder, trigger_seconds=None, wait_seconds=0)
    assert apps.run(spark, "upsert_facts", s) == 1  # no log yet
    assert tools.seed(spark, folder) == 0
    records(spark, None).write.mode("append").parquet(folder)
    for name in apps.APPS:
        assert apps.run(spark, name, s) == 0
    regions = FACTS["regions"]
    assert jobs.fact_table(spark, s.tables, regions).read().count() == jobs.read_bronze(spark, s.log, "regions").count() == 5
    for spec in DIMENSIONS.values():
        assert not jobs.dimension_tables(spark, s.tables, spec)[0].read().isEmpty()
    assert tools.bronze_check(spark, s.log) == 0 and "tombstone" in capsys.readouterr().out
    assert tools.scd2_check(spark, s.tables) == 0
    # A new checkpoint begins again at batch 0; its batches are taken and change nothing.
    before = sorted(map(str, jobs.fact_table(spark, s.tables, regions).read().drop("silver_updated_at").collect()))
    tools._delete(spark, jobs.checkpoint_of(s.tables, "regions"))
    table = jobs.fact_table(spark, s.tables, regions)
    n = len(table.versions())
    assert apps.run(spark, "upsert_facts", s) == 0 and len(table.versions()) > n
    assert sorted(map(str, table.read().drop("silver_updated_at").collect())) == before
    copy = f"file://{tmp_path}/copy"
    facts.live(table.read()).write.parquet(copy)
    assert tools.reconcile_table(spark, s.tables, "regions", copy) == 0
    facts.live(table.read()).filter("region_id > 1").withColumn("name", F.lit("x")).write.mode("overwrite").parquet(f"{copy}2")
    assert tools.reconcile_table(spark, s.tables, "regions", f"{copy}2", "0.5") == 1
    assert "1 extra" in (said := capsys.readouterr().out) and "4 differs" in said
    assert apps.main([]) == 2 and tools.spark_sql(spark, "select 1") == 0


def test_catalog(spark):
    name = "lake_test.events"
    catalog.create_database(spark, "lake_test")
    for _ in range(2):
        catalog.create_table(spark, name, "id BIGINT, day DATE", ("day",), {"origin": "log"})
    catalog.append(spark.sql("select date'2026-01-02' day, 7L id"), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(7, date(2026, 1, 2))] and catalog.properties_of(spark, name)["origin"] == "log"
    catalog.overwrite(spark.range(3), "lake_test.numbers")
    assert catalog.tables_of(spark, "lake_test") == ["events", "numbers"] and spark.table("lake_test.numbers").count() == 3
    for t in (name, "lake_test.numbers"):
        catalog.drop_table(spark, t)
    assert catalog.tables_of(spark, "lake_test") == []
