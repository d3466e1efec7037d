import threading

import pytest
from pyspark.sql import functions as F

from tidemark import tools
from tidemark.sources.runner import Runner
from tidemark.sources.workload import Workload

NOW = "2026-10-03 13:00:00"


def state(runner):
    return {n: sorted(map(str, t.read().select(*sorted(c for c in t.read().columns if c != "updated_at")).collect())) for n, t in runner.tables.items()}


@pytest.fixture
def runner(spark, tmp_path):
    r = Runner(spark, f"file://{tmp_path}/in", Workload(spark, stores_n=12, days=3, orders_per_day=5))
    yield r
    r.close()


def test_tables_follow_the_records_and_a_new_run_goes_on(spark, tmp_path, runner):
    before = state(runner)
    assert len(before["products"]) == 200 and runner.lsn == 1
    assert runner.apply("new_order", NOW) and runner.apply("price_change", NOW) and runner.apply("new_store", NOW)
    assert runner.apply("cancel_order", NOW) in (True, False)
    deleted = runner.apply("hard_delete", "2026-10-20 00:00:00")
    after = state(runner)
    assert len(after["stores"]) == len(before["stores"]) + 1 and after["products"] != before["products"]
    assert len(after["orders"]) == len(before["orders"]) + 1 - deleted
    # The tables rebuilt from the records alone are the same, and the numbers go on.
    again = Runner(spark, runner.folder, runner.workload)
    assert state(again) == after and again.lsn == runner.lsn > 4
    assert again.apply("new_store", NOW) and len(state(again)["stores"]) == len(after["stores"]) + 1
    log = again._log().filter("source_lsn > 1")
    assert log.groupBy("source_lsn", "table").agg(F.countDistinct("op").alias("n")).filter("n > 1").isEmpty()
    again.close()
    assert again.tables["stores"].versions() == []


def test_a_half_written_seed_is_completed(spark, tmp_path):
    w = Workload(spark, stores_n=3, days=1, orders_per_day=2)
    folder = f"file://{tmp_path}/in"
    w.snapshot("stores").write.parquet(folder)
    r = Runner(spark, folder, w)
    assert [r.tables[n].read().count() for n in ("stores", "products", "regions")] == [3, 200, 5]
    r.close()


def test_nothing_to_do_writes_nothing(runner):
    lsn, n = runner.lsn, runner._log().count()
    for t in ("orders", "order_items"):
        runner.tables[t].write(runner.tables[t].read().limit(0))
    assert not runner.apply("advance_order", NOW) and (runner.lsn, runner._log().count()) == (lsn, n)


def test_timed_run_and_stop(runner):
    said, drawn = [], []
    runner.apply = lambda event, now: drawn.append(event) or event != "restock"
    total = runner.run(200, 0.5, window=0.1, say=said.append)
    assert 50 < len(drawn) < 170 and sum(total.applied.values()) + sum(total.skipped.values()) == len(drawn)
    assert total.skipped.keys() <= {"restock"} and len(said) >= 3 and said[-1].startswith("in all: ")
    stop = threading.Event()
    runner.apply = lambda event, now: stop.set() or True
    assert sum(runner.run(200, 30, stop, say=said.append).applied.values()) == 1
    with pytest.raises(ValueError):
        runner.run(0, 1)


def test_command(spark, tmp_path):
    assert tools.run(spark, f"file://{tmp_path}/in", "--speed=1") == 2
    assert tools.run(spark, f"file://{tmp_path}/in", "--rate=1", "--duration=0.1", "--seed=7") == 0
    assert tools.list_tables(spark, f"file://{tmp_path}") == ["in"]
