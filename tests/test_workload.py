import random

import pytest
from pyspark.sql import functions as F

from tests.test_engine import LOG, STORES, fold_versions, tier
from tidemark.operators import bronze, facts, scd2
from tidemark.sources.workload import Workload
from tidemark.specs import DIMENSIONS, FACTS


@pytest.fixture(scope="module")
def seed(spark):
    w = Workload(spark)
    return {n: w.table(n).cache() for n in ("regions", "stores", "products", "sales_reps", "orders", "order_items", "inventory")}


def test_seed_sizes_and_rules(spark, seed):
    assert [seed[n].count() for n in ("regions", "stores", "products", "sales_reps", "inventory")] == [5, 50, 200, 10, 600]
    o, i, p = seed["orders"], seed["order_items"], seed["products"]
    assert 1800 < o.count() < 3000 and o.select("order_id").distinct().count() == o.count()
    assert i.select("order_id", "product_id").distinct().count() == i.count() == i.select("order_item_id").distinct().count()
    assert i.join(p, "product_id").filter(i.unit_price != p.unit_price).isEmpty()
    assert p.select("sku").distinct().count() == 200 and p.filter("unit_price <= 0").isEmpty()
    assert i.filter("quantity < 1 or discount_pct not in (0, 2.5, 5)").isEmpty()
    assert seed["inventory"].filter("qty_on_hand < 0 or qty_on_hand > 1500").isEmpty()
    both = o.join(seed["stores"].select("store_id", F.col("region_id").alias("a")), "store_id").join(seed["sales_reps"].select("rep_id", F.col("region_id").alias("b")), "rep_id")
    assert both.count() == o.count() and both.filter("a <> b").isEmpty()
    old = "order_ts < timestamp'2026-09-30 11:00:00'"
    assert o.filter(f"{old} and status not in ('delivered', 'cancelled')").isEmpty() and not o.filter("status in ('placed', 'confirmed')").isEmpty()
    top = i.groupBy("product_id").count().orderBy(F.desc("count")).limit(40).agg(F.sum("count")).first()[0]
    assert top / i.count() > 0.4


def test_seed_is_the_same_under_any_partitioning(spark, seed):
    again = Workload(spark).orders().repartition(7)
    assert again.exceptAll(seed["orders"]).isEmpty() and not Workload(spark, seed=43).orders().exceptAll(seed["orders"]).isEmpty()


@pytest.mark.parametrize(("name", "table", "versions"), [("price", "products", 4), ("burst", "stores", 4)])
def test_dimension_scenarios(spark, name, table, versions):
    w, spec = Workload(spark), DIMENSIONS[table]
    log = bronze.accepted(bronze.parse_cdc(w.snapshot(table).unionByName(w.scenario(name))), table)
    rows = scd2.scd2_history(facts.parse(log, spec), spec).cache()
    assert rows.filter(F.col(spec.key) == 1).count() == versions and scd2.violations(rows, spec.key).isEmpty()
    assert rows.filter("is_current").count() == w.table(table).count()


def test_order_scenarios(spark):
    w, spec = Workload(spark), FACTS["orders"]
    log = bronze.accepted(bronze.parse_cdc(w.scenario("lifecycle").unionByName(w.scenario("delete"))), "orders")
    got = {r["order_id"]: (r["status"], r["is_deleted"]) for r in facts.latest_per_key(facts.parse(log, spec), spec).collect()}
    assert got == {-1: ("delivered", False), -2: ("cancelled", True)}
    with pytest.raises(ValueError):
        w.scenario("other")


def test_random_splits_fold_to_the_whole_log(spark):
    rng = random.Random(5)
    events = [tier(100 + 10 * i, rng.choice(["bronze", "silver", "gold"]), op="r" if i == 0 else "d" if rng.random() < 0.25 else "u") for i in range(8)]
    whole = scd2.scd2_history(facts.parse(spark.createDataFrame(events, LOG), STORES), STORES)
    whole = sorted(map(tuple, whole.select("source_lsn", "tier", F.unix_millis("valid_from"), F.unix_millis("valid_to"), "is_current", "is_deleted").collect()))
    cuts = sorted(rng.sample(range(1, 8), 2))
    assert fold_versions(spark, events[: cuts[0]], events[cuts[0] : cuts[1]], events[cuts[1] :]) == whole
