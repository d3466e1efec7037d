import pytest
from pyspark.sql import functions as F

from tidemark.operators import bronze
from tidemark.sources.live import EVENT_WEIGHTS, Live, draw_events
from tidemark.sources.workload import Workload

NAMES = ("regions", "stores", "products", "sales_reps", "orders", "order_items", "inventory")


@pytest.fixture(scope="module")
def live(spark):
    w = Workload(spark)
    return Live(w, {n: w.table(n).cache() for n in NAMES}, 1)


def rows(changes):
    return {t: (df.collect(), op) for t, df, op in changes}


def test_orders(live):
    made = rows(live.changes("new_order"))
    (order,), items, left = made["orders"][0], made["order_items"][0], made["inventory"][0]
    assert items and len(items) == len(left) and all(i["order_id"] == order["order_id"] and i["quantity"] > 0 for i in items)
    stock = {(r["product_id"], r["warehouse"]): r["qty_on_hand"] for r in live.tables["inventory"].collect()}
    sold = {i["product_id"]: i["quantity"] for i in items}
    assert all(r["qty_on_hand"] == stock[r["product_id"], r["warehouse"]] - sold[r["product_id"]] >= 0 for r in left)
    moved, _ = rows(live.changes("advance_order"))["orders"]
    assert 3 <= len(moved) <= 7 and {r["status"] for r in moved} <= {"confirmed", "shipped", "delivered"}
    gone = rows(live.changes("cancel_order"))
    assert gone["orders"][0][0]["status"] == "cancelled" and all(r["qty_on_hand"] > stock[r["product_id"], r["warehouse"]] for r in gone["inventory"][0])
    dead = rows(live.changes("hard_delete"))
    assert dead["orders"][1] == dead["order_items"][1] == "d" and dead["orders"][0][0]["status"] == "cancelled" and dead["order_items"][0]


def test_master_data(live):
    now = lambda table, key, k: live.tables[table].filter(F.col(key) == k).first()
    (p,) = rows(live.changes("price_change"))["products"][0]
    assert 0.89 < float(p["unit_price"]) / float(now("products", "product_id", p["product_id"])["unit_price"]) < 1.11
    (s,) = rows(live.changes("store_change"))["stores"][0]
    old = now("stores", "store_id", s["store_id"])
    assert (s["tier"] != old["tier"]) != (s["credit_limit"] != old["credit_limit"])
    (n,) = rows(live.changes("new_store"))["stores"][0]
    assert (n["store_id"], n["tier"]) == (51, "bronze")
    (r,) = rows(live.changes("rep_reassigned"))["sales_reps"][0]
    assert r["region_id"] != now("sales_reps", "rep_id", r["rep_id"])["region_id"]
    (d,) = rows(live.changes("product_discontinued"))["products"][0]
    assert not d["is_active"]
    (i,) = rows(live.changes("restock"))["inventory"][0]
    assert i["qty_on_hand"] >= 300
    few = Live(live.workload, live.tables | {"products": live.tables["products"].limit(150)}, 1)
    assert few.changes("product_discontinued")[0][1].isEmpty()


def test_log_and_draws(live):
    log = bronze.parse_cdc(live.log("hard_delete", 500))
    assert log.filter("quarantine_reason is not null or not is_deleted").isEmpty() and log.filter("source_lsn = 501").count() == 1
    drawn = draw_events(42, 2000)
    assert drawn == draw_events(42, 2000) and 900 < drawn.count("new_order") < 1100 and set(drawn) == set(EVENT_WEIGHTS)
    with pytest.raises(ValueError):
        live.changes("other")
