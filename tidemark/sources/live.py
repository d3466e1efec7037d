"""Live changes of the source system: ten kinds of events on its current tables, as change records.

Each event reads the tables as they are and names the rows it changes; picks are hashes of (seed, batch,
row), so a batch repeats exactly.  An event that finds nothing to do changes nothing.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.sources.workload import CHANNELS, REGIONS, TIER_DISCOUNTS, TIER_SHARES, Workload, by_key, records, weighted

# Event weights, the stores and products that only scenarios touch, each region's warehouse, limits.
EVENT_WEIGHTS = {"new_order": 50, "advance_order": 30, "restock": 6, "cancel_order": 4, "price_change": 4, "store_change": 2, "new_store": 2, "rep_reassigned": 1, "product_discontinued": 0.5, "hard_delete": 0.5}
RESERVED_STORES, RESERVED_PRODUCTS = (1, 3), (1,)
WAREHOUSE_OF = {1: "nairobi_dc", 2: "nairobi_dc", 3: "mombasa_dc", 4: "kisumu_dc", 5: "kisumu_dc"}
ADVANCE_CANDIDATES, LOW_STOCK, LEAST_ACTIVE, DELETE_AFTER_HOURS = 50, 100, 150, 24

Change = tuple[str, DataFrame, str]


@dataclass(frozen=True)
class Live:
    """Events on ``tables`` (name: current rows) in a numbered batch."""

    workload: Workload
    tables: dict[str, DataFrame]
    batch: int

    def _u(self, purpose: str, *keys: Column) -> Column:
        return self.workload._u(purpose, F.lit(self.batch), *keys)

    def _whole(self, purpose: str, low, high, *keys: Column) -> Column:
        return self.workload._whole(purpose, low, high, F.lit(self.batch), *keys)

    def _pick(self, rows: DataFrame, purpose: str, *keys: str, n: int = 1) -> DataFrame:
        return rows.orderBy(self._u(purpose, *map(F.col, keys)), *keys).limit(n)

    def _signed(self, purpose: str, low: int, high: int, key: str) -> Column:
        size = low + self._u(purpose, F.col(key)) * (high - low)
        return F.when(self._u(f"{purpose}-sign", F.col(key)) < 0.5, -size).otherwise(size).cast("decimal(7,4)")

    def _orders(self) -> DataFrame:
        return self.tables["orders"].filter(~F.col("store_id").isin(*RESERVED_STORES))

    def _stores(self) -> DataFrame:
        return self.tables["stores"].filter(~F.col("store_id").isin(*RESERVED_STORES))

    def _products(self) -> DataFrame:
        return self.tables["products"].filter(F.col("is_active") & ~F.col("product_id").isin(*RESERVED_PRODUCTS))

    def new_order(self) -> list[Change]:
        """One order of a store by region weight and channel frequency, of products by popularity, within the stock."""
        weight = by_key("region_id", {i: w for i, (_, w) in enumerate(REGIONS, 1)}) * by_key("channel", {c: v[1] for c, v in CHANNELS.items()})
        store = self._stores().orderBy(-F.log(1 - self._u("store", F.col("store_id"))) / weight, "store_id").limit(1)
        rep = Window.partitionBy("store_id").orderBy(self._u("rep", F.col("rep_id")), "rep_id")
        store = store.join(self.tables["sales_reps"].select("rep_id", "region_id"), "region_id").withColumn("_n", F.row_number().over(rep)).filter("_n = 1")
        order_id = self.tables["orders"].agg((F.coalesce(F.max("order_id"), F.lit(0)) + 1).alias("m")).first()["m"]
        shape = lambda i, j: by_key("channel", {c: v[i][j] for c, v in CHANNELS.items()})
        store = store.withColumn("n_lines", self._whole("lines", shape(2, 0), shape(2, 1), F.col("store_id"))).withColumn("warehouse", by_key("region_id", WAREHOUSE_OF))
        sold = self.tables["order_items"].groupBy("product_id").agg(F.count("*").alias("n"))
        likes = self._products().join(sold, "product_id", "left").withColumn("at", -F.log(1 - self._u("pick", F.col("product_id"))) / (F.coalesce("n", F.lit(0)) + 1))
        likes = likes.orderBy("at", "product_id").limit(max(v[2][1] for v in CHANNELS.values()))
        likes = likes.withColumn("line", F.row_number().over(Window.orderBy("at", "product_id"))).select("product_id", "unit_price", "pack_size", "line")
        stock = self.tables["inventory"].join(likes, "product_id").join(store.select("store_id", "rep_id", "channel", "tier", "n_lines", "warehouse"), "warehouse").filter("line <= n_lines")
        asked = self._whole("quantity", shape(3, 0), shape(3, 1), F.col("product_id"))
        asked = F.when(F.contains("pack_size", F.lit(" x")), rules.case_quantity(asked, F.lit(6))).otherwise(asked)
        lines = stock.withColumn("quantity", rules.allocate(asked, F.col("qty_on_hand"))).filter("quantity > 0")
        off = F.lit(0.0)
        for tier, choices in TIER_DISCOUNTS.items():
            off = F.when(F.col("tier") == tier, F.element_at(F.array(*map(F.lit, choices)), self._whole("discount", 1, len(choices), F.col("product_id")))).otherwise(off)
        at = self.workload._now().alias("updated_at")
        oid = F.lit(order_id).cast("bigint")
        order = lines.select(oid.alias("order_id"), "store_id", "rep_id", self.workload._now().alias("order_ts"), F.lit("placed").alias("status"), at).distinct()
        items = lines.select((oid * 10 + F.col("line")).alias("order_item_id"), oid.alias("order_id"), "product_id", "quantity", "unit_price", off.cast("decimal(5,2)").alias("discount_pct"), at)
        left = lines.select("product_id", "warehouse", (F.col("qty_on_hand") - F.col("quantity")).alias("qty_on_hand"), at)
        return [("orders", order, "c"), ("order_items", items, "c"), ("inventory", left, "u")]

    def advance_order(self) -> list[Change]:
        """Three to seven of the oldest open orders, one step on."""
        n = random.Random(f"{self.workload.seed}:{self.batch}").randint(3, 7)
        oldest = self._orders().filter(F.col("status").isin(*rules.NEXT_STATUS)).orderBy("order_ts", "order_id").limit(ADVANCE_CANDIDATES)
        return [("orders", self._pick(oldest, "advance", "order_id", n=n).withColumn("status", rules.next_status(F.col("status"))), "u")]

    def cancel_order(self) -> list[Change]:
        """One order not shipped yet; its quantities return to the region's warehouse."""
        order = self._pick(self._orders().filter(rules.can_cancel(F.col("status"))), "cancel", "order_id").withColumn("status", F.lit("cancelled"))
        at = order.join(self.tables["stores"].select("store_id", by_key("region_id", WAREHOUSE_OF).alias("warehouse")), "store_id").select("order_id", "warehouse")
        back = self.tables["order_items"].join(at, "order_id").groupBy("product_id", "warehouse").agg(F.sum("quantity").alias("back"))
        stock = self.tables["inventory"].join(back, ["product_id", "warehouse"]).withColumn("qty_on_hand", (F.col("qty_on_hand") + F.col("back")).cast("int")).drop("back")
        return [("orders", order, "u"), ("inventory", stock, "u")]

    def hard_delete(self) -> list[Change]:
        """The oldest cancelled order that is a day old, its lines first."""
        aged = F.col("order_ts") < self.workload._now() - F.make_interval(hours=F.lit(DELETE_AFTER_HOURS))
        order = self._orders().filter((F.col("status") == "cancelled") & aged).orderBy("order_ts", "order_id").limit(1)
        return [("order_items", self.tables["order_items"].join(order.select("order_id"), "order_id", "left_semi"), "d"), ("orders", order, "d")]

    def restock(self) -> list[Change]:
        low = self.tables["inventory"].filter(F.col("qty_on_hand") < LOW_STOCK).join(self._products().select("product_id"), "product_id", "left_semi")
        more = self._whole("restock", 300, 1500, F.col("product_id"))
        return [("inventory", self._pick(low, "restock", "product_id", "warehouse").withColumn("qty_on_hand", F.col("qty_on_hand") + more), "u")]

    def price_change(self) -> list[Change]:
        p = self._pick(self._products(), "price", "product_id")
        return [("products", p.withColumn("unit_price", rules.changed_price(F.col("unit_price"), self._signed("pct", 3, 10, "product_id"))), "u")]

    def store_change(self) -> list[Change]:
        """A step of the tier, or another credit limit, at even odds."""
        k, tier_moves = F.col("store_id"), self._u("kind", F.col("store_id")) < 0.5
        tier = F.when(tier_moves, rules.tier_step(F.col("tier"), self._u("up", k) < 0.5)).otherwise(F.col("tier"))
        limit = F.when(tier_moves, F.col("credit_limit")).otherwise(rules.changed_credit_limit(F.col("credit_limit"), self._signed("credit", 10, 25, "store_id")))
        return [("stores", self._pick(self._stores(), "store", "store_id").withColumns({"tier": tier, "credit_limit": limit}), "u")]

    def new_store(self) -> list[Change]:
        """The next store, on the lowest tier."""
        k = F.col("store_id")
        row = self.tables["stores"].agg((F.coalesce(F.max("store_id"), F.lit(0)) + 1).cast("int").alias("store_id"))
        row = row.withColumn("channel", weighted({c: v[0] for c, v in CHANNELS.items()}, self._u("channel", k))).withColumn("region_id", weighted({i: w for i, (_, w) in enumerate(REGIONS, 1)}, self._u("region", k)).cast("int"))
        limit = by_key("channel", {c: v[4][0] for c, v in CHANNELS.items()}).cast("decimal(12,2)")
        return [("stores", row.select("store_id", F.concat(F.initcap("channel"), F.lit(" "), k.cast("string")).alias("name"), "channel", "region_id", F.lit(next(iter(TIER_SHARES))).alias("tier"), limit.alias("credit_limit"), self.workload._now().alias("updated_at")), "c")]

    def rep_reassigned(self) -> list[Change]:
        """A rep whose region keeps another one moves to a different region."""
        spare = self.tables["sales_reps"].withColumn("_n", F.count("*").over(Window.partitionBy("region_id"))).filter("_n > 1").drop("_n")
        moved = (F.col("region_id") - 1 + self._whole("move", 1, len(REGIONS) - 1, F.col("rep_id"))) % len(REGIONS) + 1
        return [("sales_reps", self._pick(spare, "rep", "rep_id").withColumn("region_id", moved.cast("int")), "u")]

    def product_discontinued(self) -> list[Change]:
        """One active product, while more than the least number are active."""
        enough = self.tables["products"].filter("is_active").count() > LEAST_ACTIVE
        return [("products", self._pick(self._products(), "discontinue", "product_id", n=int(enough)).withColumn("is_active", F.lit(False)), "u")]

    def changes(self, event: str) -> list[Change]:
        if event not in EVENT_WEIGHTS:
            raise ValueError(f"no event {event}")
        run: Callable[[], list[Change]] = getattr(self, event)
        return run()

    def log(self, event: str, lsn: int, at: Column | None = None) -> DataFrame:
        """The event's change records at a time (default: a second a batch), with LSNs from ``lsn`` on in the order of its tables."""
        at = self.workload._now() + F.expr(f"interval {self.batch} seconds") if at is None else at
        return reduce(DataFrame.unionByName, [records(rows, table, F.lit(op), F.lit(lsn + i), at) for i, (table, rows, op) in enumerate(self.changes(event))])


def draw_events(seed: int, n: int) -> list[str]:
    """``n`` kinds of events at their weights, the same for a seed."""
    return random.Random(seed).choices(list(EVENT_WEIGHTS), list(EVENT_WEIGHTS.values()), k=n)
