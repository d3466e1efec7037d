"""A deterministic source system: seed tables, their snapshot as change records, and four scripted scenarios.

Every draw is a hash of (seed, purpose, row), so tables are the same under any partitioning, one section
never moves another's draws, and size is a matter of parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.specs import DIMENSIONS, FACTS

# Regions with their weights, channels, tiers, weekdays from Monday, order states by age in hours.
REGIONS = (("Nairobi", 0.35), ("Central", 0.20), ("Coast", 0.18), ("Rift Valley", 0.15), ("Western", 0.12))
WAREHOUSES = ("nairobi_dc", "mombasa_dc", "kisumu_dc")
CHANNELS = {"supermarket": (0.30, 1.5, (4, 8), (5, 40), (200_000, 1_000_000)), "kiosk": (0.50, 1.0, (1, 3), (1, 6), (20_000, 50_000)), "wholesale": (0.20, 2.0, (3, 8), (10, 80), (500_000, 2_000_000))}
TIER_SHARES = {"bronze": 0.6, "silver": 0.3, "gold": 0.1}
TIER_DISCOUNTS = {"bronze": (0.0,), "silver": (0.0, 2.5), "gold": (0.0, 2.5, 5.0)}
WEEKDAY = (1.0, 1.0, 1.0, 1.05, 1.15, 0.9, 0.6)
STATUS_BY_AGE = ((6, {"placed": 0.60, "confirmed": 0.35, "cancelled": 0.05}), (24, {"confirmed": 0.30, "shipped": 0.62, "cancelled": 0.08}), (72, {"shipped": 0.30, "delivered": 0.63, "cancelled": 0.07}), (1_000_000, {"delivered": 0.93, "cancelled": 0.07}))
CATEGORIES = ("beverages", "dairy", "snacks", "personal_care", "household")
PRICE_STEPS_PCT, BURST_TIERS = (5, -3, 8), ("silver", "gold", "silver")
CASE_DIVISOR = 6


@dataclass(frozen=True)
class Workload:
    """Sizes of the seed; ``now`` (UTC) ends the order history.  Products: 8 for each of 5 brands of a category."""

    spark: SparkSession
    now: str = "2026-10-03 12:00:00"
    seed: int = 42
    stores_n: int = 50
    reps_n: int = 10
    days: int = 30
    orders_per_day: int = 80

    def _u(self, purpose: str, *keys: Column) -> Column:
        """Uniform in [0, 1) from the row's keys."""
        return F.pmod(F.xxhash64(F.lit(self.seed), F.lit(purpose), *keys), F.lit(1 << 52)) / F.lit(float(1 << 52))

    def _whole(self, purpose: str, low: Column | int, high: Column | int, *keys: Column) -> Column:
        low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
        return (low + F.floor(self._u(purpose, *keys) * (high - low + 1))).cast("int")

    def _now(self) -> Column:
        return F.lit(self.now).cast("timestamp")

    def regions(self) -> DataFrame:
        names = F.array(*[F.lit(n) for n, _ in REGIONS])
        rows = self.spark.range(1, len(REGIONS) + 1).select(F.col("id").cast("int").alias("region_id"))
        return rows.select("region_id", F.element_at(names, F.col("region_id")).alias("name"), F.lit("Kenya").alias("country"), self._now().alias("updated_at"))

    def stores(self) -> DataFrame:
        k = F.col("store_id")
        rows = self.spark.range(1, self.stores_n + 1).select(F.col("id").cast("int").alias("store_id"))
        rows = rows.withColumn("channel", weighted({c: v[0] for c, v in CHANNELS.items()}, self._u("channel", k)))
        rows = rows.withColumn("region_id", weighted({i: w for i, (_, w) in enumerate(REGIONS, 1)}, self._u("region", k)).cast("int"))
        limit = self._whole("limit", by_key("channel", {c: v[4][0] // 1000 for c, v in CHANNELS.items()}), by_key("channel", {c: v[4][1] // 1000 for c, v in CHANNELS.items()}), k) * 1000
        name = F.concat(F.initcap("channel"), F.lit(" "), k.cast("string"))
        return rows.select("store_id", name.alias("name"), "channel", "region_id", weighted(TIER_SHARES, self._u("tier", k)).alias("tier"), limit.cast("decimal(12,2)").alias("credit_limit"), self._now().alias("updated_at"))

    def products(self) -> DataFrame:
        """Each pack as a single unit and as a case, the case at its own rounded price."""
        n = F.col("id").cast("int")
        pack, is_case = F.floor(n / 2).cast("int"), n % 2 == 1
        category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.floor(pack / 20) + 1).cast("int"))
        brand = F.concat(F.lit("Brand "), (F.floor(pack / 4) + 1).cast("string"))
        units = F.when(F.floor(pack / 4) % 2 == 0, 24).otherwise(12)
        single = (self._whole("price", 4, 60, pack) * 10).cast("decimal(12,2)")
        size = F.concat(((pack % 4 + 1) * 250).cast("string"), F.lit("ml"), F.when(is_case, F.concat(F.lit(" x"), units.cast("string"))).otherwise(""))
        sku = F.format_string("%s-%03d-%s", F.upper(F.substring(category, 1, 3)), pack + 1, F.when(is_case, F.concat(F.lit("C"), units.cast("string"))).otherwise("EA"))
        price = F.when(is_case, rules.case_price(single, units)).otherwise(single)
        rows = self.spark.range(len(CATEGORIES) * 40)
        return rows.select((n + 1).alias("product_id"), sku.alias("sku"), F.concat_ws(" ", brand, size).alias("name"), brand.alias("brand"), category.alias("category"), size.alias("pack_size"), price.cast("decimal(12,2)").alias("unit_price"), F.lit(True).alias("is_active"), self._now().alias("updated_at"))

    def sales_reps(self) -> DataFrame:
        """Round-robin across the regions."""
        k = F.col("id").cast("int")
        return self.spark.range(1, self.reps_n + 1).select(k.alias("rep_id"), F.concat(F.lit("Rep "), k.cast("string")).alias("name"), ((k - 1) % len(REGIONS) + 1).cast("int").alias("region_id"), self._now().alias("updated_at"))

    def inventory(self) -> DataFrame:
        """A tenth of the product and warehouse pairs start low."""
        k = (F.col("product_id"), F.col("warehouse"))
        rows = self.products().select("product_id", F.explode(F.array(*map(F.lit, WAREHOUSES))).alias("warehouse"))
        return rows.select(*k, F.when(self._u("low", *k) < 0.1, self._whole("stock", 0, 20, *k)).otherwise(self._whole("stock", 50, 1500, *k)).alias("qty_on_hand"), self._now().alias("updated_at"))

    def _placed(self) -> DataFrame:
        """Orders with their store's channel and tier.  Store weights (``stores_n`` rows) become one literal."""
        share, frequency = dict(enumerate((w for _, w in REGIONS), 1)), {c: v[1] for c, v in CHANNELS.items()}
        at = self.stores().orderBy("store_id").select("region_id", "channel").collect()
        total, ends = 0.0, []
        for r in at:
            total += share[r["region_id"]] * frequency[r["channel"]]
            ends.append(total)
        ends = F.array(*[F.lit(x / total) for x in ends[:-1]]).cast("array<double>")
        day = F.date_add(F.to_date(self._now() + F.expr("interval 3 hours")), (F.col("id") - self.days).cast("int"))
        factor = F.element_at(F.array(*map(F.lit, WEEKDAY)), F.weekday(day) + 1)
        count = F.round(self.orders_per_day * factor * (0.85 + 0.3 * self._u("count", F.col("id")))).cast("int")
        rows = self.spark.range(self.days + 1).filter(count > 0).select("id", day.alias("day"), F.explode(F.sequence(F.lit(1), count)).alias("i"))
        key = F.col("id") * 1_000_000_000 + F.col("i")
        opened = F.unix_seconds(F.col("day").cast("timestamp")) + 4 * 3600 + self._whole("second", 0, 12 * 3600 - 1, key)
        rows = rows.select(key.alias("order_id"), F.timestamp_seconds(opened).alias("order_ts")).filter(F.col("order_ts") <= self._now())
        rows = rows.withColumn("store_id", (F.size(F.filter(ends, lambda x: x <= self._u("store", F.col("order_id")))) + 1).cast("int"))
        return rows.join(self.stores().select("store_id", "channel", "tier", "region_id"), "store_id")

    def orders(self) -> DataFrame:
        k = F.col("order_id")
        age = (F.unix_seconds(self._now()) - F.unix_seconds("order_ts")) / 3600
        status = F.lit(None)
        for hours, weights in reversed(STATUS_BY_AGE):
            status = F.when(age <= hours, weighted(weights, self._u("status", k))).otherwise(status)
        # The region's reps are region_id, region_id + 5, ...
        peers = F.floor((self.reps_n - F.col("region_id")) / len(REGIONS))
        rep = F.col("region_id") + len(REGIONS) * self._whole("rep", F.lit(0), peers, k)
        return self._placed().select("order_id", "store_id", rep.cast("int").alias("rep_id"), "order_ts", status.alias("status"), F.col("order_ts").alias("updated_at"))

    def order_items(self) -> DataFrame:
        """Distinct products of an order, drawn without replacement at Zipf weights by exponential keys."""
        k = F.col("order_id")
        shape = lambda i, j: by_key("channel", {c: v[i][j] for c, v in CHANNELS.items()})
        ids = F.sequence(F.lit(1), F.lit(len(CATEGORIES) * 40))
        # An affine permutation of the products is their rank of popularity.
        rank = lambda p: F.pmod(p * 77 + self.seed, F.lit(len(CATEGORIES) * 40)) + 1
        keyed = F.transform(ids, lambda p: F.struct((-F.log(1 - self._u("pick", k, p)) * rank(p)).alias("at"), p.alias("product_id")))
        picked = F.slice(F.array_sort(keyed), F.lit(1), self._whole("lines", shape(2, 0), shape(2, 1), k))
        rows = self._placed().select("order_id", "order_ts", "channel", "tier", F.posexplode(picked).alias("line", "pick"))
        rows = rows.select("*", F.col("pick.product_id").alias("product_id")).join(self.products().select("product_id", "unit_price", "pack_size"), "product_id")
        pair = (k, F.col("product_id"))
        quantity = self._whole("quantity", shape(3, 0), shape(3, 1), *pair)
        quantity = F.when(F.contains("pack_size", F.lit(" x")), rules.case_quantity(quantity, F.lit(CASE_DIVISOR))).otherwise(quantity)
        off = F.lit(0.0)
        for tier, choices in TIER_DISCOUNTS.items():
            off = F.when(F.col("tier") == tier, F.element_at(F.array(*map(F.lit, choices)), self._whole("discount", 1, len(choices), *pair))).otherwise(off)
        return rows.select((k * 10 + F.col("line")).alias("order_item_id"), "order_id", "product_id", quantity.cast("int").alias("quantity"), "unit_price", off.cast("decimal(5,2)").alias("discount_pct"), F.col("order_ts").alias("updated_at"))

    def table(self, name: str) -> DataFrame:
        return {"regions": self.regions, "stores": self.stores, "products": self.products, "sales_reps": self.sales_reps, "orders": self.orders, "order_items": self.order_items, "inventory": self.inventory}[name]()

    def snapshot(self, name: str) -> DataFrame:
        """A table's rows as snapshot records; LSN 1 for all, as one transaction reads them."""
        return records(self.table(name), name, F.lit("r"), F.lit(1), self._now(), F.monotonically_increasing_id())

    def scenario(self, name: str) -> DataFrame:
        """Change records of a scripted case, to be applied after the snapshots of its table.

        ``price``: product 1 changes thrice (four versions); ``burst``: store 1 changes tier thrice, all in
        one batch; ``lifecycle``: a new order of store 3 is delivered, another cancelled; ``delete``: the
        cancelled one is deleted.  Orders of scenarios have negative ids.
        """
        if name == "price":
            p, steps, price = self.products().filter("product_id = 1"), [], F.col("unit_price")
            for pct in PRICE_STEPS_PCT:
                price = rules.changed_price(price, F.lit(pct))
                steps.append((p.withColumn("unit_price", price), "u"))
            return self._script("products", steps, 100)
        if name == "burst":
            s = self.stores().filter("store_id = 1")
            first = F.when(F.col("tier") == BURST_TIERS[0], "bronze").otherwise(BURST_TIERS[0])
            tiers = [first, *[F.lit(t) for t in BURST_TIERS[1:]]]
            return self._script("stores", [(s.withColumn("tier", t), "u") for t in tiers], 200)
        order = lambda i, status: self.spark.range(1).select(F.lit(i).cast("bigint").alias("order_id"), F.lit(3).alias("store_id"), F.lit(1).alias("rep_id"), self._now().alias("order_ts"), F.lit(status).alias("status"), self._now().alias("updated_at"))
        if name == "lifecycle":
            path = ["placed"]
            while path[-1] in rules.NEXT_STATUS:
                path.append(rules.NEXT_STATUS[path[-1]])
            steps = [(order(-1, s), "u" if i else "c") for i, s in enumerate(path)]
            return self._script("orders", [*steps, (order(-2, "placed"), "c"), (order(-2, "cancelled"), "u")], 300)
        if name == "delete":
            return self._script("orders", [(order(-2, "cancelled"), "d")], 400)
        raise ValueError(f"no scenario {name}")

    def _script(self, table: str, steps: list[tuple[DataFrame, str]], lsn: int) -> DataFrame:
        made = [records(rows, table, F.lit(op), F.lit(lsn + i), self._now() + F.expr(f"interval {lsn + i} seconds")) for i, (rows, op) in enumerate(steps)]
        return reduce(DataFrame.unionByName, made)


def weighted(weights: dict, u: Column) -> Column:
    """The key whose share of the cumulated weights holds ``u``; shares must add up to 1."""
    names = list(weights)
    out, end = F.lit(names[-1]), 1.0
    for name in reversed(names[:-1]):
        end = sum(weights[n] for n in names[: names.index(name) + 1])
        out = F.when(u < end, F.lit(name)).otherwise(out)
    return out


def by_key(column: str, values: dict) -> Column:
    """A value for each value of a column."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col(column))


def records(rows: DataFrame, table: str, op: Column, lsn: Column, at: Column, offset: Column | None = None) -> DataFrame:
    """Rows as broker records of a table's topic; unless given, offsets follow the LSN, behind all of a snapshot."""
    spec = FACTS.get(table) or DIMENSIONS[table]
    utc = lambda c, t: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c) if t == "TIMESTAMP" else F.col(c).cast("string").alias(c) if t.startswith("DECIMAL") else F.col(c)
    meta = (op.alias("__op"), lsn.cast("bigint").alias("__source_lsn"), F.unix_millis(at).alias("__source_ts_ms"), (op == "d").cast("string").alias("__deleted"))
    return rows.select(
        F.to_json(F.struct(*spec.keys)).cast("binary").alias("key"),
        F.to_json(F.struct(*[utc(c, t) for c, t in spec.columns], *meta)).cast("binary").alias("value"),
        F.lit(f"fmcg.public.{table}").alias("topic"),
        F.lit(0).alias("partition"),
        (F.lit(1 << 50) + lsn.cast("bigint") if offset is None else offset).alias("offset"),
        at.alias("timestamp"),
    )
