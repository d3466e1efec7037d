"""Marts: facts joined to dimensions as of the time of sale, calendars and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def point_in_time(facts: DataFrame, versions: DataFrame, key: str, at: str, take: dict[str, str]) -> DataFrame:
    """``facts`` with columns of the version whose half-open window holds ``at``; NULL where there is none.

    Equality on the key carries the join, the window is its remaining condition.
    """
    v = versions.select(F.col(key).alias("_key"), "valid_from", "valid_to", *[F.col(c).alias(n) for c, n in take.items()])
    on = (F.col(key) == F.col("_key")) & (F.col(at) >= F.col("valid_from")) & (F.col(at) < F.col("valid_to"))
    return facts.join(v, on, "left").drop("_key", "valid_from", "valid_to")


def line_value(quantity: str = "quantity", price: str = "unit_price", discount_pct: str = "discount_pct") -> Column:
    return F.col(quantity) * F.col(price) * (1 - F.col(discount_pct) / 100)


def fct_sales(items: DataFrame, orders: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with the store's and product's version at the time of the order."""
    lines = items.filter("not is_deleted").drop("updated_at").join(orders.filter("not is_deleted").select("order_id", "store_id", "rep_id", "order_ts", "status"), "order_id")
    lines = point_in_time(lines, stores, "store_id", "order_ts", {"store_sk": "store_sk", "region_id": "region_id", "tier": "tier"})
    lines = point_in_time(lines, products, "product_id", "order_ts", {"product_sk": "product_sk", "brand": "brand", "category": "category"})
    return lines.select("order_item_id", "order_id", F.to_date("order_ts").alias("date"), "store_sk", "product_sk", "rep_id", "region_id", "tier", "brand", "category", "status", "quantity", F.round(line_value(), 2).alias("amount"))


def dim_date(facts: DataFrame, at: str) -> DataFrame:
    """One row per day from the first to the last of ``at``."""
    ends = facts.agg(F.to_date(F.min(at)).alias("a"), F.to_date(F.max(at)).alias("b"))
    days = ends.filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("date"))
    return days.select("date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"), F.day("date").alias("day"), (F.weekday("date") + 1).alias("iso_weekday"), (F.weekday("date") >= 5).alias("is_weekend"))


def daily_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("date", "region_id", "brand").agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"))


def value_history(versions: DataFrame, key: str, value: str) -> DataFrame:
    """Each version's value beside the one before it: price history, tier movements."""
    order = Window.partitionBy(key).orderBy("valid_from", "source_lsn")
    return versions.select(key, "valid_from", "valid_to", F.col(value), F.lag(value).over(order).alias(f"previous_{value}"))


def popularity(items: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """Sales lines per product plus one, so that unsold products can still be drawn."""
    counts = items.groupBy(key).agg(F.count("*").alias("_n"))
    return products.select(key).join(counts, key, "left").select(key, (F.coalesce("_n", F.lit(0)) + 1).alias("weight"))
