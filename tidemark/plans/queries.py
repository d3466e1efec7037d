"""Registered queries over the driver's tables and the SQL that states each of them for DuckDB.

``events`` is read as a change log of users: key user_id, LSN event_id + 1, broker offset event_id,
signup r, view and click u, purchase c, error d; event_type and the value's hundreds are its columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.operators import bronze, facts, gold, reconcile, scd2
from tidemark.session import fresh_path
from tidemark.specs import Table

COLUMNS = "user_id BIGINT, event_type STRING, hundreds BIGINT"
USERS = Table("users", COLUMNS, ("user_id",))
USER_VERSIONS = Table("dim_user", COLUMNS, ("user_id",), "users", "user_sk", ("event_type", "hundreds"))


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events")
    op = F.when(F.col("event_type") == "signup", "r").when(F.col("event_type") == "purchase", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return e.select(
        "user_id",
        "event_type",
        F.floor(F.col("value") / 100).alias("hundreds"),
        op.alias("op"),
        (F.col("event_id") + 1).alias("source_lsn"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("source_ts_ms"),
        (op == "d").alias("is_deleted"),
        F.col("event_id").alias("kafka_offset"),
    )


def records(spark: SparkSession, sf: str) -> DataFrame:
    """The log as broker records: the first of every fifty have a fault of each kind, the tenth repeats an offset."""
    log = change_log(spark, sf)
    n = F.col("kafka_offset") % 50
    lsn = F.when(n == 5, "abc").when(n == 4, F.lit(None)).otherwise(F.col("source_lsn").cast("string"))
    payload = F.to_json(
        F.struct(
            "user_id",
            "event_type",
            "hundreds",
            F.when(n == 3, "x").otherwise(F.col("op")).alias("__op"),
            lsn.alias("__source_lsn"),
            F.when(n != 6, F.col("source_ts_ms")).alias("__source_ts_ms"),
            F.col("is_deleted").cast("string").alias("__deleted"),
        )
    )
    value = F.when(n == 0, F.lit(None)).when(n == 1, "{not json").otherwise(payload)
    return log.select(
        F.to_json(F.struct("user_id")).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.when(n == 2, "fmcg.public.Bad-Name").otherwise("fmcg.public.users").alias("topic"),
        F.lit(0).alias("partition"),
        F.when(n == 9, F.col("kafka_offset") - 1).otherwise(F.col("kafka_offset")).alias("offset"),
        F.lit("2026-10-04 09:00:00").cast("timestamp").alias("timestamp"),
    )


def cdc_parse(spark, sf):
    rows = bronze.accepted(bronze.parse_cdc(records(spark, sf)), "users")
    return facts.parse(rows, USERS)


def typed_values(spark, sf):
    """Payload texts of lines as every declared type, some of them no values of their type."""
    kinds = Table("lines", "line BIGINT, part INT, price DECIMAL(12,2), seen_at TIMESTAMP, is_open BOOLEAN, note STRING", ("line",))
    odd = F.col("l_linenumber")
    payload = F.to_json(F.struct((F.col("l_orderkey") * 10 + odd).alias("line"), F.when(odd == 1, "x1").otherwise(F.col("l_partkey").cast("string")).alias("part"), F.when(odd == 2, "n/a").otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("price"), F.when(odd == 3, "soon").otherwise(F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T10:00:00.250000Z"))).alias("seen_at"), F.when(odd == 4, "TRUE").otherwise((odd > 2).cast("string")).alias("is_open"), F.when(odd != 5, "ß").alias("note")))
    log = _t(spark, sf, "lineitem").select(payload.alias("payload"), F.lit("c").alias("op"), F.lit(1).cast("long").alias("source_lsn"), F.lit(1).cast("long").alias("source_ts_ms"), F.lit(False).alias("is_deleted"), F.lit(1).cast("long").alias("kafka_offset"))
    return facts.parse(log, kinds).select(*kinds.column_names)


def cdc_quarantine_reasons(spark, sf):
    return bronze.parse_cdc(records(spark, sf)).filter("quarantine_reason is not null").groupBy("table", "quarantine_reason").agg(F.count("*").alias("n"))


def bronze_counts_by_op(spark, sf):
    return bronze.counts_by_op(bronze.accepted(bronze.parse_cdc(records(spark, sf))), "table")


def bronze_duplicate_offsets(spark, sf):
    return bronze.duplicate_offsets(bronze.accepted(bronze.parse_cdc(records(spark, sf))))


def bronze_batch_counts(spark, sf):
    return bronze.batch_counts(bronze.parse_cdc(records(spark, sf)))


def bronze_health(spark, sf):
    return bronze.health(bronze.accepted(bronze.parse_cdc(records(spark, sf))))


def latest_per_key(spark, sf):
    return facts.latest_per_key(change_log(spark, sf), USERS)


def latest_live_only(spark, sf):
    return facts.live(latest_per_key(spark, sf)).select("user_id", "event_type", "hundreds")


def soft_deleted_keys(spark, sf):
    return latest_per_key(spark, sf).filter("is_deleted").select("user_id", "source_lsn")


def _halves(spark, sf):
    log = change_log(spark, sf)
    early = F.col("source_lsn") % 1000 < 500
    return log.filter(early), log.filter(~early)


def _merged(spark, sf):
    empty = spark.createDataFrame([], "user_id bigint, event_type string, hundreds bigint, source_lsn bigint, source_ts_ms bigint, is_deleted boolean, silver_updated_at timestamp")
    out = empty
    for half in _halves(spark, sf):
        out = facts.apply_latest(out, facts.latest_per_key(half, USERS), USERS)
    return out.drop("silver_updated_at")


def merge_two_batches(spark, sf):
    return _merged(spark, sf)


def _version_log(spark, sf):
    """The log with a tracked value that every eleventh event lacks."""
    return change_log(spark, sf).withColumn("hundreds", F.when(F.col("source_lsn") % 11 != 0, F.col("hundreds")))


def _versions(spark, sf):
    return scd2.scd2_history(_version_log(spark, sf), USER_VERSIONS)


_SHOWN = ("user_id", "event_type", "hundreds", "row_hash", "valid_from", "valid_to", "is_current", "is_deleted", "source_lsn", "source_ts_ms")


def scd2_history(spark, sf):
    return _versions(spark, sf).select(*_SHOWN)


def scd2_incremental_two_batches(spark, sf):
    log = _version_log(spark, sf)
    middle = F.col("source_lsn") <= log.agg((F.max("source_lsn") / 2).cast("long")).first()[0]
    first, second = log.filter(middle), log.filter(~middle)
    # What the first batch leaves is stored, as the job stores it.
    stored = _stored(scd2.scd2_history(first, USER_VERSIONS), "versions")
    seen = _stored(first.groupBy("user_id").agg(F.max("source_lsn").alias("high_lsn")), "seen")
    return scd2.scd2_apply(stored, second, USER_VERSIONS, seen).select(*_SHOWN)


def scd2_noops(spark, sf):
    made = _versions(spark, sf).select("user_id", "source_lsn")
    return change_log(spark, sf).filter("not is_deleted").join(made, ["user_id", "source_lsn"], "left_anti").select("user_id", "source_lsn", "event_type")


def _planted_versions(spark, sf):
    """Two versions of each customer, two thirds of them with a fault: one of eight kinds by the key's remainder by 12."""
    day = lambda n: F.timestamp_seconds(F.lit(1_600_000_000) + F.lit(n) * 86_400)
    kind = F.col("c_custkey") % 12
    far = F.lit("9999-12-31 00:00:00").cast("timestamp")
    keys = _t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), kind.alias("kind"))
    start = {1: F.when(F.col("kind") == 2, day(20)).otherwise(day(0)), 2: F.when(F.col("kind") == 3, day(12)).when(F.col("kind") == 4, day(8)).when(F.col("kind") == 5, day(8)).when(F.col("kind") == 8, day(15)).otherwise(day(10))}
    end = {1: F.when(F.col("kind") == 2, day(5)).otherwise(day(10)), 2: F.when(F.col("kind") == 7, day(30)).otherwise(far)}
    current = {1: F.col("kind").isin(1, 6), 2: ~F.col("kind").isin(6, 7, 9)}
    gone = {1: F.col("kind").isin(5, 8), 2: F.col("kind") == 9}
    version = lambda n: keys.select("user_id", F.lit(n).cast("long").alias("source_lsn"), start[n].alias("valid_from"), end[n].alias("valid_to"), current[n].alias("is_current"), gone[n].alias("is_deleted"))
    return version(1).unionByName(version(2))


def scd2_violations(spark, sf):
    """What the checker finds among sound versions and planted faults; the engine's own versions add none."""
    own = scd2.violations(_versions(spark, sf), "user_id").select("user_id", "source_lsn", "violation")
    return own.unionByName(scd2.violations(_planted_versions(spark, sf), "user_id").select("user_id", "source_lsn", "violation"))


def scd2_summary(spark, sf):
    return scd2.summary(_versions(spark, sf), "user_id")


def _part_versions(spark, sf):
    """Two versions of each part: one up to 1995, one from then on at a price changed by 5 %."""
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", F.col("p_retailprice").cast("decimal(12,2)").alias("price"))
    cutoff = F.lit("1995-01-01 00:00:00").cast("timestamp")
    start, end = F.lit("1900-01-01 00:00:00").cast("timestamp"), F.lit("9999-12-31 00:00:00").cast("timestamp")
    old = p.select("p_partkey", "p_brand", "price", start.alias("valid_from"), cutoff.alias("valid_to"), F.lit(1).alias("source_lsn"))
    new = p.select("p_partkey", "p_brand", rules.changed_price(F.col("price"), F.lit(5)).alias("price"), cutoff.alias("valid_from"), end.alias("valid_to"), F.lit(2).alias("source_lsn"))
    return old.unionByName(new)


def _lines(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("order_ts"))
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("decimal(12,2)").alias("quantity"), F.col("l_extendedprice").cast("decimal(12,2)").alias("extended"), F.col("l_discount").cast("decimal(5,2)").alias("discount"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("p_partkey", F.col("l_partkey"))


def pit_join_sales(spark, sf):
    sold = gold.point_in_time(_lines(spark, sf), _part_versions(spark, sf), "p_partkey", "order_ts", {"price": "price_then", "source_lsn": "version"})
    return sold.groupBy("l_partkey", "version", "price_then").agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))


def _sales(spark, sf):
    """Lines with date, region and brand.  Regions join the orders first, so that lines are dealt once less."""
    c, n, r = (_t(spark, sf, x) for x in ("customer", "nation", "region"))
    places = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    orders = _t(spark, sf, "orders").join(places, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.to_date("o_orderdate").alias("date"), "r_name")
    parts = _t(spark, sf, "part").select(F.col("p_partkey").alias("_part"), "p_brand")
    amount = F.round(F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(5,2)")), 2).cast("decimal(14,2)")
    lines = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").cast("decimal(12,2)").alias("quantity"), amount.alias("amount"))
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("_part"))
    return sold.select("l_orderkey", "l_partkey", "date", "r_name", "p_brand", "quantity", "amount")


def fct_sales(spark, sf):
    """The mart's fact over versions with windows: customers stand for stores, parts for products."""
    lines = _lines(spark, sf).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.lit(2).alias("quantity"), F.col("extended").alias("unit_price"), (F.col("discount") * 100).cast("decimal(5,2)").alias("discount_pct"), F.lit(None).cast("timestamp").alias("updated_at"), (F.col("l_linenumber") == 7).alias("is_deleted"))
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("store_id"), (F.col("o_custkey") % 10).alias("rep_id"), F.col("o_orderdate").cast("timestamp").alias("order_ts"), F.col("o_orderstatus").alias("status"), (F.col("o_orderkey") % 5 == 0).alias("is_deleted"))
    cutoff = F.lit("1995-01-01 00:00:00").cast("timestamp")
    start, end = F.lit("1993-01-01 00:00:00").cast("timestamp"), F.lit("9999-12-31 00:00:00").cast("timestamp")
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("store_id"), F.col("c_nationkey").alias("region_id"))
    store = lambda n, tier, a, b: c.select("store_id", "region_id", (F.col("store_id") * 2 + n).alias("store_sk"), F.lit(tier).alias("tier"), a.alias("valid_from"), b.alias("valid_to"))
    stores = store(0, "bronze", start, cutoff).unionByName(store(1, "silver", cutoff, end))
    p = _part_versions(spark, sf)
    products = p.select(F.col("p_partkey").alias("product_id"), (F.col("p_partkey") * 2 + F.col("source_lsn")).alias("product_sk"), F.col("p_brand").alias("brand"), F.concat(F.lit("kind "), F.col("source_lsn")).alias("category"), "valid_from", "valid_to")
    return gold.fct_sales(lines, o, stores, products)


def daily_sales_region_brand(spark, sf):
    return gold.daily_sales(_sales(spark, sf).select("date", F.col("r_name").alias("region_id"), F.col("p_brand").alias("brand"), "quantity", "amount"))


def dim_date(spark, sf):
    return gold.dim_date(_t(spark, sf, "orders").select(F.col("o_orderdate").cast("timestamp").alias("order_ts")), "order_ts")


def price_history(spark, sf):
    return gold.value_history(_part_versions(spark, sf), "p_partkey", "price")


def tier_movements(spark, sf):
    """Customers whose kind changed between two versions, by the move."""
    c = _t(spark, sf, "customer").select("c_custkey", F.element_at(F.array(*map(F.lit, rules.TIERS)), (F.col("c_custkey") % 3 + 1).cast("int")).alias("tier"))
    at = lambda y: F.lit(f"{y}-01-01 00:00:00").cast("timestamp")
    old = c.select("c_custkey", "tier", at(2020).alias("valid_from"), at(2021).alias("valid_to"), F.lit(1).alias("source_lsn"))
    new = c.select("c_custkey", rules.tier_step(F.col("tier"), F.col("c_custkey") % 2 == 0).alias("tier"), at(2021).alias("valid_from"), at(9999).alias("valid_to"), F.lit(2).alias("source_lsn"))
    moved = gold.value_history(old.unionByName(new), "c_custkey", "tier").filter("previous_tier <> tier")
    return moved.groupBy("previous_tier", "tier").agg(F.count("*").alias("n"))


def order_value(spark, sf):
    lines = _lines(spark, sf).withColumns({"pieces": F.lit(1), "discount_pct": (F.col("discount") * 100).cast("decimal(5,2)")})
    return lines.groupBy("l_orderkey").agg(F.sum(F.round(gold.line_value("pieces", "extended", "discount_pct"), 2)).cast("decimal(18,2)").alias("order_value"))


def reconcile_missing_extra_differs(spark, sf):
    early, late = _halves(spark, sf)
    a = facts.live(facts.latest_per_key(early, USERS))
    b = facts.live(facts.latest_per_key(late, USERS))
    return reconcile.compare(a, b, ("user_id",), ("event_type", "hundreds"))


def semi_join_batch_keys(spark, sf):
    batch = change_log(spark, sf).filter("op = 'r'")
    return scd2.stored_of_batch(latest_live_only(spark, sf), batch, "user_id")


def topn_oldest_open(spark, sf):
    o = _t(spark, sf, "orders").filter("o_orderstatus = 'O'")
    return o.orderBy("o_orderdate", "o_orderkey").limit(50).select("o_orderkey", "o_orderstatus")


def distinct_keys(spark, sf):
    return facts.distinct_keys(change_log(spark, sf), ("user_id",))


def union_chain(spark, sf):
    log = change_log(spark, sf)
    kind = lambda df, name: df.select("user_id", "source_lsn", F.lit(name).alias("kind"))
    return kind(log.filter("op = 'r'"), "snapshot").unionByName(kind(log.filter("op in ('c', 'u')"), "change")).unionByName(kind(log.filter("is_deleted"), "delete"))


def key_sets(spark, sf):
    early, late = (x.filter("op = 'r'").select("user_id") for x in _halves(spark, sf))
    tag = lambda df, name: df.select("user_id", F.lit(name).alias("side"))
    return tag(early.intersect(late), "both").unionByName(tag(early.subtract(late), "early")).unionByName(tag(late.subtract(early), "late"))


def popularity_smoothed(spark, sf):
    return gold.popularity(_t(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey")), _t(spark, sf, "part"), "p_partkey")


def several_per_region(spark, sf):
    n = _t(spark, sf, "supplier")
    return n.withColumn("peers", F.count("*").over(Window.partitionBy("s_nationkey"))).filter("peers > 1").select("s_suppkey", "s_nationkey", "peers")


def order_state_rules(spark, sf):
    status = F.when(F.col("o_orderstatus") == "O", "placed").when(F.col("o_orderstatus") == "P", "confirmed").when(F.col("o_orderkey") % 3 == 0, "shipped").otherwise("delivered")
    o = _t(spark, sf, "orders").select("o_orderkey", status.alias("status"))
    return o.select("o_orderkey", "status", rules.next_status(F.col("status")).alias("next_status"), rules.can_cancel(F.col("status")).alias("can_cancel"))


def price_rules(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(12,2)").alias("price"), F.col("p_size").alias("size"))
    pct = F.col("p_partkey") % 21 - 10
    tier = F.element_at(F.array(*map(F.lit, rules.TIERS)), (F.col("p_partkey") % 3 + 1).cast("int"))
    return p.select(
        "p_partkey",
        rules.changed_price(F.col("price"), pct).alias("changed_price"),
        rules.changed_credit_limit(F.col("price") * 100, pct).alias("changed_limit"),
        rules.case_price(F.col("price"), F.lit(12)).alias("case_price"),
        rules.case_quantity(F.col("size"), F.lit(6)).alias("cases"),
        rules.allocate(F.col("size"), F.col("p_partkey") % 40 - 5).cast("long").alias("allocated"),
        rules.tier_step(tier, F.col("p_partkey") % 2 == 0).alias("tier"),
    )


def _shown(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with decimals as doubles, timestamps as milliseconds and dates as text, which any client can compare."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = query(spark, sf)
        kinds = {"decimal": lambda c: F.col(c).cast("double"), "timestamp": lambda c: F.unix_millis(c), "date": lambda c: F.col(c).cast("string")}
        return df.select(*[kinds[k.split("(")[0]](c).alias(c) if k.split("(")[0] in kinds else F.col(c) for c, k in df.dtypes])

    run.__name__ = query.__name__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shown(f)
    for f in (
        cdc_parse, typed_values, cdc_quarantine_reasons, bronze_counts_by_op, bronze_duplicate_offsets, bronze_batch_counts, bronze_health, latest_per_key, latest_live_only,
        soft_deleted_keys, merge_two_batches, scd2_history, scd2_incremental_two_batches, scd2_noops, scd2_violations, scd2_summary, pit_join_sales, fct_sales,
        daily_sales_region_brand, dim_date, price_history, tier_movements, order_value, reconcile_missing_extra_differs, semi_join_batch_keys, topn_oldest_open, distinct_keys,
        union_chain, key_sets, popularity_smoothed, several_per_region, order_state_rules, price_rules,
    )
}

_LOG = """log AS (
  SELECT user_id, event_type, floor(value / 100)::BIGINT AS hundreds,
    CASE event_type WHEN 'signup' THEN 'r' WHEN 'purchase' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
    event_id + 1 AS source_lsn, epoch_us(ts) // 1000 AS source_ts_ms, event_type = 'error' AS is_deleted, event_id AS kafka_offset FROM events)"""
_REASON = """CASE WHEN kafka_offset % 50 = 0 THEN 'null value (tombstone)' WHEN kafka_offset % 50 = 1 THEN 'invalid json'
  WHEN kafka_offset % 50 = 2 THEN 'invalid table name' WHEN kafka_offset % 50 = 3 THEN 'missing or unknown __op'
  WHEN kafka_offset % 50 IN (4, 5) THEN 'missing __source_lsn' WHEN kafka_offset % 50 = 6 THEN 'missing __source_ts_ms' END"""
_PARSED = f"""{_LOG}, parsed AS (
  SELECT *, {_REASON} AS reason, CASE WHEN kafka_offset % 50 = 2 THEN 'Bad-Name' ELSE 'users' END AS tab,
    CASE WHEN kafka_offset % 50 = 9 THEN kafka_offset - 1 ELSE kafka_offset END AS pos FROM log)"""


def _latest(log: str) -> str:
    return f"""SELECT user_id,
    coalesce(arg_max(event_type, source_lsn) FILTER (NOT is_deleted), arg_max(event_type, source_lsn)) AS event_type,
    coalesce(arg_max(hundreds, source_lsn) FILTER (NOT is_deleted), arg_max(hundreds, source_lsn)) AS hundreds,
    max(source_lsn) AS source_lsn, arg_max(source_ts_ms, source_lsn) AS source_ts_ms, arg_max(is_deleted, source_lsn) AS is_deleted,
    count(*) FILTER (NOT is_deleted) > 0 AS has_values, max(source_lsn) FILTER (NOT is_deleted) AS live_lsn
  FROM {log} GROUP BY user_id"""


_HISTORY = f"""{_LOG}, tracked AS (
  SELECT * REPLACE (CASE WHEN source_lsn % 11 <> 0 THEN hundreds END AS hundreds), event_type || chr(1) || CASE WHEN source_lsn % 11 <> 0 THEN hundreds::VARCHAR ELSE '␀' END AS tracked_text FROM log),
chained AS (
  SELECT *, sha256(tracked_text) AS row_hash,
    lag(is_deleted) OVER w AS gone, lag(CASE WHEN NOT is_deleted THEN tracked_text END) OVER w AS before, row_number() OVER w = 1 AS first
  FROM tracked WINDOW w AS (PARTITION BY user_id ORDER BY source_lsn)),
bounds AS (SELECT * FROM chained WHERE (NOT is_deleted AND (before IS NULL OR before <> tracked_text)) OR (is_deleted AND (first OR NOT gone))),
spans AS (SELECT *, lead(epoch_ms(source_ts_ms)) OVER w AS next, lead(is_deleted) OVER w AS next_gone FROM bounds WINDOW w AS (PARTITION BY user_id ORDER BY source_lsn)),
versions AS (
  SELECT user_id, event_type, hundreds, row_hash, CASE WHEN first AND op = 'r' THEN TIMESTAMP '1900-01-01' ELSE epoch_ms(source_ts_ms) END AS valid_from,
    coalesce(next, TIMESTAMP '9999-12-31') AS valid_to, next IS NULL AS is_current, coalesce(next_gone, false) AS is_deleted, source_lsn, source_ts_ms
  FROM spans WHERE NOT is_deleted)"""
_PARTS = """parts AS (
  SELECT p_partkey, p_retailprice::DECIMAL(12,2) AS price, TIMESTAMP '1900-01-01' AS valid_from, TIMESTAMP '1995-01-01' AS valid_to, 1 AS source_lsn FROM part
  UNION ALL SELECT p_partkey, greatest(round(p_retailprice::DECIMAL(12,2)::DECIMAL(16,4) * 1.05::DECIMAL(3,2), 2), 1.00)::DECIMAL(12,2), TIMESTAMP '1995-01-01', TIMESTAMP '9999-12-31', 2 FROM part)"""
_LINES = """lines AS (
  SELECT l_orderkey, l_partkey, o_custkey, o_orderdate AS order_ts, l_quantity::DECIMAL(12,2) AS quantity,
    round(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(5,2)), 2)::DECIMAL(14,2) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_SALES = f"""{_LINES}, sales AS (
  SELECT l_orderkey, l_partkey, order_ts::DATE AS date, r_name, p_brand, quantity, amount FROM lines
  JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_EARLY = "(SELECT * FROM log WHERE source_lsn % 1000 < 500)"
_LATE = "(SELECT * FROM log WHERE source_lsn % 1000 >= 500)"
_HALF_EVEN = "CASE WHEN {x} - floor({x}) = 0.5 AND floor({x})::BIGINT % 2 = 0 THEN floor({x}) ELSE round({x}) END"

ORACLE_SQL: dict[str, str] = {
    "cdc_parse": f"WITH {_PARSED} SELECT user_id, event_type, hundreds, op, source_lsn, source_ts_ms, is_deleted, pos AS kafka_offset FROM parsed WHERE reason IS NULL",
    "cdc_quarantine_reasons": f'WITH {_PARSED} SELECT tab AS "table", reason AS quarantine_reason, count(*) AS n FROM parsed WHERE reason IS NOT NULL GROUP BY ALL',
    "bronze_counts_by_op": f'WITH {_PARSED} SELECT tab AS "table", op, count(*) AS n FROM parsed WHERE reason IS NULL GROUP BY ALL',
    "bronze_duplicate_offsets": f"WITH {_PARSED} SELECT 'fmcg.public.users' AS kafka_topic, 0 AS kafka_partition, pos AS kafka_offset, count(*) AS n FROM parsed WHERE reason IS NULL GROUP BY ALL HAVING count(*) > 1",
    "bronze_batch_counts": f'WITH {_PARSED} SELECT tab AS "table", reason IS NOT NULL AS is_bad, count(*) AS n FROM parsed GROUP BY ALL',
    "bronze_health": f"WITH {_PARSED} SELECT count(*) AS rows, " + ", ".join(f"count(*) FILTER (op = '{o}') AS op_{o}" for o in "cudr") + ", count(*) FILTER (is_deleted) AS deletes FROM parsed WHERE reason IS NULL",
    "latest_per_key": f"WITH {_LOG} {_latest('log')}",
    "latest_live_only": f"WITH {_LOG}, l AS ({_latest('log')}) SELECT user_id, event_type, hundreds FROM l WHERE NOT is_deleted",
    "soft_deleted_keys": f"WITH {_LOG}, l AS ({_latest('log')}) SELECT user_id, source_lsn FROM l WHERE is_deleted",
    "merge_two_batches": f"""WITH {_LOG}, a AS ({_latest(_EARLY)}), b AS ({_latest(_LATE)})
SELECT coalesce(a.user_id, b.user_id) AS user_id,
  CASE WHEN a.user_id IS NULL OR b.live_lsn > a.source_lsn THEN b.event_type ELSE a.event_type END AS event_type,
  CASE WHEN a.user_id IS NULL OR b.live_lsn > a.source_lsn THEN b.hundreds ELSE a.hundreds END AS hundreds,
  CASE WHEN a.user_id IS NULL OR b.source_lsn > a.source_lsn THEN b.source_lsn ELSE a.source_lsn END AS source_lsn,
  CASE WHEN a.user_id IS NULL OR b.source_lsn > a.source_lsn THEN b.source_ts_ms ELSE a.source_ts_ms END AS source_ts_ms,
  CASE WHEN a.user_id IS NULL OR b.source_lsn > a.source_lsn THEN b.is_deleted ELSE a.is_deleted END AS is_deleted
FROM a FULL JOIN b ON a.user_id = b.user_id""",
    "scd2_history": f"WITH {_HISTORY} SELECT * FROM versions",
    "scd2_incremental_two_batches": f"WITH {_HISTORY} SELECT * FROM versions",
    "scd2_noops": f"WITH {_HISTORY} SELECT user_id, source_lsn, event_type FROM tracked WHERE NOT is_deleted AND (user_id, source_lsn) NOT IN (SELECT user_id, source_lsn FROM versions)",
    "scd2_violations": """WITH k AS (SELECT c_custkey AS user_id, c_custkey % 12 AS kind, TIMESTAMP '2020-09-13 12:26:40' AS t FROM customer),
v AS (
  SELECT user_id, 1::BIGINT AS source_lsn, CASE WHEN kind = 2 THEN t + INTERVAL 20 DAY ELSE t END AS valid_from, CASE WHEN kind = 2 THEN t + INTERVAL 5 DAY ELSE t + INTERVAL 10 DAY END AS valid_to,
    kind IN (1, 6) AS is_current, kind IN (5, 8) AS is_deleted FROM k
  UNION ALL
  SELECT user_id, 2, CASE kind WHEN 3 THEN t + INTERVAL 12 DAY WHEN 4 THEN t + INTERVAL 8 DAY WHEN 5 THEN t + INTERVAL 8 DAY WHEN 8 THEN t + INTERVAL 15 DAY ELSE t + INTERVAL 10 DAY END,
    CASE WHEN kind = 7 THEN t + INTERVAL 30 DAY ELSE TIMESTAMP '9999-12-31' END, kind NOT IN (6, 7, 9), kind = 9 FROM k),
w AS (SELECT *, lead(valid_from) OVER o AS next, count(*) FILTER (is_current) OVER (PARTITION BY user_id) AS currents FROM v WINDOW o AS (PARTITION BY user_id ORDER BY valid_from, source_lsn)),
f AS (SELECT user_id, source_lsn, CASE WHEN currents > 1 THEN 'several current versions' WHEN valid_from > valid_to THEN 'ends before it begins'
    WHEN next IS NOT NULL AND ((NOT is_deleted AND valid_to <> next) OR (is_deleted AND valid_to > next)) THEN 'gap or overlap'
    WHEN next IS NOT NULL AND is_current THEN 'current with a successor'
    WHEN next IS NULL AND NOT (is_current AND valid_to = TIMESTAMP '9999-12-31') AND NOT (NOT is_current AND is_deleted) THEN 'last neither open nor deleted' END AS violation FROM w)
SELECT * FROM f WHERE violation IS NOT NULL""",
    "scd2_summary": f"""WITH {_HISTORY}, k AS (SELECT user_id, count(*) AS n, count(*) FILTER (is_current) AS c, count(*) FILTER (is_deleted) AS d FROM versions GROUP BY 1)
SELECT count(*) AS keys, sum(n)::BIGINT AS versions, sum(c)::BIGINT AS current, sum(d)::BIGINT AS deleted, max(n) AS most_versions FROM k""",
    "pit_join_sales": f"""WITH {_LINES}, {_PARTS} SELECT l_partkey, source_lsn AS version, price AS price_then, count(*) AS lines, sum(quantity) AS quantity
FROM lines LEFT JOIN parts ON l_partkey = p_partkey AND order_ts >= valid_from AND order_ts < valid_to GROUP BY ALL""",
    "fct_sales": """WITH l AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <> 7 AND o_orderkey % 5 <> 0),
s AS (SELECT c_custkey, c_nationkey, c_custkey * 2 AS store_sk, 'bronze' AS tier, TIMESTAMP '1993-01-01' AS a, TIMESTAMP '1995-01-01' AS b FROM customer
  UNION ALL SELECT c_custkey, c_nationkey, c_custkey * 2 + 1, 'silver', TIMESTAMP '1995-01-01', TIMESTAMP '9999-12-31' FROM customer)
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, o_orderdate::DATE AS date, store_sk, p_partkey * 2 + CASE WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN 1 ELSE 2 END AS product_sk,
  o_custkey % 10 AS rep_id, c_nationkey AS region_id, tier, p_brand AS brand, 'kind ' || CASE WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN 1 ELSE 2 END AS category, o_orderstatus AS status, 2 AS quantity,
  round(2 * l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(5,2)), 2)::DECIMAL(14,2) AS amount
FROM l LEFT JOIN s ON o_custkey = c_custkey AND o_orderdate >= a AND o_orderdate < b LEFT JOIN part ON l_partkey = p_partkey""",
    "tier_movements": """WITH c AS (SELECT c_custkey, c_custkey % 3 AS tier, c_custkey % 2 = 0 AS up FROM customer)
SELECT CASE tier WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS previous_tier, CASE WHEN tier <> 1 THEN 'silver' WHEN up THEN 'gold' ELSE 'bronze' END AS tier, count(*) AS n FROM c GROUP BY ALL""",
    "typed_values": """SELECT l_orderkey * 10 + l_linenumber AS line, CASE WHEN l_linenumber <> 1 THEN l_partkey::INTEGER END AS part, CASE WHEN l_linenumber <> 2 THEN l_extendedprice::DECIMAL(12,2) END AS price,
  CASE WHEN l_linenumber <> 3 THEN l_shipdate::DATE + INTERVAL 36000250 MILLISECOND END AS seen_at, l_linenumber > 2 AND l_linenumber <> 4 AS is_open, CASE WHEN l_linenumber <> 5 THEN 'ß' END AS note FROM lineitem""",
    "daily_sales_region_brand": f"WITH {_SALES} SELECT date, r_name AS region_id, p_brand AS brand, count(*) AS lines, sum(quantity) AS quantity, sum(amount) AS amount FROM sales GROUP BY ALL",
    "dim_date": """SELECT d::DATE AS date, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month, day(d)::INTEGER AS day, isodow(d)::INTEGER AS iso_weekday, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP, max(o_orderdate)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM orders)""",
    "price_history": f"WITH {_PARTS} SELECT p_partkey, valid_from, valid_to, price, lag(price) OVER (PARTITION BY p_partkey ORDER BY valid_from, source_lsn) AS previous_price FROM parts",
    "order_value": f"WITH {_LINES} SELECT l_orderkey, sum(amount)::DECIMAL(18,2) AS order_value FROM lines GROUP BY 1",
    "reconcile_missing_extra_differs": f"""WITH {_LOG}, a AS (SELECT * FROM ({_latest(_EARLY)}) WHERE NOT is_deleted), b AS (SELECT * FROM ({_latest(_LATE)}) WHERE NOT is_deleted)
SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN 'missing' WHEN a.user_id IS NULL THEN 'extra' ELSE 'differs' END AS status
FROM a FULL JOIN b ON a.user_id = b.user_id WHERE a.user_id IS NULL OR b.user_id IS NULL OR (a.event_type, a.hundreds) IS DISTINCT FROM (b.event_type, b.hundreds)""",
    "semi_join_batch_keys": f"WITH {_LOG}, l AS ({_latest('log')}) SELECT user_id, event_type, hundreds FROM l WHERE NOT is_deleted AND user_id IN (SELECT user_id FROM log WHERE op = 'r')",
    "topn_oldest_open": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate, o_orderkey LIMIT 50",
    "distinct_keys": "SELECT DISTINCT user_id FROM events",
    "union_chain": f"WITH {_LOG} SELECT user_id, source_lsn, CASE op WHEN 'r' THEN 'snapshot' WHEN 'd' THEN 'delete' ELSE 'change' END AS kind FROM log",
    "key_sets": f"""WITH {_LOG}, a AS (SELECT DISTINCT user_id FROM {_EARLY} WHERE op = 'r'), b AS (SELECT DISTINCT user_id FROM {_LATE} WHERE op = 'r')
SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN b.user_id IS NULL THEN 'early' WHEN a.user_id IS NULL THEN 'late' ELSE 'both' END AS side FROM a FULL JOIN b ON a.user_id = b.user_id""",
    "popularity_smoothed": "SELECT p_partkey, count(l_partkey) + 1 AS weight FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1",
    "several_per_region": "SELECT s_suppkey, s_nationkey, peers FROM (SELECT *, count(*) OVER (PARTITION BY s_nationkey) AS peers FROM supplier) WHERE peers > 1",
    "order_state_rules": """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'placed' WHEN o_orderstatus = 'P' THEN 'confirmed' WHEN o_orderkey % 3 = 0 THEN 'shipped' ELSE 'delivered' END AS status FROM orders)
SELECT o_orderkey, status, CASE status WHEN 'placed' THEN 'confirmed' WHEN 'confirmed' THEN 'shipped' WHEN 'shipped' THEN 'delivered' END AS next_status, status IN ('placed', 'confirmed') AS can_cancel FROM o""",
    "price_rules": f"""WITH p AS (
  SELECT p_partkey, p_retailprice::DECIMAL(12,2) AS price, p_size, p_partkey % 21 - 10 AS pct, p_partkey % 3 AS tier, p_partkey % 2 = 0 AS up FROM part),
q AS (SELECT *, price::DECIMAL(18,4) * (100 + pct)::DECIMAL(4,0) AS grown, (price::DECIMAL(18,4) * (100 + pct)::DECIMAL(4,0) / 1000)::DECIMAL(18,6) AS thousands, (price * 12 * 0.95::DECIMAL(3,2))::DECIMAL(18,4) AS boxed FROM p)
SELECT p_partkey, greatest(round((grown / 100)::DECIMAL(18,4), 2), 1)::DECIMAL(12,2) AS changed_price,
  greatest(({_HALF_EVEN.format(x="thousands")}) * 1000, 1000)::DECIMAL(12,2) AS changed_limit,
  ({_HALF_EVEN.format(x="boxed")})::DECIMAL(12,2) AS case_price,
  greatest(1, p_size // 6)::INTEGER AS cases, greatest(0, least(p_size, p_partkey % 40 - 5))::BIGINT AS allocated,
  CASE WHEN tier = 0 THEN 'silver' WHEN tier = 2 THEN 'silver' WHEN up THEN 'gold' ELSE 'bronze' END AS tier FROM q""",
}


def _replaced(name: str, columns: str, kind: str) -> None:
    """Gives a statement's columns the form that ``_shown`` gives them."""
    form = {"decimal": "{c}::DOUBLE", "timestamp": "(epoch_us({c}) // 1000)", "date": "{c}::VARCHAR"}[kind]
    ORACLE_SQL[name] = f"SELECT * REPLACE ({', '.join(f'{form.format(c=c)} AS {c}' for c in columns.split())}) FROM ({ORACLE_SQL[name]})"


for _name, _columns, _kind in (
    ("scd2_history", "valid_from valid_to", "timestamp"),
    ("scd2_incremental_two_batches", "valid_from valid_to", "timestamp"),
    ("price_history", "valid_from valid_to", "timestamp"),
    ("price_history", "price previous_price", "decimal"),
    ("pit_join_sales", "price_then quantity", "decimal"),
    ("fct_sales", "amount", "decimal"),
    ("typed_values", "price", "decimal"),
    ("typed_values", "seen_at", "timestamp"),
    ("daily_sales_region_brand", "quantity amount", "decimal"),
    ("order_value", "order_value", "decimal"),
    ("fct_sales", "date", "date"),
    ("daily_sales_region_brand", "date", "date"),
    ("dim_date", "date", "date"),
    ("price_rules", "changed_price changed_limit case_price", "decimal"),
):
    _replaced(_name, _columns, _kind)
