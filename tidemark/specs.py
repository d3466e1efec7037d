"""Declared tables: some keep the current state of a key, others (with a surrogate key) its versions."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Table:
    """``columns``: business columns as DDL, in order; ``tracked``: those whose change opens a version.

    ``source`` is the table's name at its source; ``surrogate`` names the key of a version, if versions are kept.
    """

    name: str
    columns_ddl: str
    keys: tuple[str, ...]
    source: str = ""
    surrogate: str = ""
    tracked: tuple[str, ...] = ()

    @property
    def columns(self) -> list[tuple[str, str]]:
        return [tuple(c.split(" ")) for c in self.columns_ddl.split(", ")]

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def key(self) -> str:
        """The key of a table that has one key column."""
        (key,) = self.keys
        return key

    @property
    def meta_ddl(self) -> str:
        return VERSION_META if self.surrogate else STATE_META


# The metadata columns of both kinds.
STATE_META = "source_lsn BIGINT, source_ts_ms BIGINT, is_deleted BOOLEAN, silver_updated_at TIMESTAMP"
VERSION_META = "row_hash STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, is_current BOOLEAN, is_deleted BOOLEAN, source_lsn BIGINT, source_ts_ms BIGINT, silver_updated_at TIMESTAMP"


def ddl(table: Table) -> str:
    """The whole schema: the surrogate key if there is one, business columns, metadata."""
    return ", ".join([f"{table.surrogate} BIGINT"] * bool(table.surrogate) + [table.columns_ddl, table.meta_ddl])


# The source schema's tables, keys, types and tracked attributes.
FACTS = {
    t.name: t
    for t in (
        Table("orders", "order_id BIGINT, store_id INT, rep_id INT, order_ts TIMESTAMP, status STRING, updated_at TIMESTAMP", ("order_id",)),
        Table("order_items", "order_item_id BIGINT, order_id BIGINT, product_id INT, quantity INT, unit_price DECIMAL(12,2), discount_pct DECIMAL(5,2), updated_at TIMESTAMP", ("order_item_id",)),
        Table("inventory", "product_id INT, warehouse STRING, qty_on_hand INT, updated_at TIMESTAMP", ("product_id", "warehouse")),
        Table("regions", "region_id INT, name STRING, country STRING, updated_at TIMESTAMP", ("region_id",)),
    )
}
DIMENSIONS = {
    t.source: t
    for t in (
        Table("dim_store", "store_id INT, name STRING, channel STRING, region_id INT, tier STRING, credit_limit DECIMAL(12,2), updated_at TIMESTAMP", ("store_id",), "stores", "store_sk", ("name", "channel", "region_id", "tier", "credit_limit")),
        Table("dim_product", "product_id INT, sku STRING, name STRING, brand STRING, category STRING, pack_size STRING, unit_price DECIMAL(12,2), is_active BOOLEAN, updated_at TIMESTAMP", ("product_id",), "products", "product_sk", ("sku", "name", "brand", "category", "pack_size", "unit_price", "is_active")),
        Table("dim_sales_rep", "rep_id INT, name STRING, region_id INT, updated_at TIMESTAMP", ("rep_id",), "sales_reps", "rep_sk", ("name", "region_id")),
    )
}
