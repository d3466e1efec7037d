"""Databases and tables of the session's catalog, beside the tables that are known by their path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.keyed_table import KeyedTable


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, name: str, columns_ddl: str, partitioned_by: tuple[str, ...] = (), properties: dict[str, str] | None = None) -> None:
    """Creates a Parquet table with its partitioning and properties unless it is there."""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING parquet{parts}" + (f" TBLPROPERTIES ({listed})" if listed else ""))


def overwrite(rows: DataFrame, name: str) -> None:
    rows.write.mode("overwrite").format("parquet").saveAsTable(name)


def append(rows: DataFrame, name: str) -> None:
    """Appends rows by the names of the table's columns."""
    rows.select(*rows.sparkSession.table(name).columns).write.insertInto(name)


def publish(table: KeyedTable, name: str) -> None:
    """Makes the last version of a keyed table readable by name in this session."""
    table.read().createOrReplaceTempView(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def tables_of(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def properties_of(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
