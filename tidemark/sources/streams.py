"""Streaming and batch sources of the change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RECORD_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
BRONZE_SCHEMA = "kafka_key string, payload string, op string, source_ts_ms bigint, source_lsn bigint, is_deleted boolean, kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, ingested_at timestamp, ingest_date date"

#: Defaults of the broker source.
KAFKA_OPTIONS = {"subscribePattern": r"fmcg\.public\..*", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "50000", "failOnDataLoss": "true", "kafka.metadata.max.age.ms": "30000"}


def kafka_stream(spark: SparkSession, servers: str, **options: str) -> DataFrame:
    """Records of a broker; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).options(**KAFKA_OPTIONS | options).load().select("key", "value", "topic", "partition", "offset", "timestamp")


def record_stream(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """The same six columns from Parquet files that land in a folder."""
    return spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(folder)


def bronze_stream(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """A change-log table as a stream."""
    return spark.readStream.schema(f"{BRONZE_SCHEMA}, batch_id bigint").option("maxFilesPerTrigger", max_files).parquet(folder)


def jdbc_table(spark: SparkSession, url: str, table: str, key: str | None = None, parts: int = 1, **options: str) -> DataFrame:
    """A table of the source database; with a numeric ``key`` and its bounds in options, in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if key and parts > 1:
        reader = reader.option("partitionColumn", key).option("numPartitions", parts)
    return reader.options(**options).load()
