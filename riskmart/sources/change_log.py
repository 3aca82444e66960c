"""Change-log sources, and their projection into the bronze table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.contracts import ENTITIES, schema_of

# Column names and types of a record as the Kafka connector delivers it.
RECORD_DDL = (
    "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary"
)
BRONZE_DDL = (
    "topic string, partition int, offset bigint, kafka_timestamp timestamp, "
    "message_key string, raw_payload string, ingested_at timestamp, ingest_date date"
)
ALL_TOPICS = tuple(entity.topic for entity in ENTITIES)


@dataclass(frozen=True)
class BatchBound:
    """The most that one micro-batch takes from its source.

    A first start, or a start after a long stop, works through its backlog in batches of
    this size, so neither memory nor the work lost by a crash grows with the backlog.
    Files are bounded by their number or, by default, by their bytes.
    """

    files: int | None = None
    bytes: int = 8 << 30
    offsets: int = 10_000_000

    def of_files(self) -> dict[str, int]:
        return {"maxFilesPerTrigger": self.files} if self.files else {"maxBytesPerTrigger": self.bytes}

    def of_log(self) -> dict[str, int]:
        return {"maxOffsetsPerTrigger": self.offsets}


def log_from_files(
    spark: SparkSession, folder: str, topics: Sequence[str] = ALL_TOPICS, bound: BatchBound = BatchBound()
) -> DataFrame:
    """Stream of record files, from the first one on."""
    records = spark.readStream.schema(schema_of(RECORD_DDL)).options(**bound.of_files()).parquet(folder)
    return records.filter(F.col("topic").isin(*topics))


def log_from_kafka(
    spark: SparkSession, servers: str, topics: Sequence[str] = ALL_TOPICS, bound: BatchBound = BatchBound()
) -> DataFrame:
    """Stream from Kafka; needs the connector package on the cluster."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
        .options(**bound.of_log())
        .load()
    )


def bronze_rows(records: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Records with text payload, arrival stamp and the date they are filed under."""
    return records.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("raw_payload"),
        (F.current_timestamp() if as_of is None else as_of).alias("ingested_at"),
        F.to_date("timestamp").alias("ingest_date"),
    )


def bronze_stream(spark: SparkSession, folder: str, bound: BatchBound = BatchBound()) -> DataFrame:
    """The bronze table read as a stream; the stated schema serves an empty table too."""
    return spark.readStream.schema(schema_of(BRONZE_DDL)).options(**bound.of_files()).parquet(folder)
