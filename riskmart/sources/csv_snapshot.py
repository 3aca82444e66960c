"""Strict reading of the marketplace CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.contracts import csv_schema

# Free text with line breaks and doubled quotes. Such a file cannot be split between
# tasks, so the plain files are not read this way.
FREE_TEXT_TABLES = ("order_reviews",)


def read_csv(spark: SparkSession, table: str, path: str, as_of: Column | None = None) -> DataFrame:
    """All columns as text, with the file each row came from and the load time.

    Any malformed row stops the read, and so does a header that does not match the
    expected columns. A leading byte-order mark is skipped.
    """
    reader = (
        spark.read.schema(csv_schema(table))
        .option("header", "true")
        .option("mode", "FAILFAST")
        .option("enforceSchema", "false")
    )
    if table in FREE_TEXT_TABLES:
        reader = reader.option("multiLine", "true").option("escape", '"')
    return reader.csv(path).withColumns(
        {
            "_source_file": F.col("_metadata.file_path"),
            "_ingested_at": F.current_timestamp() if as_of is None else as_of,
        }
    )


def write_csv(frame: DataFrame, table: str, path: str) -> None:
    """Files of the shape ``read_csv`` expects."""
    columns = csv_schema(table).names
    frame.select(*columns).write.option("header", "true").option("escape", '"').csv(path)
