"""Helpers that several operators share."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.session import shared_folder

#: ASCII white space; every other character belongs to a word.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the folder all executors share and read from there.

    Cuts the lineage: a lost executor costs no recomputation of what lies before.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def released(frame: DataFrame) -> DataFrame:
    """Lets Spark's cleaner drop the shuffle files of steps that nobody refers to any more.

    The cleaner acts on garbage collections of the driver, which are rare while jobs run.
    References that Python held are handed back by a thread that wakes up once a second.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(1.5)
        frame.sparkSession.sparkContext._jvm.System.gc()
    return frame


def words(text: Column) -> Column:
    """Array of the words of a text; empty for NULL and for blank texts."""
    plain = F.coalesce(text, F.lit(""))
    for blank in BLANKS[1:]:
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def text_key(text: Column) -> Column:
    """Tells rows with the same doc_id and different texts apart."""
    return F.xxhash64(text)
