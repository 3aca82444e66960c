"""Spark session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE split a hot join partition even when the next operator then
    # needs one more exchange; a straggler costs more than that exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a task reads after a shuffle; hash tables over it take some twenty times as much.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # The JVM leaves longer methods uncompiled and interprets them row by row; beyond this
    # size Spark works with its smaller, compiled projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


#: For runs whose disk must not grow with their past: shuffle files go when a query or a
#: micro-batch ends instead of some time after the driver collects its garbage.
TIDY_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def scoped_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for what starts within; the caller's session gets its own back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session for the jobs; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """The semantics here need UTC; the rest only guards against skew."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more, wherever it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="riskmart-")
    return f"{base.rstrip('/')}/riskmart-{purpose}-{uuid.uuid4().hex}"
