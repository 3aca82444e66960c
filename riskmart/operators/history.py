"""Validity intervals from versions, whatever the order in which they came."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of the log whose versions of one key are put in order together.
SLICE = 1 << 16


def validity_intervals(versions: DataFrame, key: str, number: str, deleted: Column, width: int = SLICE) -> DataFrame:
    """The versions with ``valid_from``, ``valid_to`` (exclusive, NULL for the last) and ``is_current``.

    ``versions`` has one row per key and ``number``, the place in the source's log; NULL is
    before all others. A version ends where the next one of its key begins. Deletes end a
    version and are left out themselves, so between a delete and the next version there
    is no row, and no two intervals of a key overlap. The next version is looked for in slices
    of the log and then among the first ones of later slices, so a key with a third of all
    versions is in order without being in one task.
    """
    start = F.coalesce(F.col(number), F.lit(-1)).cast("long")
    rows = versions.withColumns(
        {"valid_from": start, "_slice": F.floor(start / width), "_deleted": F.coalesce(deleted, F.lit(False))}
    )
    firsts = rows.groupBy(key, "_slice").agg(F.min("valid_from").alias("_first"))
    later = Window.partitionBy(key).orderBy("_slice")
    following = firsts.select(F.col(key).alias("_key"), F.col("_slice").alias("_in"), F.lead("_first").over(later).alias("_next"))
    inside = Window.partitionBy(key, "_slice").orderBy("valid_from")
    ended = rows.withColumn("valid_to", F.lead("valid_from").over(inside)).join(
        following, (F.col(key) == F.col("_key")) & (F.col("_slice") == F.col("_in")), "left"
    )
    return (
        ended.withColumn("valid_to", F.coalesce("valid_to", "_next"))
        .withColumn("is_current", F.col("valid_to").isNull())
        .where(~F.col("_deleted"))
        .select(*versions.columns, "valid_from", "valid_to", "is_current")
    )


def state_at(intervals: DataFrame, number: int) -> DataFrame:
    """The rows that were valid at a place of the log."""
    ended = F.col("valid_to").isNotNull() & (F.col("valid_to") <= number)
    return intervals.where((F.col("valid_from") <= number) & ~ended)
