"""Joining facts to a lookup table when a few keys hold most of the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of the facts on; so there are at most 1 / HOT_SHARE.
HOT_SHARE = 1 / 1000
TRACKED_KEYS = 4096
#: Groups of tasks whose sketches are combined first.
SKETCH_GROUPS = 256


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """Keys that hold ``HOT_SHARE`` of the facts or more, with their number of slots.

    Frequent-items sketches are made per task, combined per group of tasks and then once
    more, so the last task sees ``SKETCH_GROUPS`` sketches whatever the input. A key gets a
    slot for each ``HOT_SHARE`` of the facts that it is estimated to hold.
    """
    tracked = F.lit(TRACKED_KEYS)
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    sketched = (
        facts.select(F.col(key).alias("_key"), group.alias("_group"))
        .groupBy("_group")
        .agg(F.call_function("approx_top_k_accumulate", "_key", tracked).alias("_sketch"), F.count("*").alias("_rows"))
        # Grouped by a constant, as a task without sketches cannot write an empty one.
        .groupBy(F.lit(1))
        .agg(F.call_function("approx_top_k_combine", "_sketch", tracked).alias("_sketch"), F.sum("_rows").alias("_rows"))
    )
    return (
        sketched.select("_rows", F.call_function("approx_top_k_estimate", "_sketch", tracked).alias("_top"))
        .select("_rows", F.inline("_top"))
        .where(F.col("item").isNotNull())
        .where(F.col("count") >= F.col("_rows") * F.lit(HOT_SHARE))
        .select(
            F.col("item").alias(key),
            F.ceil(F.col("count") / (F.col("_rows") * F.lit(HOT_SHARE))).cast("int").alias("_slots"),
        )
    )


def spread_join(
    facts: DataFrame, lookup: DataFrame, key: str, spread_by: Sequence[str], how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join facts to ``lookup`` on ``key``, splitting the heaviest keys over many tasks.

    Hot keys are found by ``hot_keys``, one small aggregate over the key column; where the
    facts are themselves a join, give ``hot`` from the table that the key comes from. The facts
    of these keys get a slot number from a hash of ``spread_by``, and only their lookup
    rows are copied once per slot: 2 / HOT_SHARE copies at most. The sketch decides where
    rows go and never which rows match, so the result is exact. At most 1 / HOT_SHARE rows
    are broadcast, whatever the size of the input. Facts without a key match nothing; they
    are spread as well instead of meeting in one task.
    """
    hot = hot_keys(facts, key) if hot is None else hot
    lone = F.when(F.col(key).isNull(), F.lit(int(1 / HOT_SHARE))).otherwise(F.lit(1))
    slots = F.coalesce("_slots", lone)
    spread_facts = facts.join(F.broadcast(hot), key, "left").withColumn(
        "_slot", F.pmod(F.xxhash64(*spread_by), slots).cast("int")
    ).drop("_slots")
    copied = lookup.join(F.broadcast(hot), key, "left").withColumn(
        "_slot", F.explode(F.sequence(F.lit(0), F.coalesce("_slots", F.lit(1)) - 1))
    ).drop("_slots")
    return spread_facts.join(copied, [key, "_slot"], how).drop("_slot")
