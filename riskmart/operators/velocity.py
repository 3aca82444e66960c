"""How often and for how much a key was active in the minutes before each of its events.

A frame that slides over a key's events would be worked out anew for each event, and all
events of a key would meet in one task. Here time is cut into buckets as wide as the longest
window. A bucket also gets the events before it that its windows reach back to, so a key
that holds a third of all events is spread over as many tasks as it has buckets. Inside, one
running sum over the events and over marks at the start of each window gives every window as
the difference of two sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MINUTE = 60_000_000


def velocity(
    events: DataFrame, event: str, key: str, at: str, amount: str,
    minutes: Sequence[int] = (1, 5, 30), splits: int = 1,
) -> DataFrame:
    """Per event: ``count_<m>m`` and ``amount_<m>m`` of its key in the ``m`` minutes up to it.

    Both ends of a window count, as do all events of the same moment. ``event`` names an event;
    events without a key or a time have no window and no row here. ``amount`` is a decimal, so
    sums are exact; NULL adds nothing. Where a key is very busy, ``splits`` makes buckets that
    many times narrower, for as many more copies of each event.
    """
    longest = max(minutes) * MINUTE
    width = -(-longest // splits)
    time = F.unix_micros(at)
    facts = events.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(event).alias("event"), F.col(key).alias("key"), time.alias("time"), F.col(amount).alias("amount"),
        F.floor(time / width).alias("bucket"),
    )
    none = F.lit(0).cast(events.schema[amount].dataType)

    def entry(bucket, moment, n, worth, mark):
        return F.struct(
            bucket.alias("bucket"), moment.alias("time"), F.lit(n).cast("long").alias("n"), worth.alias("amount"),
            F.lit(mark).cast("int").alias("mark"),
        )

    bucket, moment = F.col("bucket"), F.col("time")
    entries = [entry(bucket, moment, 1, F.col("amount"), 0)]
    entries += [entry(bucket + k, moment, 1, F.col("amount"), None) for k in range(1, splits + 1)]
    # Just before the window begins, so that the difference holds its first moment.
    entries += [entry(bucket, moment - m * MINUTE - 1, 0, none, m) for m in minutes]
    line = facts.select("event", "key", F.inline(F.array(*entries)))
    so_far = Window.partitionBy("key", "bucket").orderBy("time").rangeBetween(Window.unboundedPreceding, 0)
    summed = line.select(
        "event", "mark", F.sum("n").over(so_far).alias("n"),
        F.coalesce(F.sum("amount").over(so_far), none).alias("amount"),
    ).where(F.col("mark").isNotNull())
    at_mark = lambda column, mark: F.max(F.when(F.col("mark") == mark, F.col(column)))
    found = summed.groupBy("event").agg(
        *(at_mark(c, mark).alias(f"{c}_{mark}") for c in ("n", "amount") for mark in (0, *minutes))
    )
    return found.select(
        F.col("event").alias(event),
        *((F.col("n_0") - F.col(f"n_{m}")).alias(f"count_{m}m") for m in minutes),
        *((F.col("amount_0") - F.col(f"amount_{m}")).alias(f"amount_{m}m") for m in minutes),
    )
