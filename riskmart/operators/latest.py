"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep, for each key, the row with the greatest ordering tuple (NULLs lowest).

    An aggregate rather than a ranking window: each task reduces its own rows to
    one per key before the shuffle, so a key that holds a third of the input
    sends one row per task.
    """
    keys = list(keys)
    payload = F.struct(*(c for c in rows.columns if c not in keys))
    best = rows.groupBy(*keys).agg(F.max_by(payload, F.struct(*order)).alias("_best"))
    return best.select(*keys, "_best.*").select(*rows.columns)
