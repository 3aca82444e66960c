"""The first n rows of an order, for any n, without sorting them in one place.

The n-th row is found by histograms that narrow: the values are counted in a bounded number
of equal steps, the step that holds the n-th row is counted in finer steps, and so on. Rows
that share the last value are told apart by their key, one character at a time in the
order of its bytes. What comes back is a filter, so the rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of a histogram, which is all that reaches the driver per round.
STEPS = 1024


def _step(counts: Sequence[tuple], rest: int) -> tuple[object, int, int]:
    """(step, rows before it, rows in it) of the step that holds the ``rest``-th row."""
    before = 0
    for step, rows in sorted(counts):
        if before + rows >= rest:
            return step, before, rows
        before += rows
    raise ValueError(f"{rest} rows asked of {before}")


def first_n(rows: DataFrame, n: int, by: str, key: str, steps: int = STEPS) -> Column:
    """True for the ``n`` first rows by the timestamp ``by`` (NULL first), then by the text ``key``.

    Rows equal in both come together, so more than ``n`` are true if the last one is among
    them. NULL keys count as empty. The frame is read once per round, only in these two columns:
    three to seven rounds, and a round per character where many rows share the last timestamp.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    value, text = F.unix_micros(by), F.coalesce(key, F.lit(""))
    narrow = rows.select(value.alias("value"), text.alias("key"))
    total, nulls, low, high = narrow.agg(
        F.count("*"), F.count_if(F.col("value").isNull()), F.min("value"), F.max("value")
    ).first()
    if n >= total:
        return F.lit(True)
    if n == 0:
        return F.lit(False)
    if n <= nulls:
        return value.isNull() & _keys(narrow.filter("value IS NULL"), text, n, nulls)

    rest, inside = n - nulls, total - nulls
    while low < high and inside > rest:
        width = (high - low) // steps + 1
        within = narrow.filter(F.col("value").between(low, high))
        step = F.floor((F.col("value") - low) / width)
        counts = within.groupBy(step.cast("long").alias("step")).count().collect()
        at, before, inside = _step([tuple(r) for r in counts], rest)
        low, rest = low + at * width, rest - before
        high = min(high, low + width - 1)
    earlier = value.isNull() | (value < low)
    if inside == rest:
        return earlier | (value <= high)
    return earlier | ((value == low) & _keys(narrow.filter(F.col("value") == low), text, rest, inside))


def _keys(ties: DataFrame, text: Column, rest: int, inside: int) -> Column:
    """True for the keys of the ``rest`` first of the ``inside`` ties."""
    prefix = ""
    while inside > rest:
        character = F.substring("key", len(prefix) + 1, 1)
        counts = ties.filter(F.col("key").startswith(prefix)).groupBy(character.alias("c")).count().collect()
        # The order of characters is that of their bytes in UTF-8.
        at, before, inside = _step([(r[0].encode(), r[1]) for r in counts], rest)
        rest -= before
        if not at:
            return text <= prefix
        prefix += at.decode()
    return F.substring(text, 1, len(prefix)) <= prefix
