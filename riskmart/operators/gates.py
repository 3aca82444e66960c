"""Quality gates as data: one row per gate with what was expected and what was found.

Every table is reduced once to a few named numbers; the numbers of all tables meet
in one small aggregate, and each gate compares two of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gate:
    """Passes when ``expected`` (a measure or a whole number) equals the measure ``actual``.

    Without an expectation all measures of ``actual`` must be equal; the least and the
    greatest of them are reported. A measure that is missing fails the gate; with
    ``empty_passes`` missing ones do not count.
    """

    name: str
    expected: str | int | None
    actual: str | Sequence[str]
    empty_passes: bool = False


class GateFailure(RuntimeError):
    """Raised by jobs that must not publish."""


def measures(frame: DataFrame, **aggregates: Column) -> DataFrame:
    """Whole-table aggregates as (measure, value) rows."""
    wide = frame.agg(*(a.cast("bigint").alias(name) for name, a in aggregates.items()))
    pairs = (F.struct(F.lit(n).alias("measure"), F.col(f"`{n}`").alias("value")) for n in aggregates)
    return wide.select(F.inline(F.array(*pairs)))


def key_measures(frame: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and keys that occur twice, from one shuffle on the key."""
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return measures(
        per_key,
        **{
            f"{table}.rows": F.coalesce(F.sum("_rows"), F.lit(0)),
            f"{table}.keys": F.count(F.lit(1)),
            f"{table}.duplicates": F.count_if(F.col("_rows") > 1),
        },
    )


def count_measure(frame: DataFrame, name: str) -> DataFrame:
    return measures(frame, **{name: F.count(F.lit(1))})


def total_measure(frame: DataFrame, column: str, name: str) -> DataFrame:
    return measures(frame, **{name: F.coalesce(F.sum(column), F.lit(0))})


def evaluate(all_measures: Sequence[DataFrame], gates: Sequence[Gate]) -> DataFrame:
    """(gate, expected, actual, passed), one row per gate."""
    table = reduce(DataFrame.unionByName, all_measures)
    used: dict[str, None] = {}
    for gate in gates:
        for name in (gate.expected, *_names(gate)):
            if isinstance(name, str):
                used[name] = None
    wide = table.agg(
        *(F.max(F.when(F.col("measure") == name, F.col("value"))).alias(name) for name in used)
    )
    rows = []
    for gate in gates:
        actual = [F.col(f"`{name}`") for name in _names(gate)]
        if gate.expected is None:
            low, high = F.least(*actual), F.greatest(*actual)
        else:
            high = actual[0]
            low = F.col(f"`{gate.expected}`") if isinstance(gate.expected, str) else F.lit(gate.expected)
        low, high = low.cast("bigint"), high.cast("bigint")
        rows.append(
            F.struct(
                F.lit(gate.name).alias("gate"),
                low.alias("expected"),
                high.alias("actual"),
                _passed(gate, low, high, actual).alias("passed"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def _passed(gate: Gate, low: Column, high: Column, actual: list[Column]) -> Column:
    if gate.empty_passes:
        return F.coalesce(low == high, low.isNull() & high.isNull())
    present = reduce(lambda x, y: x & y, [a.isNotNull() for a in actual])
    return F.coalesce(present & (low == high), F.lit(False))


def _names(gate: Gate) -> tuple[str, ...]:
    return (gate.actual,) if isinstance(gate.actual, str) else tuple(gate.actual)


def require(gate_rows: DataFrame) -> None:
    """Stop unless all gates passed. Collects one row per failed gate."""
    failed = gate_rows.filter(~F.col("passed")).collect()
    if failed:
        detail = "; ".join(f"{r.gate}: expected {r.expected}, found {r.actual}" for r in failed)
        raise GateFailure(detail)
