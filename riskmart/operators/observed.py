"""Numbers taken from tables on their way to storage, so that no table is read for them again."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Observed:
    """Collects the measures of frames that are written once each.

    A frame is to be written before its numbers are asked for. They come from the tasks
    of that write; a task that is run again counts once.
    """

    def __init__(self) -> None:
        self._watched: list[tuple[Observation, list[str]]] = []

    def watch(self, frame: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
        """The same rows; ``aggregates`` are whole-table aggregates by the name of their measure."""
        observation, names = Observation(f"measures-{uuid4().hex}"), list(aggregates)
        # Metric names are identifiers, measures may have dots in theirs.
        columns = [aggregates[name].cast("bigint").alias(f"m{k}") for k, name in enumerate(names)]
        self._watched.append((observation, names))
        return frame.observe(observation, *columns)

    def values(self) -> dict[str, int | None]:
        found: dict[str, int | None] = {}
        for observation, names in self._watched:
            row = observation.get
            found.update((name, row.get(f"m{k}")) for k, name in enumerate(names))
        return found


def measure_rows(spark: SparkSession, values: Mapping[str, int | None]) -> DataFrame:
    """(measure, value) rows of numbers that are known."""
    pairs = (
        F.struct(F.lit(name).alias("measure"), F.lit(value).cast("bigint").alias("value"))
        for name, value in values.items()
    )
    return spark.range(1).select(F.inline(F.array(*pairs)))
