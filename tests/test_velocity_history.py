"""Velocity windows and validity intervals against plain definitions."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskmart.operators.history import state_at, validity_intervals
from riskmart.operators.velocity import velocity

START = datetime(2024, 1, 1)
EVENTS = "event int, key string, at timestamp, amount decimal(12,2)"


def burst(seed, size):
    """One key has half of the events; many share a moment or lie exactly a window apart."""
    chance, rows = random.Random(seed), []
    for k in range(size):
        at = START + timedelta(minutes=chance.choice([0, 1, 2, 5, 29, 30, 31, 60, 61, 90]), microseconds=chance.choice([0, 0, 1]))
        amount = chance.choice([None, Decimal("0.10"), Decimal("-3.00"), Decimal("12.34")])
        rows.append((k, chance.choice(["hot", "hot", "a", "b"]), chance.choice([at] * 9 + [None]), amount))
    return rows + [(size, None, START, Decimal(1))]


@pytest.mark.parametrize("splits", [1, 3])
def test_windows_follow_the_definition(spark, splits):
    rows = burst(splits, 120)
    found = velocity(spark.createDataFrame(rows, EVENTS).repartition(3), "event", "key", "at", "amount", splits=splits)
    assert found.columns == ["event", "count_1m", "count_5m", "count_30m", "amount_1m", "amount_5m", "amount_30m"]
    want = {}
    for event, key, at, _ in rows:
        if key and at:
            near = [[r for r in rows if r[1] == key and r[2] and at - timedelta(minutes=m) <= r[2] <= at] for m in (1, 5, 30)]
            want[event] = [*map(len, near), *(sum((r[3] or Decimal(0) for r in n), Decimal(0)) for n in near)]
    assert {r[0]: list(r[1:]) for r in found.collect()} == want


def test_velocity_of_nothing(spark):
    assert velocity(spark.createDataFrame([], EVENTS), "event", "key", "at", "amount").count() == 0


VERSIONS = "key string, lsn long, op string"


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_intervals_have_no_gap_and_no_overlap(spark, width):
    chance = random.Random(width)
    rows = [(k, n, chance.choice("ccud")) for k in ("hot", "a", "b") for n in chance.sample(range(60), 40 if k == "hot" else 6)]
    rows += [("a", None, "c"), ("only", 7, "d"), ("null", 3, None)]
    frame = spark.createDataFrame(chance.sample(rows, len(rows)), VERSIONS).repartition(3)
    found = validity_intervals(frame, "key", "lsn", F.col("op") == "d", width)
    assert found.columns == ["key", "lsn", "op", "valid_from", "valid_to", "is_current"]
    kept = found.collect()
    for key in {r[0] for r in rows}:
        own = sorted((r[1] if r[1] is not None else -1, r[2]) for r in rows if r[0] == key)
        want = [(n, own[k + 1][0] if k + 1 < len(own) else None) for k, (n, op) in enumerate(own) if op != "d"]
        assert sorted((r.valid_from, r.valid_to) for r in kept if r.key == key) == want
    for number in (-1, 0, 17, 59, 100):
        newest = {}
        for key, n, op in sorted(rows, key=lambda r: -1 if r[1] is None else r[1]):
            if (n if n is not None else -1) <= number:
                newest[key] = op
        assert {r.key: r.op for r in state_at(found, number).collect()} == {k: op for k, op in newest.items() if op != "d"}
    assert validity_intervals(frame.limit(0), "key", "lsn", F.col("op") == "d").count() == 0
