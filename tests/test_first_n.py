"""The first n of an order, for any n, against sorting."""

import random
from datetime import datetime, timedelta

import pytest

from riskmart.operators.first_n import first_n
from riskmart.plans.replay import order_slice

START = datetime(2017, 1, 1)
SCHEMA = "purchased_at timestamp, order_id string, x int"


def orders(seed, size, spread):
    """Many share a moment; ids of different lengths, one a beginning of another, some odd."""
    chance = random.Random(seed)
    rows = []
    for k in range(size):
        at = None if chance.random() < 0.1 else START + timedelta(microseconds=chance.randrange(spread))
        rows.append((at, f"{chance.choice(['', 'a', 'é', '😀', '￿'])}{k}", k))
    return rows


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or START, (r[1] or "").encode()))


@pytest.mark.parametrize("spread", [1, 7, 10**13])
def test_any_n(spark, spread):
    rows = orders(spread, 60, spread)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).cache()
    for n in (0, 1, 5, 20, 59, 60, 1000):
        kept = frame.filter(first_n(frame, n, "purchased_at", "order_id", steps=4)).collect()
        assert sorted(r.x for r in kept) == sorted(r[2] for r in in_order(rows)[:n])


def test_rows_equal_in_both_come_together(spark):
    rows = [(START, "a", 1), (START, "a", 2), (START, None, 3), (START, "", 4), (START, "ab", 5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = lambda n: sorted(r.x for r in frame.filter(first_n(frame, n, "purchased_at", "order_id")).collect())
    assert [kept(n) for n in (1, 2, 3, 4, 5)] == [[3, 4], [3, 4], [1, 2, 3, 4], [1, 2, 3, 4], [1, 2, 3, 4, 5]]


def test_empty_frame_and_bad_number(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert frame.filter(first_n(frame, 3, "purchased_at", "order_id")).count() == 0
    with pytest.raises(ValueError):
        first_n(frame, -1, "purchased_at", "order_id")
    with pytest.raises(ValueError):
        order_slice(frame, -1)


def test_slice_is_a_filter(spark):
    """No sort, limit or single partition in the plan."""
    frame = spark.createDataFrame(orders(1, 40, 10**9), SCHEMA)
    plan = order_slice(frame, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Limit" not in plan and "Exchange" not in plan
