"""Typing, normalising and arithmetic on columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.contracts import SPARK_TYPE


def typed(text: Column, kind: str) -> Column:
    """Text to a contract type; NULL where it does not parse."""
    if kind == "instant":
        return F.coalesce(F.timestamp_micros(text.try_cast("bigint")), F.try_to_timestamp(text))
    return text if kind == "string" else text.try_cast(SPARK_TYPE[kind])


def integer(name: str) -> Column:
    return F.col(name).try_cast("int")


def real(name: str) -> Column:
    return F.col(name).try_cast("double")


def instant(name: str) -> Column:
    return F.try_to_timestamp(F.col(name))


def money(value: Column) -> Column:
    return value.try_cast("decimal(18,2)")


def lower_trim(name: str) -> Column:
    return F.lower(F.trim(name))


def upper_trim(name: str) -> Column:
    return F.upper(F.trim(name))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def or_unknown(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("UNKNOWN"))


def percent(part: Column, whole: Column) -> Column:
    return F.round(part * F.lit(100.0) / whole, 2)


def total_where(condition: Column, value: Column) -> Column:
    """Sum over the rows that meet the condition; 0 when none does."""
    return F.sum(F.when(condition, value).otherwise(0))


def mean_half_even(total: Column, count: Column) -> Column:
    """``total / count`` to cents, ties to the even cent, without a rounding in between.

    The quotient is taken in whole millionths so that a tie is recognised exactly.
    """
    micros = (total * 1_000_000).cast("decimal(38,0)")
    step = count.cast("decimal(20,0)") * 10_000
    cents = F.call_function("div", micros, step)
    twice_rest = (micros - cents * step) * 2
    up = (twice_rest > step) | ((twice_rest == step) & (cents % 2 != 0))
    return ((cents + F.when(up, 1).otherwise(0)).cast("decimal(20,0)") / 100).cast("decimal(18,2)")


def fired_codes(tests: Iterable[tuple[str, str]]) -> Column:
    """Array of the codes whose condition (Spark SQL) is true, in the given order.

    Codes are joined as text and split again. Filtering NULLs out of an array takes a
    lambda, and Spark interprets lambdas and everything below them; this form stays in
    generated code. Codes contain no comma.
    """
    text = F.concat_ws(",", *(F.expr(f"CASE WHEN {test} THEN '{code}' END") for code, test in tests))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))
