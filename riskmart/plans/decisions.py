"""Payment risk decisions: one narrow stage, no shuffle and no state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.contracts import PAYMENTS
from riskmart.functions.envelope import open_envelope, operation, row_image
from riskmart.functions.identity import hashed_key
from riskmart.functions.values import typed
from riskmart.operators.scoring import (
    ACTIONS, PAYMENT_RULES, RULES_VERSION, SCORE_CAP, graded, points, reasons,
)

SIGNALS = (
    "transaction_id", "customer_id", "amount", "customer_average_amount", "is_new_device",
    "ip_region", "home_region", "shipping_region", "login_failures", "attempt_number",
)


def new_payments(bronze: DataFrame) -> DataFrame:
    """Signals of inserted or snapshotted payments, from the new row image only."""
    payments = bronze.filter(F.col("topic") == PAYMENTS.topic)
    opened = open_envelope(payments, SIGNALS).filter(operation().isin("c", "r"))
    signals = [typed(row_image(n, after_only=True), PAYMENTS.fields[n]).alias(n) for n in SIGNALS]
    return opened.select(*signals, "kafka_timestamp").filter(F.col("transaction_id").isNotNull())


def decide(payments: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Score, action and reasons for each payment row.

    Amounts are compared as decimals, so a payment exactly on a threshold is on it.
    """
    stamp = F.current_timestamp() if as_of is None else as_of
    score = F.least(F.lit(SCORE_CAP), points(PAYMENT_RULES)).cast("int")
    return payments.select(
        hashed_key("transaction_id", F.lit(RULES_VERSION)).alias("decision_id"),
        "transaction_id",
        "customer_id",
        score.alias("risk_score"),
        graded(score, ACTIONS).alias("action"),
        reasons(PAYMENT_RULES).alias("reason_codes"),
        F.lit(RULES_VERSION).alias("rules_version"),
        stamp.alias("decision_time"),
        "kafka_timestamp",
    )


def reason_counts(decisions: DataFrame) -> DataFrame:
    return (
        decisions.select(F.explode("reason_codes").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def group_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
