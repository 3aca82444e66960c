"""The gates of this pipeline: before publishing gold, and over everything published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.contracts import ENTITIES, GOLD_GRAIN
from riskmart.operators.gates import (
    Gate, count_measure, evaluate, key_measures, measures, total_measure,
)
from riskmart.operators.observed import measure_rows


def unmatched_chargebacks(chargebacks: DataFrame, payments: DataFrame) -> DataFrame:
    return chargebacks.join(payments.select("transaction_id"), "transaction_id", "left_anti")


def undecided_payments(payments: DataFrame, decisions: DataFrame) -> DataFrame:
    return payments.join(decisions.select("transaction_id"), "transaction_id", "left_anti")


PRE_PUBLISH = (
    Gate("one_decision_per_transaction", 0, "decided.duplicates"),
    Gate("one_chargeback_per_transaction", 0, "disputed.duplicates"),
    Gate("chargebacks_have_payments", 0, "unmatched_chargebacks"),
    Gate("payments_have_decisions", 0, "undecided_payments"),
)


def pre_publish_gates(payments: DataFrame, decisions: DataFrame, chargebacks: DataFrame) -> DataFrame:
    """What must hold before gold may be built from these tables."""
    return evaluate(
        [
            key_measures(decisions, "decided", ["transaction_id"]),
            key_measures(chargebacks, "disputed", ["transaction_id"]),
            count_measure(unmatched_chargebacks(chargebacks, payments), "unmatched_chargebacks"),
            count_measure(undecided_payments(payments, decisions), "undecided_payments"),
        ],
        PRE_PUBLISH,
    )


PUBLISHED = (
    Gate("decision_ids_unique", 0, "decisions.duplicates"),
    *(Gate(f"silver_{e.name}_keys_unique", 0, f"{e.name}.duplicates") for e in ENTITIES),
    *(Gate(f"gold_{name}_grain_unique", 0, f"gold.{name}.duplicates") for name in GOLD_GRAIN),
    Gate(
        "one_refresh_stamp", None,
        tuple(f"gold.{name}.{end}_refresh" for name in GOLD_GRAIN for end in ("first", "last")),
        empty_passes=True,
    ),
    Gate("decisions_equal_logged_payments", "logged_payments.keys", "decisions.rows"),
    Gate("decisions_equal_payments", "payments.rows", "decisions.rows"),
    Gate("business_total_equals_payments", "payments.rows", "business_payments"),
    Gate("fraud_total_equals_decisions", "decisions.rows", "fraud_decisions"),
    Gate("confirmed_fraud_equals_chargebacks", "chargebacks.rows", "confirmed_fraud"),
    Gate("seller_total_equals_payments", "payments.rows", "seller_payments"),
    Gate("customer_total_equals_payments", "payments.rows", "customer_payments"),
    Gate("one_profile_per_customer", "customers.rows", "gold.customer_360.rows"),
    Gate("one_row_per_active_seller", "active_sellers.keys", "gold.seller_performance.rows"),
)


def logged_payment_keys(new_payments: DataFrame) -> DataFrame:
    """Distinct payments the log announced; later changes of a payment add no decision."""
    return new_payments.select("transaction_id")


# Gold table -> measure -> column whose total it is.
GOLD_TOTALS = {
    "daily_business_kpis": {"business_payments": "payment_count"},
    "daily_fraud_kpis": {"fraud_decisions": "total_decisions", "confirmed_fraud": "confirmed_fraud_count"},
    "seller_performance": {"seller_payments": "transaction_count"},
    "customer_360": {"customer_payments": "payment_count"},
}


def gold_aggregates(name: str) -> dict[str, Column]:
    """All measures of a gold table but those of its keys, for one look at its rows."""
    stamp = F.unix_micros("refreshed_at")
    return {
        f"gold.{name}.first_refresh": F.min(stamp),
        f"gold.{name}.last_refresh": F.max(stamp),
        **{m: F.coalesce(F.sum(column), F.lit(0)) for m, column in GOLD_TOTALS[name].items()},
    }


def published_gates(
    new_payments: DataFrame,
    decisions: DataFrame,
    silver: dict[str, DataFrame],
    gold: dict[str, DataFrame],
    observed: dict[str, int | None] | None = None,
) -> DataFrame:
    """Uniqueness and reconciliation over the log, silver, decisions and gold.

    ``gold`` are stored tables. With the measures ``observed`` while they were written,
    only their key columns are read, else their totals too, in one more pass.
    """
    if observed is None:
        totals = [measures(gold[name], **gold_aggregates(name)) for name in GOLD_GRAIN]
    else:
        totals = [measure_rows(decisions.sparkSession, observed)]
    parts = [
        key_measures(decisions, "decisions", ["decision_id"]),
        key_measures(logged_payment_keys(new_payments), "logged_payments", ["transaction_id"]),
        key_measures(silver["payments"], "active_sellers", ["seller_id"]),
        *(key_measures(silver[e.name], e.name, [e.key]) for e in ENTITIES),
        *(key_measures(gold[name], f"gold.{name}", keys) for name, keys in GOLD_GRAIN.items()),
        *totals,
    ]
    return evaluate(parts, PUBLISHED)


EXTRACT = (
    Gate("extract_payments_reconcile", "source.payments", "extract_payments"),
    Gate("extract_decisions_reconcile", "source.decisions", "extract_decisions"),
    Gate("extract_customers_reconcile", "source.customers", "extract_customers"),
)


def extract_gates(sections: dict[str, DataFrame], source_counts: DataFrame) -> DataFrame:
    """The sections add up to the tables they were made from."""
    source = source_counts.select(
        F.concat(F.lit("source."), "table_name").alias("measure"), F.col("row_count").alias("value")
    )
    return evaluate(
        [
            source,
            total_measure(sections["daily_business_kpis"], "payment_count", "extract_payments"),
            total_measure(sections["daily_fraud_kpis"], "total_decisions", "extract_decisions"),
            total_measure(sections["customer_risk_segments"], "count", "extract_customers"),
        ],
        EXTRACT,
    )


def all_gates(*gate_tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, gate_tables)
