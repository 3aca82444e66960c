"""Counts of the sample mapping that were worked out by hand before the plans existed."""

from scales import MEDIUM

from riskmart.registry import QUERIES, with_stored_payments
from riskmart.session import apply_runtime_settings
from riskmart.sources import sample_domain
from riskmart.sources.sample_domain import SampleDomain


def counted(spark, name, key="reason"):
    return {row[key]: row["count"] for row in QUERIES[name](spark, MEDIUM).collect()}


def test_decisions(spark):
    assert counted(spark, "reason_counts") == {
        "AMOUNT_OUTLIER": 5899, "NEW_DEVICE": 2107, "IP_HOME_MISMATCH": 2381,
        "SHIPPING_HOME_MISMATCH": 3970, "REPEATED_LOGIN_FAILURES": 7363, "REPEATED_PAYMENT_ATTEMPTS": 5889,
    }
    assert counted(spark, "action_counts", "action") == {"APPROVE": 4995, "REVIEW": 7111, "DECLINE": 2637}


def test_change_stream(spark):
    quality = QUERIES["cdc_quality_customers"](spark, MEDIUM).cache()
    assert quality.count() == 11500
    assert quality.filter("error_codes <> ''").count() == 446
    rules = {
        code: quality.filter(f"array_contains(split(error_codes, ','), '{code}')").count()
        for code in (
            "MISSING_PRIMARY_KEY", "INVALID_CDC_OPERATION", "MISSING_CUSTOMER_ID",
            "MISSING_AVERAGE_ORDER_AMOUNT", "NEGATIVE_AVERAGE_ORDER_AMOUNT",
        )
    }
    assert list(rules.values()) == [197, 200, 78, 74, 74]
    newest = QUERIES["cdc_latest_per_key"](spark, MEDIUM)
    assert newest.count() == 1500 and newest.filter("_cdc_operation = 'd'").count() == 28
    assert QUERIES["cdc_current_state"](spark, MEDIUM).count() == 1472


def test_market_signals(spark):
    signals = QUERIES["payment_risk_signals"](spark, MEDIUM).cache()
    assert signals.count() == 60000
    fired = {
        code: signals.filter(f"array_contains(split(reason_codes, ','), '{code}')").count()
        for code in ("AMOUNT_OUTLIER", "HIGH_INSTALLMENTS", "SPLIT_PAYMENT", "FAILED_ORDER", "LOW_REVIEW")
    }
    assert list(fired.values()) == [992, 13270, 45257, 19856, 8028]
    bands = {r[0]: r[1] for r in signals.groupBy("risk_band").count().collect()}
    assert bands["HIGH"] == 870 and bands["MEDIUM"] == 23150


def test_log_of_stored_tables_is_the_same_without_joining_payments_again(spark):
    d = SampleDomain(apply_runtime_settings(spark), MEDIUM)
    held = with_stored_payments(d).change_stream()
    assert not [f for f in held.inputFiles() if "lineitem" in f]
    assert held.exceptAll(d.change_stream()).isEmpty() and d.change_stream().exceptAll(held).isEmpty()


def test_parts_of_the_change_log_have_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(sample_domain, "ROWS_PER_TASK", 500, raising=False)
    events = sample_domain.SampleDomain(apply_runtime_settings(spark), MEDIUM)._spread("events", "event_id")
    assert events.count() == 10_000 and events.rdd.getNumPartitions() == 20
