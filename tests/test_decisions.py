import pytest
from change_records import bronze_frame, record

from riskmart.plans.decisions import decide, new_payments, reason_counts


def decided(spark, rows):
    return {r.transaction_id: r for r in decide(new_payments(bronze_frame(spark, rows))).collect()}


def payment(amount, average, new_device, ip, home, shipping, failures, attempt):
    return {
        "amount": str(amount), "customer_average_amount": str(average), "is_new_device": new_device,
        "ip_region": ip, "home_region": home, "shipping_region": shipping,
        "login_failures": failures, "attempt_number": attempt,
    }


VECTORS = [
    ((75, 80, False, "NY", "NY", "NY", 0, 1), 0, "APPROVE", []),
    ((400, 100, False, "NY", "NY", "NY", 0, 1), 30, "REVIEW", ["AMOUNT_OUTLIER"]),
    (
        (500, 80, True, "CA", "NY", "CA", 5, 1), 100, "DECLINE",
        ["AMOUNT_OUTLIER", "NEW_DEVICE", "IP_HOME_MISMATCH", "SHIPPING_HOME_MISMATCH", "REPEATED_LOGIN_FAILURES"],
    ),
    (
        (1000, 20, True, "CA", "NY", "TX", 8, 7), 100, "DECLINE",
        ["AMOUNT_OUTLIER", "NEW_DEVICE", "IP_HOME_MISMATCH", "SHIPPING_HOME_MISMATCH",
         "REPEATED_LOGIN_FAILURES", "REPEATED_PAYMENT_ATTEMPTS"],
    ),
    ((250, 83, False, "NY", "NY", "NY", 0, 1), 30, "REVIEW", ["AMOUNT_OUTLIER"]),
    (("249.99", 83, False, "NY", "NY", "NY", 0, 1), 0, "APPROVE", []),
    (("300.30", "100.10", False, "NY", "NY", "NY", 0, 1), 30, "REVIEW", ["AMOUNT_OUTLIER"]),
    (("300.29", "100.10", False, "NY", "NY", "NY", 0, 1), 0, "APPROVE", []),
    ((10, 80, False, "NY", "NY", "NY", 2, 3), 0, "APPROVE", []),
    ((10, 80, False, "NY", "NY", "NY", 3, 3), 20, "APPROVE", ["REPEATED_LOGIN_FAILURES"]),
    ((10, 80, False, "NY", "NY", "CA", 3, 1), 30, "REVIEW", ["SHIPPING_HOME_MISMATCH", "REPEATED_LOGIN_FAILURES"]),
    ((10, 80, True, "CA", "NY", "NY", 3, 1), 60, "DECLINE", ["NEW_DEVICE", "IP_HOME_MISMATCH", "REPEATED_LOGIN_FAILURES"]),
    ((10, 80, True, "CA", "NY", "NY", 0, 4), 55, "REVIEW", ["NEW_DEVICE", "IP_HOME_MISMATCH", "REPEATED_PAYMENT_ATTEMPTS"]),
]


@pytest.mark.parametrize("signals,score,action,reasons", VECTORS, ids=lambda v: str(v)[:30])
def test_vectors(spark, signals, score, action, reasons):
    row = decided(spark, [record("payments", 1, **payment(*signals))])["t1"]
    assert (row.risk_score, row.action, row.reason_codes) == (score, action, reasons)
    assert row.rules_version == "rules-v1" and len(row.decision_id) == 64


def test_only_new_payments_with_a_key(spark):
    rows = [
        record("payments", 1, transaction_id="a"),
        record("payments", 2, transaction_id="b", op="r"),
        record("payments", 3, transaction_id="c", op="u"),
        record("payments", 4, transaction_id="d", op="d"),
        record("payments", 5, transaction_id=...),
        record("orders", 6),
    ]
    assert set(decided(spark, rows)) == {"a", "b"}


def test_missing_signals_do_not_fire(spark):
    rows = [record("payments", 1, ip_region=None, home_region=None, is_new_device=None, login_failures=None)]
    assert decided(spark, rows)["t1"].reason_codes == []


def test_missing_average_still_has_a_floor(spark):
    rows = [record("payments", 1, amount="250.00", customer_average_amount=None)]
    assert decided(spark, rows)["t1"].reason_codes == ["AMOUNT_OUTLIER"]


def test_reason_counts(spark):
    rows = [record("payments", i, transaction_id=str(i), login_failures=i) for i in range(1, 6)]
    counts = reason_counts(decide(new_payments(bronze_frame(spark, rows)))).collect()
    assert [(r.reason, r["count"]) for r in counts] == [("REPEATED_LOGIN_FAILURES", 3)]
