from datetime import datetime
from decimal import Decimal

import pytest
from change_records import GOOD, bronze_frame, record
from pyspark.sql import functions as F

from riskmart.contracts import CUSTOMERS, ENTITIES, LINEAGE_COLUMNS, ORDERS, PAYMENTS
from riskmart.functions.envelope import json_text
from riskmart.operators.merge import merge_changes
from riskmart.operators.quality import CODES, MASK, violations
from riskmart.plans.silver_cdc import (
    all_fields, newest_changes, parse_records, quarantine_rows, read_records, validate,
)
from riskmart.session import RUNTIME_SETTINGS

BY_NAME = {e.name: e for e in ENTITIES}


def codes_of(spark, entity, rows):
    parsed = parse_records(bronze_frame(spark, rows), BY_NAME[entity])
    return [r[0] for r in parsed.orderBy("_kafka_offset").select(CODES).collect()]


@pytest.mark.parametrize("entity", list(GOOD))
@pytest.mark.parametrize("wrapped", [True, False])
def test_clean_record(spark, entity, wrapped):
    assert codes_of(spark, entity, [record(entity, 1, wrapped=wrapped)]) == [[]]


ALONE = [
    ("customers", {"average_order_amount": "-0.01"}, ["NEGATIVE_AVERAGE_ORDER_AMOUNT"]),
    ("customers", {"home_region": ...}, ["MISSING_HOME_REGION"]),
    ("customers", {"home_region": "  "}, ["EMPTY_HOME_REGION"]),
    ("customers", {"average_order_amount": "much"}, ["MISSING_AVERAGE_ORDER_AMOUNT"]),
    ("customers", {"account_created_at": "soon"}, ["MISSING_ACCOUNT_CREATED_AT"]),
    ("customers", {"customer_id": ...}, ["MISSING_PRIMARY_KEY", "MISSING_CUSTOMER_ID"]),
    ("customers", {"op": "x"}, ["INVALID_CDC_OPERATION"]),
    ("orders", {"total_amount": "-5"}, ["NEGATIVE_ORDER_AMOUNT"]),
    ("orders", {"status": "LOST"}, ["INVALID_ORDER_STATUS"]),
    ("payments", {"amount": "0.00"}, ["NON_POSITIVE_PAYMENT_AMOUNT"]),
    ("payments", {"account_age_days": -1}, ["NEGATIVE_ACCOUNT_AGE"]),
    ("payments", {"login_failures": -1}, ["NEGATIVE_LOGIN_FAILURES"]),
    ("payments", {"attempt_number": 0}, ["INVALID_ATTEMPT_NUMBER"]),
    ("payments", {"customer_average_amount": "-1"}, ["NEGATIVE_CUSTOMER_AVERAGE"]),
    ("payments", {"status": "LOST"}, ["INVALID_PAYMENT_STATUS"]),
    ("payments", {"is_new_device": "perhaps"}, ["MISSING_IS_NEW_DEVICE"]),
    ("chargebacks", {"reason": ""}, ["EMPTY_REASON"]),
]


@pytest.mark.parametrize("entity,change,expected", ALONE, ids=lambda v: str(v)[:40])
def test_rule_fires_alone(spark, entity, change, expected):
    assert codes_of(spark, entity, [record(entity, 1, **change)]) == [expected]


def test_rules_spare_deletes_and_limits(spark):
    rows = [
        record("orders", 1, op="d", status="LOST", total_amount="-1"),
        record("orders", 2, total_amount="0.00"),
        record("orders", 3, op="r", status="SHIPPED"),
    ]
    assert codes_of(spark, "orders", rows) == [[], [], []]


def test_tombstones(spark):
    rows = [record("customers", 1, raw=False)]
    assert codes_of(spark, "customers", rows) == [["MISSING_PRIMARY_KEY", "INVALID_CDC_OPERATION"]]
    assert parse_records(bronze_frame(spark, rows), CUSTOMERS, skip_tombstones=True).count() == 0


def test_broken_json_is_quarantined(spark):
    rows = [record("customers", 1, raw='{"payload": {"op": "c", "aft'), record("customers", 2, raw="[]")]
    found = codes_of(spark, "customers", rows)
    assert all(found) and len(found) == 2


def test_typing(spark):
    rows = [
        record("customers", 1, average_order_amount="12.345", account_created_at="2023-11-14T22:13:20Z"),
        record("customers", 2, average_order_amount=7, account_created_at="1700000000000000"),
    ]
    parsed = parse_records(bronze_frame(spark, rows), CUSTOMERS).orderBy("_kafka_offset").collect()
    assert [r.average_order_amount for r in parsed] == [Decimal("12.35"), Decimal("7.00")]
    assert [r.account_created_at for r in parsed] == [datetime(2023, 11, 14, 22, 13, 20)] * 2


def test_null_in_new_image_falls_back_unless_told_not_to(spark):
    old = {**GOOD["customers"], "home_region": "CA"}
    rows = [record("customers", 1, op="u", before=old, home_region=None)]
    frame = bronze_frame(spark, rows)
    assert parse_records(frame, CUSTOMERS).first().home_region == "CA"
    assert parse_records(frame, CUSTOMERS, after_only=True).first().home_region is None


VALUES = ['12.50', '"12.50"', "null", "1e3", "true", '{"a": 1}', '"text"', '""', "[1, 2]", "-7"]


@pytest.mark.parametrize("text", VALUES)
def test_one_parse_renders_like_json_paths(spark, text):
    raw = '{"payload": {"op": "c", "after": {"home_region": %s}}}' % text
    frame = bronze_frame(spark, [record("customers", 1, raw=raw)])
    path = frame.select(json_text("raw_payload", "$.payload.after.home_region", "$.after.home_region")).first()[0]
    got = parse_records(frame, CUSTOMERS).first().home_region
    assert (got or "").replace(" ", "") == (path or "").replace(" ", "")


def newest(spark, rows):
    return newest_changes(parse_records(bronze_frame(spark, rows), CUSTOMERS), CUSTOMERS)


def test_newest_per_key(spark):
    rows = [
        record("customers", 1, lsn=5, home_region="A"),
        record("customers", 2, lsn=7, home_region="B"),
        record("customers", 3, lsn=7, home_region="C"),
        record("customers", 4, lsn=6, home_region="D"),
        record("customers", 9, lsn=9, home_region=" "),
    ]
    kept = newest(spark, rows).collect()
    assert [(r.home_region, r._source_lsn) for r in kept] == [("C", 7)]


def test_missing_lsn_is_oldest(spark):
    bare = '{"op": "u", "after": %s}' % __import__("json").dumps({**GOOD["customers"], "home_region": "Z"})
    rows = [record("customers", 5, raw=bare), record("customers", 1, lsn=0, home_region="A")]
    assert newest(spark, rows).first().home_region == "A"


def state(spark, rows):
    return newest(spark, rows).filter("_cdc_operation <> 'd'")


def merged(spark, old, new):
    target = state(spark, old) if old else newest(spark, [record("customers", 0)]).limit(0)
    out = merge_changes(target, newest(spark, new), CUSTOMERS)
    assert out.columns == [*CUSTOMERS.fields, *LINEAGE_COLUMNS]
    return sorted((r.customer_id, r.home_region) for r in out.collect())


def test_merge_cases(spark):
    old = [record("customers", 5, lsn=5, home_region="old")]
    assert merged(spark, old, [record("customers", 6, lsn=6, op="u", home_region="new")]) == [("c1", "new")]
    assert merged(spark, old, [record("customers", 6, lsn=4, op="u", home_region="new")]) == [("c1", "old")]
    assert merged(spark, old, [record("customers", 6, lsn=5, op="u", home_region="new")]) == [("c1", "new")]
    assert merged(spark, old, [record("customers", 6, lsn=5, partition=1, op="u", home_region="new")]) == [("c1", "old")]
    assert merged(spark, old, [record("customers", 5, lsn=5, op="u", home_region="new")]) == [("c1", "old")]
    assert merged(spark, old, [record("customers", 6, lsn=6, op="d")]) == []
    assert merged(spark, old, [record("customers", 6, lsn=4, op="d")]) == [("c1", "old")]
    assert merged(spark, [], [record("customers", 6, op="d")]) == []
    assert merged(spark, [], [record("customers", 6, op="u", home_region="new")]) == [("c1", "new")]
    other = record("customers", 6, customer_id="c2", home_region="new")
    assert merged(spark, old, [other]) == [("c1", "old"), ("c2", "new")]


def test_quarantine_is_keyed_by_place_in_log(spark):
    bad = record("payments", 3, amount="-1")
    rows = quarantine_rows(parse_records(bronze_frame(spark, [bad, bad, record("payments", 4)]), PAYMENTS))
    found = rows.collect()
    assert len(found) == 1 and found[0].error_codes == ["NON_POSITIVE_PAYMENT_AMOUNT"]
    expected = spark.range(1).select(F.sha2(F.lit(f"{PAYMENTS.topic}|0|3"), 256)).first()[0]
    assert found[0].quarantine_id == expected


def test_other_topics_are_left_out(spark):
    frame = bronze_frame(spark, [record("orders", 1), record("customers", 2)])
    assert parse_records(frame, ORDERS).count() == 1


@pytest.mark.parametrize("entity", list(GOOD))
def test_bits_stand_for_rules_in_order(spark, entity):
    rows = [record(entity, 1), record(entity, 2, op="x"), record(entity, 3, **{BY_NAME[entity].key: ...})]
    names = [code for code, _ in violations(BY_NAME[entity])]
    found = parse_records(bronze_frame(spark, rows), BY_NAME[entity]).select(MASK, CODES).collect()
    for row in found:
        assert row[1] == [name for k, name in enumerate(names) if row[0] >> k & 1]
    assert sorted(row[0] > 0 for row in found) == [False, True, True]


def test_one_reading_serves_all_topics(spark):
    """Records read with the fields of all entities give the same rows as read alone."""
    rows = [record(entity, k) for k, entity in enumerate(GOOD)] + [record("orders", 9, total_amount="-1")]
    frame = bronze_frame(spark, rows)
    records, stamp = read_records(frame, all_fields(ENTITIES)), F.lit("2024-01-01").cast("timestamp")
    for entity in ENTITIES:
        together = validate(records, entity, stamp).collect()
        assert together == parse_records(frame, entity, stamp).collect() and together


@pytest.mark.parametrize("entity", list(GOOD))
def test_rules_are_evaluated_once_in_generated_code(spark, entity):
    """Filters look at the number only; no rule is copied into them, and codes follow the filter."""
    parsed = parse_records(bronze_frame(spark, [record(entity, 1)]), BY_NAME[entity])
    for frame in (newest_changes(parsed, BY_NAME[entity]), quarantine_rows(parsed)):
        lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        filters = [line for line in lines if "Filter" in line and MASK in line]
        assert len(filters) == 1 and "trim" not in filters[0] and "MISSING" not in filters[0]
    plan = newest_changes(parsed, BY_NAME[entity])._jdf.queryExecution().optimizedPlan().toString()
    assert "MISSING_" not in plan


@pytest.mark.parametrize("entity", ENTITIES, ids=lambda e: e.name)
def test_rules_ask_once_whether_a_record_is_an_upsert(spark, entity):
    """Asked by every rule, the compiled rules are too long for the JVM to translate."""
    parsed = parse_records(bronze_frame(spark, [record("payments", 1)]), entity)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")  # else long projections are cut in the plan
    try:
        plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("IN (c,u,r)") == 1


def test_long_methods_are_not_interpreted():
    assert int(RUNTIME_SETTINGS["spark.sql.codegen.hugeMethodLimit"]) <= 8000
