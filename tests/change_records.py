"""Literal change records for tests."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from riskmart.contracts import ENTITIES, schema_of
from riskmart.sources.change_log import BRONZE_DDL, RECORD_DDL, bronze_rows

START = datetime(2024, 1, 1)

GOOD = {
    "customers": {
        "customer_id": "c1", "home_region": "NY", "account_created_at": 1700000000000000,
        "average_order_amount": "80.00", "trusted_device_id": "d1", "updated_at": "2024-01-01T00:00:00Z",
    },
    "orders": {
        "order_id": "o1", "customer_id": "c1", "status": "PAID", "total_amount": "75.00",
        "shipping_region": "NY", "created_at": 1700000000000000, "updated_at": 1700000000000000,
    },
    "payments": {
        "transaction_id": "t1", "event_id": "e1", "order_id": "o1", "customer_id": "c1", "seller_id": "s1",
        "event_time": 1700000000000000, "amount": "75.00", "currency": "USD", "payment_type": "CARD",
        "device_id": "d1", "is_new_device": False, "ip_region": "NY", "home_region": "NY",
        "shipping_region": "NY", "account_age_days": 10, "login_failures": 0, "attempt_number": 1,
        "customer_average_amount": "80.00", "status": "AUTHORIZED", "created_at": 1700000000000000,
    },
    "chargebacks": {
        "chargeback_id": "x1", "transaction_id": "t1", "reported_at": 1700000000000000,
        "reason": "FRAUD", "created_at": 1700000000000000,
    },
}
TOPIC = {entity.name: entity.topic for entity in ENTITIES}


def record(entity, offset, lsn=None, op="c", partition=0, wrapped=True, before=None, after=True, raw=None, **changes):
    image = {**GOOD[entity], **changes}
    image = {k: v for k, v in image.items() if v is not ...}
    body = {
        "op": op,
        "before": before if before is not None else (image if op == "d" else None),
        "after": image if after and op != "d" else None,
        "source": {"lsn": offset if lsn is None else lsn},
    }
    text = raw if raw is not None else json.dumps({"payload": body} if wrapped else body)
    if raw is False:
        text = None
    return (
        TOPIC[entity], partition, offset, START + timedelta(seconds=offset),
        b"k", None if text is None else text.encode(),
    )


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, schema_of(RECORD_DDL))


def bronze_frame(spark, rows):
    frame = bronze_rows(raw_frame(spark, rows), F.lit("2024-01-01").cast("timestamp"))
    assert frame.schema.simpleString() == schema_of(BRONZE_DDL).simpleString()
    return frame
