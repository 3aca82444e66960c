"""What each table must look like: entity contracts, gold contracts, CSV columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Contract type -> Spark SQL type. ``instant`` is epoch microseconds or ISO text.
SPARK_TYPE = {
    "string": "string",
    "integer": "int",
    "long": "bigint",
    "boolean": "boolean",
    "decimal": "decimal(12,2)",
    "instant": "timestamp",
}

# Columns every current-state row carries besides the contract fields.
LINEAGE_DDL = (
    "_cdc_operation string, _source_lsn bigint, _kafka_partition int, "
    "_kafka_offset bigint, _kafka_timestamp timestamp, _processed_at timestamp"
)
LINEAGE_COLUMNS = tuple(part.split()[0] for part in LINEAGE_DDL.split(", "))

QUARANTINE_DDL = (
    "quarantine_id string, topic string, kafka_partition int, kafka_offset bigint, "
    "kafka_timestamp timestamp, raw_payload string, error_codes array<string>, "
    "quarantined_at timestamp"
)

DECISION_DDL = (
    "decision_id string, transaction_id string, customer_id string, risk_score int, "
    "action string, reason_codes array<string>, rules_version string, "
    "decision_time timestamp, kafka_timestamp timestamp"
)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@dataclass(frozen=True)
class ValueRule:
    """A row breaks the rule when ``violation`` (Spark SQL) is true."""

    code: str
    violation: str


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    topic: str
    fields: dict[str, str]
    rules: tuple[ValueRule, ...] = ()

    @property
    def state_schema(self) -> T.StructType:
        typed = ", ".join(f"{name} {SPARK_TYPE[kind]}" for name, kind in self.fields.items())
        return schema_of(f"{typed}, {LINEAGE_DDL}")


# Topics, fields, allowed statuses and error codes of the four
# change-stream entities.
CUSTOMERS = Entity(
    "customers",
    key="customer_id",
    topic="commerce.commerce.customers",
    fields={
        "customer_id": "string",
        "home_region": "string",
        "account_created_at": "instant",
        "average_order_amount": "decimal",
        "trusted_device_id": "string",
        "updated_at": "instant",
    },
    rules=(ValueRule("NEGATIVE_AVERAGE_ORDER_AMOUNT", "average_order_amount < 0"),),
)

ORDERS = Entity(
    "orders",
    key="order_id",
    topic="commerce.commerce.orders",
    fields={
        "order_id": "string",
        "customer_id": "string",
        "status": "string",
        "total_amount": "decimal",
        "shipping_region": "string",
        "created_at": "instant",
        "updated_at": "instant",
    },
    rules=(
        ValueRule("NEGATIVE_ORDER_AMOUNT", "total_amount < 0"),
        ValueRule(
            "INVALID_ORDER_STATUS",
            "status NOT IN ('CREATED', 'PAYMENT_PENDING', 'PAID', 'FAILED', "
            "'CANCELLED', 'SHIPPED', 'DELIVERED')",
        ),
    ),
)

PAYMENTS = Entity(
    "payments",
    key="transaction_id",
    topic="commerce.commerce.payments",
    fields={
        "transaction_id": "string",
        "event_id": "string",
        "order_id": "string",
        "customer_id": "string",
        "seller_id": "string",
        "event_time": "instant",
        "amount": "decimal",
        "currency": "string",
        "payment_type": "string",
        "device_id": "string",
        "is_new_device": "boolean",
        "ip_region": "string",
        "home_region": "string",
        "shipping_region": "string",
        "account_age_days": "integer",
        "login_failures": "integer",
        "attempt_number": "integer",
        "customer_average_amount": "decimal",
        "status": "string",
        "created_at": "instant",
    },
    rules=(
        ValueRule("NON_POSITIVE_PAYMENT_AMOUNT", "amount <= 0"),
        ValueRule("NEGATIVE_ACCOUNT_AGE", "account_age_days < 0"),
        ValueRule("NEGATIVE_LOGIN_FAILURES", "login_failures < 0"),
        ValueRule("INVALID_ATTEMPT_NUMBER", "attempt_number <= 0"),
        ValueRule("NEGATIVE_CUSTOMER_AVERAGE", "customer_average_amount < 0"),
        ValueRule("INVALID_PAYMENT_STATUS", "status NOT IN ('AUTHORIZED', 'DECLINED', 'PENDING')"),
    ),
)

CHARGEBACKS = Entity(
    "chargebacks",
    key="chargeback_id",
    topic="commerce.commerce.chargebacks",
    fields={
        "chargeback_id": "string",
        "transaction_id": "string",
        "reported_at": "instant",
        "reason": "string",
        "created_at": "instant",
    },
)

ENTITIES = (CUSTOMERS, ORDERS, PAYMENTS, CHARGEBACKS)

# Gold table -> columns that identify one row.
GOLD_GRAIN = {
    "daily_business_kpis": ("metric_date", "currency"),
    "daily_fraud_kpis": ("metric_date", "rules_version"),
    "seller_performance": ("seller_id",),
    "customer_360": ("customer_id",),
}

# Header columns of the nine CSV files, every one read as text.
CSV_COLUMNS = {
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    "order_payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "order_reviews": (
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ),
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "sellers": (
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ),
    "product_category_name_translation": (
        "product_category_name",
        "product_category_name_english",
    ),
}


def csv_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in CSV_COLUMNS[table]])
