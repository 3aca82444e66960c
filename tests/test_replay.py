import uuid
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F
from scales import SMALL

from riskmart.functions.identity import DEFAULT_NAMESPACE, entity_uuid, name_uuid
from riskmart.functions.values import mean_half_even
from riskmart.operators.basket import basket_match
from riskmart.plans.replay import ORDER_STATUS, Replay, order_slice, order_status, payment_status, payment_type
from riskmart.registry import QUERIES


def test_uuid_equals_python(spark):
    names = ["", "x", "ünïcode ✓", "a:b|c", *(f"order/{i}" for i in range(500))]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    for row in frame.select("name", name_uuid(F.col("name")).alias("u")).collect():
        assert row.u == str(uuid.uuid5(uuid.NAMESPACE_URL, row.name))
    dns = frame.select("name", name_uuid(F.col("name"), uuid.NAMESPACE_DNS).alias("u")).first()
    assert dns.u == str(uuid.uuid5(uuid.NAMESPACE_DNS, dns.name))


def test_uuid_works_on_bytes(spark):
    """Searching characters and encoding text took most of the time of a UUID."""
    plan = spark.range(1).select(name_uuid(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "encode(" not in plan and "translate(" not in plan


def test_entity_uuid_namespace(spark):
    one = spark.range(1)
    own = one.select(entity_uuid("seller", F.lit("s1"), "elsewhere")).first()[0]
    assert own == str(uuid.uuid5(uuid.NAMESPACE_URL, "elsewhere/seller/s1"))
    assert own != one.select(entity_uuid("seller", F.lit("s1"), DEFAULT_NAMESPACE)).first()[0]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 50)), min_size=50, max_size=50))
def test_mean_half_even(spark, pairs):
    rows = [(i, Decimal(cents) / 100, n) for i, (cents, n) in enumerate(pairs)]
    rows += [(1000, Decimal("0.05"), 2), (1001, Decimal("0.03"), 2), (1002, Decimal("0.01"), 2)]
    frame = spark.createDataFrame(rows, "i int, total decimal(20,6), n bigint")
    got = {r.i: r.m for r in frame.select("i", mean_half_even(F.col("total"), F.col("n")).alias("m")).collect()}
    for i, total, n in rows:
        assert got[i] == (total / n).quantize(Decimal("0.01"), ROUND_HALF_EVEN), (total, n)


def test_mappings(spark):
    def one(column):
        return spark.range(1).select(column).first()[0]

    for source, target in ORDER_STATUS.items():
        assert one(order_status(F.lit(f" {source.upper()} "))) == target
    assert one(order_status(F.lit("lost"))) is None
    assert one(payment_status(F.lit(" Canceled"))) == "DECLINED"
    assert one(payment_status(F.lit("delivered"))) == "AUTHORIZED"
    assert one(payment_type(F.lit(" debit card "))) == "DEBIT_CARD"
    assert one(payment_type(F.lit("  "))) == "UNKNOWN"


@pytest.fixture(scope="module")
def history(spark):
    def frame(columns, *rows):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))

    return {
        "customers_file": frame(
            "customer_id customer_unique_id customer_state",
            ("a1", "ann", "SP"), ("a2", "ann", "RJ"), ("b1", "bob", None), ("z1", "zoe", "MG"),
        ),
        "orders_file": frame(
            "order_id customer_id order_status order_purchase_timestamp order_approved_at",
            ("o1", "a1", "delivered", "2024-03-01 10:00:00", "2024-03-02 11:00:00"),
            ("o2", "a2", "canceled", "2024-01-01 10:00:00", None),
            ("o3", "b1", "shipped", "2024-02-01 10:00:00", ""),
            ("o4", "b1", "lost", "2024-02-02 10:00:00", None),
            ("o5", "z1", "created", "2024-05-01 10:00:00", None),
        ),
        "items_file": frame(
            "order_id order_item_id product_id seller_id price freight_value",
            ("o1", "2", "p1", "s1", "10.00", "1.00"), ("o1", "1", "p2", "s2", "20.01", "1.00"),
            ("o1", "3", "p1", "s1", "10.01", "1.00"), ("o2", "1", "p1", "s1", "7.00", "0.50"),
            ("o3", "10", "p3", "s1", "5.00", "0"), ("o3", "9", "p3", "s3", "5.00", "0"),
        ),
        "payments_file": frame(
            "order_id payment_sequential payment_type payment_value",
            ("o1", "1", "credit card", "30.00"), ("o1", "2", "voucher", "0.00"), ("o2", "1", " ", "0.05"),
            ("o4", "1", "boleto", "9.00"), ("o5", "1", "boleto", "4.00"),
        ),
        "products_file": frame("product_id product_category_name", ("p1", "casa"), ("p2", None), ("p3", "nova")),
        "translation_file": frame("product_category_name product_category_name_english", ("casa", "home")),
        "sellers_file": frame("seller_id seller_state", ("s1", "SP"), ("s2", None), ("s4", "RJ")),
    }


def key(entity, text):
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{DEFAULT_NAMESPACE}/{entity}/{text}"))


def by(frame, column):
    return {r[column]: r for r in frame.collect()}


def test_replayed_dimensions(history):
    replay = Replay(**history)
    people = by(replay.customers(), "customer_id")
    ann = people[key("customer", "ann")]
    assert (ann.home_region, str(ann.account_created_at)) == ("SP", "2023-12-02 10:00:00")
    assert ann.average_order_amount == Decimal("15.02")  # 30.05 / 2, the tie goes to the even cent
    assert ann.trusted_device_id == "trusted-ann"
    bob = people[key("customer", "bob")]
    assert (bob.home_region, bob.average_order_amount) == ("UNKNOWN", Decimal("9.00"))
    sellers = by(replay.sellers(), "seller_id")
    assert {k: r.seller_region for k, r in sellers.items()} == {key("seller", "s1"): "SP", key("seller", "s2"): "UNKNOWN"}
    listings = by(replay.listings(), "product_id")
    assert len(listings) == 4
    chair = listings[key("listing", "p1:s1")]
    assert (chair.category, chair.unit_price, chair.seller_id) == ("home", Decimal("9.00"), key("seller", "s1"))
    assert listings[key("listing", "p2:s2")].category == "unknown"
    assert listings[key("listing", "p3:s3")].category == "nova"
    assert {r.available_quantity for r in replay.inventory().collect()} == {1_000_000}


def test_replayed_facts(history):
    seen = Observation("replay")
    replay = Replay(**history, skipped=seen)
    orders = by(replay.orders(), "order_id")
    assert {r.status for r in orders.values()} == {"DELIVERED", "CANCELLED", "SHIPPED", "CREATED"}
    assert orders[key("order", "o1")].total_amount == Decimal("30.00")  # paid, not the item total
    assert orders[key("order", "o3")].total_amount == Decimal("10.00")  # nothing paid: items and freight
    assert [r.source_status for r in replay.unmapped_orders().collect()] == ["lost"]
    lines = {(r.order_id, r.product_id): r for r in replay.order_items().collect()}
    pair = lines[(key("order", "o1"), key("listing", "p1:s1"))]
    assert (pair.quantity, pair.unit_price) == (2, Decimal("10.00"))  # 20.01 / 2, even cent
    payments = by(replay.payments(), "transaction_id")
    assert seen.get == {"skipped_payments": 1}
    assert set(payments) == {key("transaction", "o1:1"), key("transaction", "o2:1")}  # o4, o5 have no items
    first = payments[key("transaction", "o1:1")]
    assert first.seller_id == key("seller", "s2")  # lowest item number
    assert (str(first.event_time), first.account_age_days) == ("2024-03-02 11:00:00", 91)
    assert (first.payment_type, first.status, first.attempt_number) == ("CREDIT_CARD", "AUTHORIZED", 1)
    second = payments[key("transaction", "o2:1")]
    assert (second.payment_type, second.status, second.home_region) == ("UNKNOWN", "DECLINED", "RJ")
    assert replay.skipped_payments().first()[0] == 1


def test_slice(history, spark):
    replay = Replay(**history, limit=2)
    assert {r.order_id for r in replay.orders().collect()} == {key("order", "o2"), key("order", "o3")}
    assert {r.customer_id for r in replay.customers().collect()} == {key("customer", "ann"), key("customer", "bob")}
    ann = by(replay.customers(), "customer_id")[key("customer", "ann")]
    assert ann.average_order_amount == Decimal("15.02")  # history outside the slice still counts
    assert replay.listings().count() == 3
    with pytest.raises(ValueError):
        order_slice(spark.range(1), -1)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(1, 400_000), min_size=1, max_size=30),
    st.lists(st.integers(0, 900_000), min_size=1, max_size=30),
)
def test_basket_match_equals_brute_force(spark, prices, baselines):
    catalogue = spark.createDataFrame(
        [(i, Decimal(p) / 100) for i, p in enumerate(prices)], "product_key bigint, unit_price decimal(12,2)"
    )
    customers = spark.createDataFrame(
        [(str(i), Decimal(b) / 100) for i, b in enumerate(baselines)], "customer_id string, baseline decimal(12,2)"
    )
    got = by(basket_match(customers, catalogue), "customer_id")
    for i, b in enumerate(baselines):
        options = [(p * q, i2, q) for i2, p in enumerate(prices) for q in (1, 2, 3)]
        inside = [o for o in options if b <= 2 * o[0] <= 3 * b]
        distance, product, quantity = min((abs(a - b), k, q) for a, k, q in options)
        row = got[str(i)]
        assert (row.in_band_baskets, row.in_band) == (len(inside), bool(inside))
        assert (row.product_key, row.quantity) == (product, quantity), (b, options)


def test_basket_match_without_catalogue(spark):
    customers = spark.sql("SELECT 'c' AS customer_id, CAST(5 AS DECIMAL(12,2)) AS baseline")
    catalogue = spark.sql("SELECT 1L AS product_key, CAST(1 AS DECIMAL(12,2)) AS unit_price").limit(0)
    row = basket_match(customers, catalogue).first()
    assert (row.in_band_baskets, row.in_band, row.product_key) == (0, False, None)


def test_tasks_of_unmapped_orders_read_little(spark):
    QUERIES["replay_unmapped"](spark, SMALL)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
