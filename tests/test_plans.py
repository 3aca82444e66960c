"""Properties of the plans: what they avoid, and how they treat hot keys."""

import re

import pytest
from change_records import bronze_frame, record
from pyspark.sql import functions as F
from scales import SMALL

from riskmart.contracts import CUSTOMERS, PAYMENTS
from riskmart.operators.latest import newest_per_key
from riskmart.operators.spread import hot_keys, spread_join
from riskmart.plans.market_gold import payment_context
from riskmart.plans.silver_cdc import newest_changes, parse_records
from riskmart.registry import QUERIES

WRITERS = {
    "csv_reviews", "csv_row_counts", "stream_final_state", "stream_restarted", "gates_summary", "pipeline_summary",
    "extract_document", "extract_document_gates",
}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_and_no_pairwise_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name", ["seller_watchlist", "top_sellers", "top_risky_payments"])
def test_top_rows_are_cut_before_the_exchange(spark, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SMALL))


def test_slice_of_orders_passes_no_single_task(spark):
    plan = plan_of(QUERIES["replay_order_slice"](spark, SMALL))
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan and "SinglePartition" not in plan


def test_gates_compute_no_gold_table_again(spark):
    """Gold is scanned from where it was stored: for its keys, and for the sections of the extract."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # else long paths are cut in the plan
    try:
        plan = plan_of(QUERIES["gates_summary"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    for name in ("daily_business_kpis", "daily_fraud_kpis", "seller_performance", "customer_360"):
        assert 1 <= sum(f"riskmart-{name}" in line for line in scans) <= 2


def test_payload_is_parsed_once_and_below_the_filters(spark):
    parsed = parse_records(bronze_frame(spark, [record("payments", 1)]), PAYMENTS)
    plan = parsed.filter("size(_quality_errors) = 0 AND amount > 5").drop("raw_payload")._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("from_json(") == 1


def test_bronze_scan_is_pruned(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze_frame(spark, [record("payments", 1)]).write.partitionBy("ingest_date").parquet(path)
    rows = newest_changes(parse_records(spark.read.parquet(path).filter("ingest_date = '2024-01-01'"), CUSTOMERS), CUSTOMERS)
    plan = plan_of(rows)
    assert "EqualTo(topic,commerce.commerce.customers)" in plan
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert "message_key" not in plan and "ingested_at" not in plan


def test_newest_per_key_reduces_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = plan_of(newest_per_key(rows, ["k"], [F.col("v")]))
    below_exchange = plan[plan.index("Exchange"):]
    assert "partial_max_by" in below_exchange
    assert sorted(map(tuple, newest_per_key(rows, ["k"], [F.col("v")]).collect())) == [(0, 999), (1, 997), (2, 998)]


@pytest.fixture
def wide_shuffle(spark):
    """Sixteen fixed shuffle partitions, so that partition sizes can be looked at."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("16", "false", "-1")):
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_share(frame):
    sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_key_with_a_third_of_the_rows_is_split(wide_shuffle, how):
    spark = wide_shuffle
    facts = spark.range(120_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 AND id % 2 = 0 THEN NULL ELSE id END AS k", "id AS v"
    )
    lookup = spark.range(0, 120_000, 2).selectExpr("id AS k", "id * 10 AS w").union(spark.sql("SELECT 7L, 70L"))
    plain = facts.join(lookup, "k", how)
    spread = spread_join(facts, lookup, "k", ["v"], how)
    assert spread.columns == plain.columns
    assert spread.count() == plain.count()
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    assert largest_share(plain) > 0.3
    assert largest_share(spread) < 0.2


def test_two_hundred_hot_keys_get_slots_by_their_rows(spark):
    facts = spark.range(200_000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN id div 2 % 200 WHEN id % 5 = 0 THEN -1 ELSE id END AS k", "id AS v"
    ).repartition(8, "v")
    found = {r.k: r._slots for r in hot_keys(facts, "k").collect()}
    assert set(found) == {-1, *range(200)}
    assert all(2 <= found[k] <= 4 for k in range(200)) and 95 <= found[-1] <= 110
    lookup = facts.select("k").distinct().selectExpr("k", "k * 3 AS w")
    spread = spread_join(facts, lookup, "k", ["v"])
    assert spread.count() == 200_000 and spread.where("w <> k * 3 OR w IS NULL").isEmpty()


def test_repeated_lookup_rows_are_all_joined(spark):
    facts = spark.range(3000).selectExpr("1L AS k", "id AS v")
    lookup = spark.sql("SELECT * FROM VALUES (1L, 'a'), (1L, 'b'), (2L, 'c') v(k, w)")
    rows = spread_join(facts, lookup, "k", ["v"])
    assert rows.count() == 6000 and rows.distinct().count() == 6000


def test_context_with_one_order_and_person_for_a_third_of_the_payments(spark):
    """Equal to the textbook form: join everything, group, then a window for the mean."""
    payments = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('o', id % 500) END AS order_id",
        "CAST(id AS INT) AS payment_sequence", "'X' AS payment_type", "CAST(id % 12 AS INT) AS installments",
        "CAST(id % 97 + 0.25 AS DECIMAL(18,2)) AS payment_value_brl",
    )
    payments = payments.union(payments.limit(500))
    orders = payments.select("order_id").distinct().selectExpr(
        "order_id", "concat('c', abs(hash(order_id)) % 300) AS customer_id",
        "TIMESTAMP '2024-01-01' AS purchased_at", "'delivered' AS order_status",
    )
    customers = orders.select("customer_id").distinct().selectExpr(
        "customer_id", "concat('p', abs(hash(customer_id)) % 5) AS customer_unique_id"
    )
    reviews = orders.filter("order_id > 'o3'").selectExpr("order_id", "explode(array(1, 4, NULL)) AS review_score")
    for name, frame in (("payments", payments), ("orders", orders), ("customers", customers), ("reviews", reviews)):
        frame.createOrReplaceTempView(f"t_{name}")
    textbook = spark.sql(
        """WITH g AS (SELECT o.order_id, customer_unique_id, purchased_at, order_status, payment_sequence,
             payment_type, installments, payment_value_brl, max(review_score) AS review_score
           FROM t_payments p JOIN t_orders o ON p.order_id = o.order_id
           JOIN t_customers c ON c.customer_id = o.customer_id LEFT JOIN t_reviews r ON r.order_id = o.order_id
           GROUP BY ALL)
        SELECT *, avg(payment_value_brl) OVER (PARTITION BY customer_unique_id) AS customer_average_brl FROM g"""
    )
    ours = payment_context(orders, customers, payments, reviews).select(*textbook.columns)
    assert ours.count() == textbook.count() == 9000
    assert ours.exceptAll(textbook).isEmpty()


@pytest.mark.parametrize("name", ["daily_business_kpis", "extract_business_kpis", "currency_totals"])
def test_business_figures_join_no_decisions(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1


def test_persons_of_orders_are_found_once(spark):
    """Their two readers and the searches for hot keys share one scan and one join."""
    signals = QUERIES["payment_risk_signals"](spark, SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(signals)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"FileScan parquet \[[^\]]*o_custkey", plan)) == 1
    assert len(re.findall(r"FileScan parquet \[[^\]]*c_custkey", plan)) == 1


def test_persons_without_a_name_have_no_mean(spark):
    orders = spark.sql(
        "SELECT string(id) order_id, string(id) customer_id, timestamp'2024-01-01' purchased_at, 'x' order_status FROM range(5)"
    )
    customers = spark.createDataFrame(
        [("0", None), ("1", None), ("2", ""), ("3", "p"), ("4", "p")], "customer_id string, customer_unique_id string"
    )
    payments = spark.sql(
        "SELECT string(id) order_id, 1 payment_sequence, 'y' payment_type, 1 installments, "
        "CAST(10 * (id + 1) AS decimal(14,2)) payment_value_brl FROM range(5)"
    )
    reviews = spark.createDataFrame([], "order_id string, review_score int")
    found = payment_context(orders, customers, payments, reviews).select("order_id", "customer_unique_id", "customer_average_brl")
    want = {"0": (None, None), "1": (None, None), "2": ("", 30), "3": ("p", 45), "4": ("p", 45)}
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == want
