"""The whole way: log to bronze, silver, decisions, gold, extract and gates."""

import json
from datetime import datetime

import pytest
from change_records import raw_frame, record

from riskmart import jobs
from riskmart.contracts import CSV_COLUMNS
from riskmart.operators.gates import GateFailure
from riskmart.plans import document
from riskmart.plans.verification import PRE_PUBLISH, PUBLISHED
from riskmart.sources.change_log import log_from_files
from riskmart.sources.csv_snapshot import write_csv
from riskmart.sources.json_extract import IdentifierLeak, publish_extract
from riskmart.sources.sample_domain import SampleDomain
from riskmart.streaming import pipeline

FIRST = [
    record("customers", 1, customer_id="c1"),
    record("customers", 2, customer_id="c2"),
    record("orders", 3, order_id="o1"),
    record("payments", 4, transaction_id="t1", amount="500.00", login_failures=4),
    record("payments", 5, transaction_id="t2", customer_id="c2", amount="20.00"),
    record("payments", 6, transaction_id="t3", status="LOST"),
    record("chargebacks", 7, transaction_id="t1"),
]
SECOND = [
    record("payments", 8, transaction_id="t3", op="r"),
    record("payments", 9, transaction_id="t1", op="r", amount="500.00", login_failures=4),
    record("customers", 10, customer_id="c3", home_region="CA"),
]


def run_streams(spark, lake, log):
    jobs.ingest(lake, log_from_files(spark, log), drain=True).awaitTermination()
    jobs.curate(lake, drain=True).awaitTermination()
    jobs.decide(lake, drain=True).awaitTermination()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = jobs.Lakehouse(spark, str(root / "house"), buckets=4)
    log = str(root / "log")
    raw_frame(spark, FIRST).coalesce(1).write.parquet(log)
    run_streams(spark, lake, log)
    # The streams stop, more records arrive, and they go on from their checkpoints.
    raw_frame(spark, SECOND).coalesce(1).write.mode("append").parquet(log)
    run_streams(spark, lake, log)
    return lake


def test_bronze_holds_each_record_once(lake):
    assert lake.bronze().count() == len(FIRST) + len(SECOND)
    assert "ingest_date" in lake.bronze().columns


def test_silver_and_quarantine(lake):
    assert lake.silver.read("payments").count() == 3
    assert lake.silver.read("customers").count() == 3
    assert [r.error_codes for r in lake.silver.read(pipeline.QUARANTINE).collect()] == [["INVALID_PAYMENT_STATUS"]]


def test_one_decision_per_payment_despite_a_second_snapshot(lake):
    rows = {r.transaction_id: r.action for r in lake.decisions.read(pipeline.DECISIONS).collect()}
    assert rows == {"t1": "REVIEW", "t2": "APPROVE", "t3": "APPROVE"}


def test_gold_gates_and_extract(lake):
    jobs.refresh_gold(lake, datetime(2024, 6, 1))
    segments = {r.customer_id: r.customer_risk_segment for r in lake.gold.read("customer_360").collect()}
    assert segments == {"c1": "HIGH", "c2": "LOW", "c3": "LOW"}
    assert lake.gold.read("daily_business_kpis").first().chargeback_count == 1
    gates = jobs.verify(lake).collect()
    assert [g.gate for g in gates if not g.passed] == []
    assert len(gates) == len(PRE_PUBLISH) + len(PUBLISHED)

    watchlist = lake.gold.read("extract_seller_risk_watchlist")
    assert watchlist.first().seller_rank == 1
    for name in ("metadata", "daily_business_kpis", "daily_fraud_kpis", "customer_risk_segments"):
        assert not [c for c in lake.gold.read(f"extract_{name}").columns if c.endswith("_id")]
    folder = lake.gold._latest()[1]["extract_daily_business_kpis"]["folders"]["all"][0]
    line = json.loads(lake.spark.read.text(folder).first()[0])
    assert line["gross_payment_value"] == 595.0 and line["metric_date"] == "2023-11-14"
    counts = lake.gold.read("extract_metadata").first().row_counts
    assert counts["payments"] == 3 and counts["quarantine_records"] == 1


def test_summary(lake):
    row = jobs.summary(lake).collect()[0]
    assert row.topic_counts["commerce.commerce.payments"] == 5 and row.bronze_records == len(FIRST) + len(SECOND)
    assert len(row.action_counts) == 2 and len(row.reason_counts) == 2
    assert row.silver_counts == {"customers": 3, "orders": 1, "payments": 3, "chargebacks": 1}
    assert set(row.gold_duplicate_keys.values()) == {0} and row.quarantine_records == 1


def test_document_is_published_whole(lake):
    text = lake.spark.read.text(lake.gold._latest()[1]["dashboard_document"]["folders"]["all"][0]).collect()
    found = json.loads(text[0][0])
    assert len(text) == 1 and list(found) == list(document.SECTIONS)
    assert found["metadata"]["source_payments"] == 3 and found["metadata"]["quarantine_records"] == 1
    assert found["metadata"]["gold_row_counts"]["customer_360"] == 3
    assert found["seller_risk_watchlist"][0]["seller_rank"] == 1
    assert sum(r["payment_count"] for r in found["daily_business_kpis"]) == 3


def test_identifiers_stay_inside(spark, lake):
    nested = spark.sql("SELECT 1 AS n, array(struct('x' AS seller_id)) AS rows")
    with pytest.raises(IdentifierLeak, match="bad.rows.seller_id"):
        publish_extract(lake.gold, {"good": spark.range(1).toDF("n"), "bad": nested})
    assert not lake.gold.exists("extract_good")


def test_gold_is_not_built_on_unmatched_chargebacks(spark, tmp_path):
    lake = jobs.Lakehouse(spark, str(tmp_path / "house"), buckets=2)
    log = str(tmp_path / "log")
    raw_frame(spark, [*FIRST, record("chargebacks", 20, chargeback_id="x9", transaction_id="t9")]).write.parquet(log)
    run_streams(spark, lake, log)
    with pytest.raises(GateFailure, match="chargebacks_have_payments"):
        jobs.refresh_gold(lake)
    assert not lake.gold.exists("customer_360")


def test_gold_that_does_not_reconcile_is_never_seen(spark, tmp_path, monkeypatch):
    lake = jobs.Lakehouse(spark, str(tmp_path / "house"), buckets=2)
    raw_frame(spark, FIRST).write.parquet(str(tmp_path / "log"))
    run_streams(spark, lake, str(tmp_path / "log"))
    whole = jobs.gold.gold_tables
    monkeypatch.setattr(
        jobs.gold, "gold_tables",
        lambda *a: {n: t.limit(0) if n == "seller_performance" else t for n, t in whole(*a).items()},
    )
    with pytest.raises(GateFailure, match="seller_total_equals_payments"):
        jobs.refresh_gold(lake)
    assert not lake.gold.exists("customer_360")


@pytest.fixture(scope="module")
def csv_folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    domain = SampleDomain(spark, "/root/testdata/sf0.001")
    for table in CSV_COLUMNS:
        write_csv(domain.market(table), table, f"{folder}/{table}.csv")
    return str(folder)


def test_market_job(spark, csv_folder, tmp_path):
    lake = jobs.Lakehouse(spark, str(tmp_path / "house"))
    jobs.load_market(lake, csv_folder)
    assert lake.market.read("payment_risk_signals").count() == 6000
    assert lake.market.read("fact_reviews").count() == 1000
    assert lake.market.read("customer_360").count() == 75
    assert set(lake.market.read("bronze_orders").columns) > {"_source_file", "_ingested_at"}


def test_replay_job_twice_changes_nothing(spark, csv_folder, tmp_path):
    lake = jobs.Lakehouse(spark, str(tmp_path / "house"), buckets=2)
    jobs.load_replay(lake, csv_folder, limit=100)
    first = {t: lake.replay.read(t).count() for t in ("orders", "payments", "order_items", "customers")}
    assert first["orders"] == 100
    jobs.load_replay(lake, csv_folder, limit=100)
    assert {t: lake.replay.read(t).count() for t in first} == first
    jobs.load_replay(lake, csv_folder, limit=0)
    assert lake.replay.read("orders").count() == 1500
