"""Each violation turns exactly the gates red that watch for it."""

from datetime import datetime

import pytest

from pyspark.sql import functions as F

from riskmart.operators.gates import Gate, GateFailure, count_measure, evaluate, require
from riskmart.operators.observed import Observed, measure_rows
from riskmart.plans import document, gold, serving, verification
from riskmart.plans.decisions import decide
from riskmart.plans.verification import extract_gates, pre_publish_gates, published_gates
from riskmart.sources.json_extract import IdentifierLeak
from riskmart.sources.sample_domain import SampleDomain

AS_OF = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def tables(spark):
    """A small consistent set: the first customers' payments and all that belongs to them."""
    d = SampleDomain(spark, "/root/testdata/sf0.001")
    payments = d.payments().filter("CAST(customer_id AS INT) < 20").cache()
    chosen = payments.select("transaction_id")
    silver = {
        "customers": d.customers().filter("CAST(customer_id AS INT) < 20").cache(),
        "orders": d.orders().filter("CAST(customer_id AS INT) < 20").cache(),
        "payments": payments,
        "chargebacks": d.chargebacks().join(chosen, "transaction_id", "left_semi").cache(),
    }
    decisions = decide(payments).cache()
    enriched = gold.enrich(payments, decisions, silver["chargebacks"])
    built = {
        name: frame.cache()
        for name, frame in gold.gold_tables(silver["customers"], silver["orders"], enriched, AS_OF).items()
    }
    return silver, decisions, built


def red(frame):
    return {r.gate for r in frame.collect() if not r.passed}


def pre(silver, decisions):
    return red(pre_publish_gates(silver["payments"], decisions, silver["chargebacks"]))


def post(silver, decisions, built, log=None):
    return red(published_gates(log or silver["payments"], decisions, silver, built))


def test_all_green(tables):
    silver, decisions, built = tables
    assert pre(silver, decisions) == set()
    assert post(silver, decisions, built) == set()


def test_before_publishing(tables):
    silver, decisions, _ = tables
    one = decisions.limit(1)
    assert pre(silver, decisions.unionByName(one)) == {"one_decision_per_transaction"}
    assert pre(silver, decisions.filter("transaction_id <> '%s'" % one.first().transaction_id)) == {"payments_have_decisions"}
    chargebacks = silver["chargebacks"]
    twice = {**silver, "chargebacks": chargebacks.unionByName(chargebacks.limit(1))}
    assert pre(twice, decisions) == {"one_chargeback_per_transaction"}
    stray = chargebacks.limit(1).selectExpr("*").withColumn("transaction_id", chargebacks.chargeback_id)
    assert pre({**silver, "chargebacks": chargebacks.unionByName(stray)}, decisions) == {"chargebacks_have_payments"}


def doubled(frame):
    return frame.unionByName(frame.limit(1))


def test_duplicates_after_publishing(tables):
    silver, decisions, built = tables
    assert "decision_ids_unique" in post(silver, doubled(decisions), built)
    for name in silver:
        assert f"silver_{name}_keys_unique" in post({**silver, name: doubled(silver[name])}, decisions, built)
    for name in built:
        found = post(silver, decisions, {**built, name: doubled(built[name])})
        assert f"gold_{name}_grain_unique" in found


def test_reconciliation(tables):
    silver, decisions, built = tables

    def without(name, table):
        first = table.columns[0]
        return post(silver, decisions, {**built, name: table.filter(table[first] != table.first()[0])})

    assert {"business_total_equals_payments"} == without("daily_business_kpis", built["daily_business_kpis"])
    assert {"fraud_total_equals_decisions"} <= without("daily_fraud_kpis", built["daily_fraud_kpis"])
    assert {"seller_total_equals_payments", "one_row_per_active_seller"} == without(
        "seller_performance", built["seller_performance"]
    )
    assert "one_profile_per_customer" in without("customer_360", built["customer_360"])
    fewer = {**silver, "chargebacks": silver["chargebacks"].limit(1)}
    assert post(fewer, decisions, built) == {"confirmed_fraud_equals_chargebacks"}
    log = silver["payments"].limit(3)
    assert post(silver, decisions, built, log) == {"decisions_equal_logged_payments"}


def test_mixed_refresh_stamps(tables):
    silver, decisions, built = tables
    later = gold._stamp(built["customer_360"].drop("refreshed_at"), datetime(2024, 6, 2))
    assert post(silver, decisions, {**built, "customer_360": later}) == {"one_refresh_stamp"}


def test_extract_reconciles(spark):
    sections = {
        "daily_business_kpis": spark.sql("SELECT 2 AS payment_count"),
        "daily_fraud_kpis": spark.sql("SELECT 2 AS total_decisions"),
        "customer_risk_segments": spark.sql("SELECT * FROM VALUES ('LOW', 2), ('HIGH', 1) v(customer_risk_segment, count)"),
    }
    counts = spark.sql("SELECT * FROM VALUES ('payments', 2), ('decisions', 2), ('customers', 3) v(table_name, row_count)")
    assert red(extract_gates(sections, counts)) == set()
    sections["daily_business_kpis"] = spark.sql("SELECT 1 AS payment_count")
    assert red(extract_gates(sections, counts)) == {"extract_payments_reconcile"}


def test_require_names_the_failure(spark):
    rows = evaluate([count_measure(spark.range(3), "n")], [Gate("three", 3, "n"), Gate("four", 4, "n")])
    with pytest.raises(GateFailure, match="four: expected 4, found 3"):
        require(rows)


def test_a_missing_measure_is_red(spark):
    gates = [Gate("absent", "n", "no_such"), Gate("both", "x", "y"), Gate("some", None, ("n", "x")), Gate("fine", 3, "n"),
             Gate("stamps", None, ("x", "n"), empty_passes=True), Gate("none", None, ("x", "y"), empty_passes=True)]
    found = evaluate([count_measure(spark.range(3), "n")], gates)
    assert {r.gate for r in found.collect() if not r.passed} == {"absent", "both", "some"}


def test_segment_share_lists_empty_segments(spark):
    share = serving.segment_share(spark.sql("SELECT 'LOW' AS customer_risk_segment"))
    assert sorted(map(tuple, share.collect())) == [("HIGH", 0, 0.0), ("LOW", 1, 100.0), ("MEDIUM", 0, 0.0)]
    none = serving.segment_share(spark.sql("SELECT 'LOW' AS customer_risk_segment").limit(0))
    assert {r.share_pct for r in none.collect()} == {0.0}


def test_measures_are_observed_while_a_table_is_written(spark, tables, tmp_path):
    """Same gates as from the tables, without another look at them."""
    silver, decisions, built = tables
    observed, rows = Observed(), {}
    for name, frame in built.items():
        watched = observed.watch(frame, {f"rows.{name}": F.count("*"), **verification.gold_aggregates(name)})
        watched.write.parquet(f"{tmp_path}/{name}")
        rows[name] = frame.count()
    values = observed.values()
    assert {n: values[f"rows.{n}"] for n in built} == rows
    from_tables = published_gates(silver["payments"], decisions, silver, built).collect()
    assert published_gates(silver["payments"], decisions, silver, built, values).collect() == from_tables
    empty = Observed()
    empty.watch(spark.range(0).toDF("x"), {"n": F.count("*"), "t": F.sum("x")}).write.format("noop").mode("overwrite").save()
    assert empty.values() == {"n": 0, "t": None}
    assert sorted(map(tuple, measure_rows(spark, empty.values()).collect())) == [("n", 0), ("t", None)]


def written_document(built, silver, decisions, **changes):
    counts = {"bronze_records": 9, "quarantine_records": 1, "decisions": decisions.count(), **changes}
    counts = {**{n: f.count() for n, f in silver.items()}, **counts}
    return document.dashboard_document(built, counts, {n: f.count() for n, f in built.items()}, AS_OF)


def test_document_reconciles(tables):
    silver, decisions, built = tables
    good = written_document(built, silver, decisions)
    document.check_contract(good.schema)
    assert good.columns == list(document.SECTIONS) and red(document.document_gates(good)) == set()
    row = good.first()
    assert row.metadata.refreshed_at == "2024-06-01T00:00:00Z" and row.metadata.source_customers == silver["customers"].count()
    assert list(row.metadata.gold_row_counts.asDict()) == sorted(built)
    assert len(row.daily_business_kpis) == built["daily_business_kpis"].count()
    off = written_document(built, silver, decisions, payments=1, customers=0)
    assert red(document.document_gates(off)) == {"document_payments_reconcile", "document_customers_reconcile"}


def test_document_contract(spark, tables, monkeypatch):
    silver, decisions, built = tables
    good = written_document(built, silver, decisions)
    with pytest.raises(document.BadDocument, match="customer_risk_segments"):
        document.check_contract(good.drop("customer_risk_segments").schema)
    assert red(document.document_gates(good.withColumn("seller_risk_watchlist", F.expr("array(struct(1 AS seller_id))")))) == {
        "document_has_no_identifiers"
    }
    deep = good.withColumn("metadata", F.expr("struct(array(map('k', struct(1 AS order_id))) AS deep)"))
    with pytest.raises(IdentifierLeak, match="metadata.deep.order_id"):
        document.check_contract(deep.schema)
    with pytest.raises(document.BadDocument, match="no rows"):
        document.check_contract(good.withColumn("daily_fraud_kpis", F.lit(1)).schema)
    monkeypatch.setattr(document, "MAX_ROWS", 1)
    with pytest.raises(document.BadDocument, match="a document holds 1"):
        written_document(built, silver, decisions)


def test_empty_document(spark, tables):
    silver, decisions, built = tables
    none = {name: frame.limit(0) for name, frame in built.items()}
    empty = written_document(none, {n: f.limit(0) for n, f in silver.items()}, decisions.limit(0))
    assert empty.first().daily_business_kpis == [] and red(document.document_gates(empty)) == set()
