"""Named queries over the sample tables, one or more per operator.

``shown`` turns results into plain columns that any engine can compare: decimals as
doubles, dates as ISO text, arrays as comma-separated text, instants as zone-less UTC.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.contracts import CHARGEBACKS, CSV_COLUMNS, CUSTOMERS, ENTITIES, GOLD_GRAIN, LINEAGE_COLUMNS, ORDERS, PAYMENTS
from riskmart.functions.envelope import json_text
from riskmart.jobs import DOCUMENT_TABLE, Lakehouse, curate, decide, ingest, publish_document
from riskmart.operators import basket
from riskmart.operators.first_n import first_n
from riskmart.operators.gates import key_measures
from riskmart.operators.history import state_at, validity_intervals
from riskmart.operators.latest import newest_per_key
from riskmart.operators.merge import insert_absent, merge_actions, merge_changes, upsert
from riskmart.operators.observed import Observed
from riskmart.operators.quality import CODES, MASK, clean
from riskmart.operators.velocity import velocity
from riskmart.plans import decisions as risk
from riskmart.plans import document, gold, market_gold, market_silver, serving, verification
from riskmart.plans import silver_cdc as silver
from riskmart.plans.replay import ORDER_STATUS, Replay, order_status, payment_status
from riskmart.session import TIDY_SETTINGS, apply_runtime_settings, discard, scoped_settings, shared_folder
from riskmart.sources.change_log import BatchBound, bronze_rows, log_from_files
from riskmart.sources.csv_snapshot import read_csv, write_csv
from riskmart.sources.json_extract import json_ready
from riskmart.sources.sample_domain import SampleDomain
from riskmart.streaming import pipeline

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-06-01 00:00:00"
QUERIES: dict[str, Query] = {}


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def shown(frame: DataFrame) -> DataFrame:
    columns = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def query(build: Callable[[SampleDomain], DataFrame]) -> Callable[[SampleDomain], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(build(SampleDomain(apply_runtime_settings(spark), sf_dir)))

    QUERIES[build.__name__] = run
    return build


# ---- bronze and silver from the change stream ---------------------------------


@query
def bronze_lineage(d: SampleDomain) -> DataFrame:
    rows = bronze_rows(d.change_stream(), as_of())
    return rows.withColumn("has_payload", F.col("raw_payload").isNotNull()).drop("raw_payload", "ingested_at")


@query
def topic_counts(d: SampleDomain) -> DataFrame:
    return risk.group_counts(bronze_rows(d.change_stream(), as_of()), "topic")


def parsed(d: SampleDomain, entity) -> DataFrame:
    records = {
        "customers": d.customer_changes, "orders": d.order_changes,
        "payments": d.payment_changes, "chargebacks": d.chargeback_changes,
    }[entity.name]()
    return silver.parse_records(bronze_rows(records, as_of()), entity, as_of())


@query
def cdc_parse_customers(d: SampleDomain) -> DataFrame:
    return parsed(d, CUSTOMERS).drop("_processed_at", "topic", "raw_payload", MASK, CODES)


@query
def cdc_parse_payments(d: SampleDomain) -> DataFrame:
    return parsed(d, PAYMENTS).drop("_processed_at", "topic", "raw_payload", MASK, CODES)


def codes(d: SampleDomain, entity) -> DataFrame:
    return parsed(d, entity).select(
        "_kafka_partition", "_kafka_offset", F.array_join(CODES, ",").alias("error_codes")
    )


@query
def cdc_quality_customers(d: SampleDomain) -> DataFrame:
    return codes(d, CUSTOMERS)


@query
def cdc_quality_orders(d: SampleDomain) -> DataFrame:
    return codes(d, ORDERS)


@query
def cdc_quality_payments(d: SampleDomain) -> DataFrame:
    return codes(d, PAYMENTS)


@query
def cdc_quality_chargebacks(d: SampleDomain) -> DataFrame:
    return codes(d, CHARGEBACKS)


def newest(d: SampleDomain, entity) -> DataFrame:
    return silver.newest_changes(parsed(d, entity), entity).drop("_processed_at")


@query
def cdc_latest_per_key(d: SampleDomain) -> DataFrame:
    return newest(d, CUSTOMERS)


def snapshot_and_changes(d: SampleDomain) -> tuple[DataFrame, DataFrame]:
    """Customers as first loaded, and the newest change of each key after that."""
    rows = parsed(d, CUSTOMERS)
    first = silver.live_rows(silver.newest_changes(rows.filter(F.col("_source_lsn") == 1), CUSTOMERS))
    later = silver.newest_changes(rows.filter(F.col("_source_lsn") > 1), CUSTOMERS)
    return first, later


@query
def cdc_current_state(d: SampleDomain) -> DataFrame:
    return merge_changes(*snapshot_and_changes(d), CUSTOMERS).drop("_processed_at")


def later(d: SampleDomain, entity) -> DataFrame:
    return silver.parse_records(bronze_rows(d.later_changes(entity), as_of()), entity, as_of())


def newest_of_history(d: SampleDomain, entity) -> DataFrame:
    """Inserts and later changes, as one log."""
    return silver.newest_changes(parsed(d, entity).unionByName(later(d, entity)), entity).drop("_processed_at")


def state_of_history(d: SampleDomain, entity) -> DataFrame:
    """Inserts as loaded first, later changes merged into them."""
    first = silver.live_rows(silver.newest_changes(parsed(d, entity), entity))
    return merge_changes(first, silver.newest_changes(later(d, entity), entity), entity).drop("_processed_at")


@query
def cdc_latest_orders(d: SampleDomain) -> DataFrame:
    return newest_of_history(d, ORDERS)


@query
def cdc_latest_payments(d: SampleDomain) -> DataFrame:
    return newest_of_history(d, PAYMENTS)


@query
def cdc_latest_chargebacks(d: SampleDomain) -> DataFrame:
    return newest_of_history(d, CHARGEBACKS)


@query
def cdc_state_orders(d: SampleDomain) -> DataFrame:
    return state_of_history(d, ORDERS)


@query
def cdc_state_payments(d: SampleDomain) -> DataFrame:
    return state_of_history(d, PAYMENTS)


@query
def cdc_state_chargebacks(d: SampleDomain) -> DataFrame:
    return state_of_history(d, CHARGEBACKS)


def customer_intervals(d: SampleDomain) -> DataFrame:
    rows = clean(parsed(d, CUSTOMERS)).select(*CUSTOMERS.fields, *LINEAGE_COLUMNS)
    place = [F.col("_kafka_timestamp"), F.col("_kafka_offset"), F.col("_kafka_partition")]
    versions = newest_per_key(rows, ["customer_id", "_source_lsn"], place)
    return validity_intervals(versions, "customer_id", "_source_lsn", F.col("_cdc_operation") == "d", width=1000)


@query
def customer_history(d: SampleDomain) -> DataFrame:
    """Every version of a customer with the stretch of the log in which it held."""
    return customer_intervals(d).drop("_processed_at")


@query
def customers_as_of(d: SampleDomain) -> DataFrame:
    """The customers at a place in the middle of the log, from their history."""
    return state_at(customer_intervals(d), 1_001_000).drop("_processed_at", "valid_from", "valid_to", "is_current")


@query
def cdc_merge_actions(d: SampleDomain) -> DataFrame:
    actions = merge_actions(*snapshot_and_changes(d), CUSTOMERS)
    return risk.group_counts(actions.withColumnRenamed("_action", "action"), "action")


@query
def cdc_quarantine(d: SampleDomain) -> DataFrame:
    bronze = bronze_rows(d.change_stream(), as_of())
    return silver.quarantine_of_all(bronze, ENTITIES, as_of()).drop("raw_payload", "quarantined_at")


# ---- decisions -----------------------------------------------------------------


@query
def payment_decisions(d: SampleDomain) -> DataFrame:
    bronze = bronze_rows(d.payment_changes(with_faults=False), as_of())
    return risk.decide(risk.new_payments(bronze), as_of())


@query
def action_counts(d: SampleDomain) -> DataFrame:
    return risk.group_counts(risk.decide(d.payments(), as_of()), "action")


@query
def reason_counts(d: SampleDomain) -> DataFrame:
    return risk.reason_counts(risk.decide(d.payments(), as_of()))


@query
def customer_velocity(d: SampleDomain) -> DataFrame:
    """Activity of a customer in the 1, 5 and 30 minutes up to each of its events."""
    events = d.table("events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(12,2)").alias("value")
    )
    return velocity(events, "event_id", "user_id", "ts", "value")


# ---- gold ----------------------------------------------------------------------


def enriched(d: SampleDomain) -> DataFrame:
    payments = d.payments()
    return gold.enrich(payments, risk.decide(payments, as_of()), d.chargebacks())


def business_kpis(d: SampleDomain) -> DataFrame:
    """They ask for no decision, so payments are not joined with theirs."""
    return gold.daily_business_kpis(gold.with_chargebacks(d.payments(), d.chargebacks()), AS_OF)


@query
def enriched_payments(d: SampleDomain) -> DataFrame:
    return enriched(d).select(
        "transaction_id", "metric_date", "amount", "risk_score", "action", "reason_codes",
        "confirmed_chargeback_id", "chargeback_reason", "reported_at",
    )


@query
def daily_business_kpis(d: SampleDomain) -> DataFrame:
    return business_kpis(d)


@query
def daily_fraud_kpis(d: SampleDomain) -> DataFrame:
    return gold.daily_fraud_kpis(enriched(d), AS_OF)


@query
def seller_performance(d: SampleDomain) -> DataFrame:
    return gold.seller_performance(enriched(d), AS_OF)


@query
def customer_360(d: SampleDomain) -> DataFrame:
    return gold.customer_360(d.customers(), d.orders(), enriched(d), AS_OF)


# ---- serving over gold -----------------------------------------------------------


@query
def seller_watchlist(d: SampleDomain) -> DataFrame:
    return serving.seller_watchlist(gold.seller_performance(enriched(d), AS_OF))


@query
def customer_segments(d: SampleDomain) -> DataFrame:
    return serving.segment_counts(gold.customer_360(d.customers(), d.orders(), enriched(d), AS_OF))


@query
def segment_share(d: SampleDomain) -> DataFrame:
    return serving.segment_share(gold.customer_360(d.customers(), d.orders(), enriched(d), AS_OF))


@query
def headline_kpis(d: SampleDomain) -> DataFrame:
    tables = gold.gold_tables(d.customers(), d.orders(), enriched(d), AS_OF)
    return serving.headline_kpis(
        tables["daily_business_kpis"], tables["daily_fraud_kpis"],
        tables["seller_performance"], tables["customer_360"],
    )


@query
def currency_totals(d: SampleDomain) -> DataFrame:
    return serving.currency_totals(business_kpis(d))


@query
def extract_business_kpis(d: SampleDomain) -> DataFrame:
    return json_ready(business_kpis(d).drop("refreshed_at"))


@query
def extract_fraud_kpis(d: SampleDomain) -> DataFrame:
    return json_ready(gold.daily_fraud_kpis(enriched(d), AS_OF).drop("refreshed_at"))


@query
def source_row_counts(d: SampleDomain) -> DataFrame:
    payments = d.payments()
    return serving.row_counts(
        {
            "customers": d.customers(), "orders": d.orders(), "payments": payments,
            "decisions": risk.decide(payments, as_of()), "chargebacks": d.chargebacks(),
        }
    )


# ---- marketplace dimensions and facts -----------------------------------------------


MARKET_FACTS: dict[str, Callable[[SampleDomain], DataFrame]] = {
    "dim_customers": lambda d: market_silver.dim_customers(d.market("customers")),
    "dim_sellers": lambda d: market_silver.dim_sellers(d.market("sellers")),
    "dim_products": lambda d: market_silver.dim_products(
        d.market("products"), d.market("product_category_name_translation")
    ),
    "dim_geolocation_zip": lambda d: market_silver.dim_geolocation_zip(d.market("geolocation")),
    "fact_orders": lambda d: market_silver.fact_orders(d.market("orders")),
    "fact_order_items": lambda d: market_silver.fact_order_items(d.market("order_items")),
    "fact_payments": lambda d: market_silver.fact_payments(d.market("order_payments")),
    "fact_reviews": lambda d: market_silver.fact_reviews(d.market("order_reviews")),
}


def facts(d: SampleDomain, *names: str) -> list[DataFrame]:
    return [MARKET_FACTS[name](d) for name in names]


def _register_fact(name: str) -> None:
    def build(d: SampleDomain) -> DataFrame:
        return MARKET_FACTS[name](d)

    build.__name__ = name
    query(build)


for _name in MARKET_FACTS:
    if _name != "dim_geolocation_zip":
        _register_fact(_name)


def _rounded_place(frame: DataFrame) -> DataFrame:
    """Means of doubles differ in the last bits with the order of summation."""
    return frame.withColumns({c: F.round(c, 4) for c in ("latitude", "longitude")})


@query
def geolocation_candidates(d: SampleDomain) -> DataFrame:
    return _rounded_place(market_silver.geolocation_candidates(d.market("geolocation")))


@query
def dim_geolocation_zip(d: SampleDomain) -> DataFrame:
    return _rounded_place(market_silver.dim_geolocation_zip(d.market("geolocation")))


@query
def market_layer_row_counts(d: SampleDomain) -> DataFrame:
    return serving.row_counts({name: build(d) for name, build in MARKET_FACTS.items()})


# ---- marketplace gold ------------------------------------------------------------------


def market_daily(d: SampleDomain) -> DataFrame:
    return market_gold.daily_commerce_kpis(*facts(d, "fact_orders", "dim_customers", "fact_payments"))


def market_people(d: SampleDomain) -> DataFrame:
    return market_gold.customer_360(*facts(d, "fact_orders", "dim_customers", "fact_payments"))


def market_delivery(d: SampleDomain) -> DataFrame:
    return market_gold.delivery_performance(*facts(d, "fact_orders", "dim_customers"))


def market_sellers(d: SampleDomain) -> DataFrame:
    return market_gold.seller_performance(*facts(d, "dim_sellers", "fact_order_items", "fact_reviews"))


def market_signals(d: SampleDomain) -> DataFrame:
    return market_gold.payment_risk_signals(
        *facts(d, "fact_orders", "dim_customers", "fact_payments", "fact_reviews")
    )


@query
def order_payment_totals(d: SampleDomain) -> DataFrame:
    return market_gold.order_payment_totals(*facts(d, "fact_payments"))


@query
def daily_commerce_kpis(d: SampleDomain) -> DataFrame:
    return market_daily(d)


@query
def delivery_performance(d: SampleDomain) -> DataFrame:
    return market_delivery(d)


@query
def market_seller_performance(d: SampleDomain) -> DataFrame:
    return market_sellers(d)


@query
def market_customer_360(d: SampleDomain) -> DataFrame:
    return market_people(d)


@query
def payment_risk_signals(d: SampleDomain) -> DataFrame:
    return market_signals(d)


@query
def risk_band_summary(d: SampleDomain) -> DataFrame:
    return serving.risk_band_summary(market_signals(d))


@query
def top_risky_payments(d: SampleDomain) -> DataFrame:
    return serving.top_risky_payments(market_signals(d))


@query
def market_global_kpis(d: SampleDomain) -> DataFrame:
    return serving.market_global_kpis(market_daily(d), market_people(d))


@query
def daily_series(d: SampleDomain) -> DataFrame:
    return serving.daily_series(market_daily(d))


@query
def top_sellers(d: SampleDomain) -> DataFrame:
    return serving.top_sellers(market_sellers(d))


@query
def delivery_table(d: SampleDomain) -> DataFrame:
    return serving.delivery_table(market_delivery(d))


# ---- replay of the marketplace history ----------------------------------------------------


def replay(d: SampleDomain, limit: int = 0) -> Replay:
    return Replay(
        customers_file=d.market("customers"),
        orders_file=d.market("orders"),
        items_file=d.market("order_items"),
        payments_file=d.payments_with_free_orders(),
        products_file=d.market("products"),
        translation_file=d.market("product_category_name_translation"),
        sellers_file=d.market("sellers"),
        limit=limit,
    )


@query
def replay_customers(d: SampleDomain) -> DataFrame:
    return replay(d).customers()


@query
def replay_sellers(d: SampleDomain) -> DataFrame:
    return replay(d).sellers()


@query
def replay_listings(d: SampleDomain) -> DataFrame:
    return replay(d).listings()


@query
def replay_inventory(d: SampleDomain) -> DataFrame:
    return replay(d).inventory()


@query
def replay_orders(d: SampleDomain) -> DataFrame:
    return replay(d).orders()


@query
def replay_order_items(d: SampleDomain) -> DataFrame:
    return replay(d).order_items()


@query
def replay_payments(d: SampleDomain) -> DataFrame:
    return replay(d).payments()


@query
def replay_skipped_payments(d: SampleDomain) -> DataFrame:
    return replay(d).skipped_payments()


@query
def replay_unmapped(d: SampleDomain) -> DataFrame:
    """Orders in progress under a status that nobody knows: all of each in quarantine,
    nothing of it in the operational tables."""
    whole = replay(d)
    known = F.col("order_status") != "delivered"
    odd = replace(whole, orders_file=whole.orders_file.withColumn(
        "order_status", F.when(known, F.col("order_status")).otherwise("lost")))
    parts = {name: rows for name, (rows, _) in odd.quarantine().items()}
    count = lambda name, label: parts[name].groupBy("order_id").agg(F.count("*").alias(label))
    lines = odd.order_items().groupBy("order_id").agg(F.count("*").alias("kept"))
    keys = parts["unmapped_orders"].select("order_id", "order_status", odd.uuid("order", F.col("order_id")).alias("uuid"))
    return (
        keys.join(count("unmapped_order_items", "lines"), "order_id", "left")
        .join(count("unmapped_payments", "payments"), "order_id", "left")
        .join(lines.withColumnRenamed("order_id", "uuid"), "uuid", "left")
        .select(
            "order_id", "order_status",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lines", "payments", "kept")],
        )
    )


@query
def replay_order_slice(d: SampleDomain) -> DataFrame:
    """The default slice: the earliest 10,000 orders."""
    return replay(d, limit=10_000).orders().drop("total_amount")


@query
def replay_slices(d: SampleDomain) -> DataFrame:
    """Slices of one order, of half of them and of more than there are, by their order numbers."""
    orders = replay(d).all_orders()
    half = orders.count() // 2
    parts = [
        orders.filter(first_n(orders, n, "purchased_at", "order_id")).select(F.lit(name).alias("slice"), "order_id")
        for name, n in (("one", 1), ("half", half), ("all", 3 * half + 1))
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def basket_match(d: SampleDomain) -> DataFrame:
    customers = d.table("customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.greatest(F.col("c_acctbal"), F.lit(100.0)).cast("decimal(12,2)").alias("baseline"),
    )
    catalogue = d.table("part").select(
        F.col("p_partkey").alias("product_key"), F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price")
    )
    return basket.basket_match(customers, catalogue)


# ---- gates --------------------------------------------------------------------------------


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows, stored in the shared folder and read from there."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@dataclass
class Written:
    """The silver tables, the decisions and gold, each stored once, with what was observed then."""

    tables: dict[str, DataFrame]
    gold: dict[str, DataFrame]
    counts: dict[str, int]
    measures: dict[str, int]

    def operational(self) -> dict[str, DataFrame]:
        return {name: self.tables[name] for name in ("orders", "payments", "chargebacks")}


def with_stored_payments(d: SampleDomain) -> SampleDomain:
    """Payments are joined once, for all change records that are made of them."""
    return d.holding({"payments": written(d.payments(), "payments")})


def written_tables(d: SampleDomain) -> Written:
    counted, observed = Observed(), Observed()
    sources = {"customers": d.customers(), "orders": d.orders(), "payments": d.payments()}
    tables = {
        name: written(counted.watch(frame, {name: F.count("*")}), name) for name, frame in sources.items()
    }
    later = {"chargebacks": d.chargebacks_of(tables["payments"]), "decisions": risk.decide(tables["payments"], as_of())}
    tables |= {name: written(counted.watch(frame, {name: F.count("*")}), name) for name, frame in later.items()}
    enriched_rows = gold.enrich(tables["payments"], tables["decisions"], tables["chargebacks"]).select(*gold.NEEDED)
    built = gold.gold_tables(tables["customers"], tables["orders"], written(enriched_rows, "enriched"), AS_OF)
    stored = {}
    for name, frame in built.items():
        aggregates = {f"rows.{name}": F.count("*"), **verification.gold_aggregates(name)}
        stored[name] = written(observed.watch(frame, aggregates), name)
    return Written(tables, stored, counted.values(), observed.values())


@query
def gates_summary(d: SampleDomain) -> DataFrame:
    """All gates over the sample tables: before publishing, after it, and of the extract.

    Every table is written once; its counts and totals are observed on the way.
    """
    w = written_tables(d)
    payments, decisions, chargebacks = (w.tables[name] for name in ("payments", "decisions", "chargebacks"))
    log = bronze_rows(d.holding(w.operational()).payment_changes(with_faults=False), as_of())
    counts = serving.known_counts(d.spark, w.counts)
    sections = serving.extract_sections(
        w.gold["daily_business_kpis"], w.gold["daily_fraud_kpis"], w.gold["seller_performance"],
        w.gold["customer_360"], serving.refresh_summary(counts, AS_OF),
    )
    return verification.all_gates(
        verification.pre_publish_gates(payments, decisions, chargebacks),
        verification.published_gates(risk.new_payments(log), decisions, w.tables, w.gold, w.measures),
        verification.extract_gates(sections, counts),
    )


def published_document(d: SampleDomain) -> DataFrame:
    """The document as readers find it: published as JSON and read back."""
    w = written_tables(d)
    bronze = bronze_rows(d.holding(w.operational()).change_stream(), as_of())
    counts = w.counts | {
        "bronze_records": bronze.count(),
        "quarantine_records": silver.quarantine_of_all(bronze, ENTITIES, as_of()).count(),
    }
    gold_counts = {name: w.measures[f"rows.{name}"] for name in w.gold}
    lake = Lakehouse(d.spark, shared_folder(d.spark, "document"))
    publish_document(lake, w.gold, counts, gold_counts, AS_OF)
    return lake.gold.read(DOCUMENT_TABLE)


@query
def extract_document(d: SampleDomain) -> DataFrame:
    """Every value of the published document: section, place in it, field, and number or text."""
    found = published_document(d)

    def values(row: str, schema: T.StructType, prefix: str = "") -> list[Column]:
        cells = []
        for field in schema.fields:
            name, column = f"{prefix}{field.name}", F.col(f"{row}.{field.name}")
            if isinstance(field.dataType, T.StructType):
                cells += values(f"{row}.{field.name}", field.dataType, f"{name}.")
                continue
            text = isinstance(field.dataType, T.StringType)
            number = F.lit(None).cast("double") if text else column.cast("double")
            word = column if text else F.lit(None).cast("string")
            cells.append(F.struct(F.lit(name).alias("field"), number.alias("number"), word.alias("text")))
        return cells

    parts = []
    for field in found.schema.fields:
        rows = field.dataType if isinstance(field.dataType, T.ArrayType) else T.ArrayType(field.dataType)
        section = F.col(field.name) if rows is field.dataType else F.array(field.name)
        each = found.select(F.posexplode(section).alias("place", "row"))
        parts.append(
            each.select(F.lit(field.name).alias("section"), "place", F.inline(F.array(*values("row", rows.elementType))))
        )
    return reduce(DataFrame.unionByName, parts)


@query
def extract_document_gates(d: SampleDomain) -> DataFrame:
    return document.document_gates(published_document(d))


@query
def pipeline_summary(d: SampleDomain) -> DataFrame:
    """The counts of everything in one row; maps as text."""
    w = written_tables(d)
    bronze = bronze_rows(d.holding(w.operational()).change_stream(), as_of())
    rows = document.pipeline_summary(
        written(bronze.select("topic"), "topics"),
        silver.quarantine_of_all(bronze, ENTITIES, as_of()),
        w.tables["decisions"],
        w.tables, {entity.name: entity.key for entity in ENTITIES},
        w.gold, GOLD_GRAIN,
    )
    pair = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    return rows.withColumns(
        {
            field.name: F.array_join(F.transform(F.map_entries(field.name), pair), ",")
            for field in rows.schema.fields
            if isinstance(field.dataType, T.MapType)
        }
    )


@query
def unmatched_chargebacks(d: SampleDomain) -> DataFrame:
    return verification.unmatched_chargebacks(d.disputes(), d.payments())


@query
def duplicate_keys(d: SampleDomain) -> DataFrame:
    """Line numbers repeat within orders of the sample, so this gate has work to do."""
    return key_measures(d.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


# ---- keyed writes, CSV, streams ---------------------------------------------------------------


@query
def insert_absent_orders(d: SampleDomain) -> DataFrame:
    """A slice of the history is loaded, then all of it: orders of the slice stay as loaded."""

    def keyed(limit: int, label: str) -> DataFrame:
        return replay(d, limit).orders().select("order_id", "status", F.lit(label).alias("loaded_by"))

    return insert_absent(keyed(10_000, "slice"), keyed(0, "all"), ["order_id"])


@query
def upsert_customers(d: SampleDomain) -> DataFrame:
    """Average order amounts refreshed from each customer's latest event value."""
    current = d.customers().select("customer_id", "home_region", "average_order_amount")
    event_value = F.struct(F.col("value").cast("decimal(12,2)").alias("v"), "event_type")
    latest = newest_per_key(
        d.table("events").select("user_id", "ts", "event_id", event_value.alias("event")),
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
    )
    refreshed = latest.select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.upper("event.event_type").alias("home_region"),
        F.col("event.v").alias("average_order_amount"),
    )
    return upsert(current, refreshed, ["customer_id"])


@query
def status_mapping(d: SampleDomain) -> DataFrame:
    """Order and payment status of every known source status, in odd spellings, and of an unknown one."""
    known = [*ORDER_STATUS, "lost"]
    source = F.element_at(
        F.array(*(F.lit(f" {s.upper()} ") for s in known)), (F.col("o_orderkey") % len(known) + 1).cast("int")
    )
    return d.table("orders").select(
        F.col("o_orderkey").alias("order_key"),
        order_status(source).alias("status"),
        payment_status(source).alias("payment_status"),
    )


@query
def event_properties(d: SampleDomain) -> DataFrame:
    return d.table("events").select(
        "event_id", json_text("props", "$.payload.k", "$.k").try_cast("int").alias("k")
    )


def csv_copy(d: SampleDomain, tables: list[str]) -> dict[str, DataFrame]:
    folder = shared_folder(d.spark, "csv")
    for table in tables:
        write_csv(d.market(table), table, f"{folder}/{table}")
    return {table: read_csv(d.spark, table, f"{folder}/{table}", as_of()) for table in tables}


@query
def csv_reviews(d: SampleDomain) -> DataFrame:
    """Free text with quotes and line breaks survives the way through CSV."""
    return market_silver.fact_reviews(csv_copy(d, ["order_reviews"])["order_reviews"])


@query
def csv_row_counts(d: SampleDomain) -> DataFrame:
    """All nine files, strictly read, with the file each row came from."""
    raw = csv_copy(d, list(CSV_COLUMNS))
    return serving.row_counts({t: f.filter(F.col("_source_file").isNotNull()) for t, f in raw.items()})


def left_behind(lake: Lakehouse) -> DataFrame:
    """Current rows, quarantined records and decisions, by their keys and places in the log."""
    state = [
        lake.silver.read(e.name).select(
            F.lit(e.name).alias("table_name"), F.col(e.key).alias("record_key"),
            "_source_lsn", "_kafka_partition", "_kafka_offset",
        )
        for e in ENTITIES
    ]
    quarantine = lake.silver.read(pipeline.QUARANTINE).select(
        F.lit("quarantine").alias("table_name"), F.col("quarantine_id").alias("record_key"),
        F.lit(0).cast("bigint").alias("_source_lsn"),
        F.col("kafka_partition").alias("_kafka_partition"), F.col("kafka_offset").alias("_kafka_offset"),
    )
    decisions = lake.decisions.read(pipeline.DECISIONS).select(
        F.lit("decisions").alias("table_name"), F.col("decision_id").alias("record_key"),
        F.lit(0).cast("bigint").alias("_source_lsn"),
        F.lit(0).alias("_kafka_partition"), F.lit(0).cast("bigint").alias("_kafka_offset"),
    )
    return reduce(DataFrame.unionByName, [*state, quarantine, decisions])


@query
def stream_final_state(d: SampleDomain) -> DataFrame:
    """Everything the three streams leave behind for the whole change log. Runs the
    streams until the log is used up.

    Batches are bounded, so that what a batch shuffles does not grow with the log; the log is
    this query's own and goes when bronze has it.
    """
    folder = shared_folder(d.spark, "streams")
    with scoped_settings(d.spark, TIDY_SETTINGS):
        with_stored_payments(d).change_stream().write.parquet(f"{folder}/log")
    lake = Lakehouse(d.spark, folder, bound=BatchBound(bytes=2 << 30), history=1)
    ingest(lake, log_from_files(d.spark, f"{folder}/log", bound=lake.bound), drain=True).awaitTermination()
    discard(d.spark, f"{folder}/log")
    for start in (curate, decide):
        start(lake, drain=True).awaitTermination()
    return left_behind(lake)


@query
def stream_restarted(d: SampleDomain) -> DataFrame:
    """The same in bounded batches, each stream stopped in the middle and started again,
    and with every payment announced once more by a later snapshot.

    ``batches`` counts up to 4 of the stream that made the row, ``starts`` its starts.
    """
    folder = shared_folder(d.spark, "restarts")
    with scoped_settings(d.spark, TIDY_SETTINGS):
        d = with_stored_payments(d)
        log, again = d.change_stream(), d.payment_changes(with_faults=False)
        resent = again.withColumn("offset", F.col("offset") + 20_000_000).withColumn(
            "timestamp", F.col("timestamp") + F.expr("INTERVAL 2 DAYS")
        )
        for part in (log, resent):
            part.repartition(6).write.mode("append").parquet(f"{folder}/log")
    lake = Lakehouse(d.spark, folder, buckets=4, bound=BatchBound(files=3), history=1)
    records = log_from_files(d.spark, f"{folder}/log", bound=lake.bound)
    made = {"bronze": pipeline.run_twice(lambda drain: ingest(lake, records, drain))}
    discard(d.spark, f"{folder}/log")
    lake.bound = BatchBound(files=len(lake.bronze().inputFiles()) // 5 + 1)
    made["silver"] = pipeline.run_twice(lambda drain: curate(lake, drain))
    made["decisions"] = pipeline.run_twice(lambda drain: decide(lake, drain))
    stream = F.when(F.col("table_name") == "decisions", "decisions").otherwise("silver")
    batches = {name: min(4, made[name].batches, made["bronze"].batches) for name in ("silver", "decisions")}
    return left_behind(lake).withColumns(
        {
            "batches": F.when(stream == "decisions", batches["decisions"]).otherwise(batches["silver"]),
            "starts": F.when(stream == "decisions", made["decisions"].starts).otherwise(made["silver"].starts),
        }
    )
