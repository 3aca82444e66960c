"""Runnable jobs: ``python -m riskmart.jobs <job> --root <folder> ...``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.contracts import CSV_COLUMNS, DECISION_DDL, ENTITIES, GOLD_GRAIN, schema_of
from riskmart.operators.gates import require
from riskmart.operators.observed import Observed
from riskmart.plans import document, gold, market_gold, market_silver, serving, verification
from riskmart.plans.decisions import new_payments
from riskmart.plans.replay import Replay
from riskmart.session import build_session
from riskmart.sources.change_log import BatchBound, bronze_stream, log_from_files, log_from_kafka
from riskmart.sources.csv_snapshot import read_csv
from riskmart.sources.json_extract import publish_extract
from riskmart.sources.snapshot_store import SnapshotStore
from riskmart.sources.stream_table import StreamTables
from riskmart.streaming import pipeline

DOCUMENT_TABLE = "dashboard_document"


class Lakehouse:
    """Folders of one installation under ``root``."""

    def __init__(
        self, spark: SparkSession, root: str, buckets: int = 16, bound: BatchBound = BatchBound(),
        horizon: str | None = None, history: int | None = None,
    ):
        self.spark = spark
        self.bound = bound
        self.horizon = horizon
        self.root = root.rstrip("/")
        self.bronze_folder = f"{self.root}/bronze"
        self.silver = SnapshotStore(spark, f"{self.root}/silver", buckets, history)
        self.decisions = StreamTables(
            spark, f"{self.root}/decisions", {pipeline.DECISIONS: schema_of(DECISION_DDL)}
        )
        self.gold = SnapshotStore(spark, f"{self.root}/gold")
        self.market = SnapshotStore(spark, f"{self.root}/market")
        self.replay = SnapshotStore(spark, f"{self.root}/replay", buckets)

    def checkpoint(self, stream: str) -> str:
        return f"{self.root}/checkpoints/{stream}"

    def bronze(self) -> DataFrame:
        return self.spark.read.parquet(self.bronze_folder)


def ingest(lake: Lakehouse, records: DataFrame, drain: bool = False):
    return pipeline.start_bronze(records, lake.bronze_folder, lake.checkpoint("bronze"), drain)


def curate(lake: Lakehouse, drain: bool = False):
    bronze = bronze_stream(lake.spark, lake.bronze_folder, lake.bound)
    return pipeline.start_silver(bronze, lake.silver, lake.checkpoint("silver"), drain)


def decide(lake: Lakehouse, drain: bool = False):
    bronze = bronze_stream(lake.spark, lake.bronze_folder, lake.bound)
    folder = lake.decisions.folder(pipeline.DECISIONS)
    return pipeline.start_decisions(bronze, folder, lake.checkpoint("decisions"), drain, lake.horizon)


def refresh_gold(lake: Lakehouse, as_of: datetime | None = None) -> None:
    """Check the inputs, build the four tables and the extract, publish each set at once.

    Totals of the gold tables are observed while they are written, and all gates pass
    before readers see them.
    """
    as_of = as_of or datetime.now(timezone.utc)
    silver = {entity.name: lake.silver.read(entity.name) for entity in ENTITIES}
    decisions = lake.decisions.read(pipeline.DECISIONS)
    payments, chargebacks = silver["payments"], silver["chargebacks"]
    require(verification.pre_publish_gates(payments, decisions, chargebacks))

    enriched = gold.enrich(payments, decisions, chargebacks).select(*gold.NEEDED)
    # Four aggregates read it; a lost block is joined again from the silver files.
    enriched = enriched.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables, observed = gold.gold_tables(silver["customers"], silver["orders"], enriched, as_of), Observed()
        watched = {
            name: observed.watch(frame, {f"rows.{name}": F.count("*"), **verification.gold_aggregates(name)})
            for name, frame in tables.items()
        }

        def reconciled(written: dict[str, DataFrame]) -> None:
            log = new_payments(lake.bronze())
            require(verification.published_gates(log, decisions, silver, written, observed.values()))

        lake.gold.publish(watched, check=reconciled)
    finally:
        enriched.unpersist()

    published = {name: lake.gold.read(name) for name in GOLD_GRAIN}
    sources = {
        "bronze_records": lake.bronze(),
        "quarantine_records": lake.silver.read(pipeline.QUARANTINE),
        **silver,
        "decisions": decisions,
    }
    counts = {r.table_name: r.row_count for r in serving.row_counts(sources).collect()}
    gold_counts = {name: observed.values()[f"rows.{name}"] for name in GOLD_GRAIN}
    publish_document(lake, published, counts, gold_counts, as_of)
    known = serving.known_counts(lake.spark, {**counts, **{f"gold_{n}": rows for n, rows in gold_counts.items()}})
    sections = serving.extract_sections(
        published["daily_business_kpis"], published["daily_fraud_kpis"],
        published["seller_performance"], published["customer_360"],
        serving.refresh_summary(known, as_of),
    )
    require(verification.extract_gates(sections, known))
    publish_extract(lake.gold, sections)


def publish_document(
    lake: Lakehouse, published: dict[str, DataFrame], counts: dict[str, int], gold_counts: dict[str, int],
    as_of: datetime,
) -> None:
    """One JSON document; its contract is checked before it is written and its sums before
    readers are switched to it, all sections at once."""
    whole = document.dashboard_document(published, counts, gold_counts, as_of)
    document.check_contract(whole.schema)
    check = lambda found: require(document.document_gates(found[DOCUMENT_TABLE]))
    lake.gold.publish({DOCUMENT_TABLE: whole.coalesce(1)}, file_format="json", check=check)


def verify(lake: Lakehouse) -> DataFrame:
    """All gates over the published tables, as rows."""
    silver = {entity.name: lake.silver.read(entity.name) for entity in ENTITIES}
    decisions = lake.decisions.read(pipeline.DECISIONS)
    published = {name: lake.gold.read(name) for name in GOLD_GRAIN}
    return verification.all_gates(
        verification.pre_publish_gates(silver["payments"], decisions, silver["chargebacks"]),
        verification.published_gates(new_payments(lake.bronze()), decisions, silver, published),
    )


def summary(lake: Lakehouse) -> DataFrame:
    """What an operator looks at, in one row."""
    return document.pipeline_summary(
        lake.bronze(),
        lake.silver.read(pipeline.QUARANTINE),
        lake.decisions.read(pipeline.DECISIONS),
        {entity.name: lake.silver.read(entity.name) for entity in ENTITIES},
        {entity.name: entity.key for entity in ENTITIES},
        {name: lake.gold.read(name) for name in GOLD_GRAIN},
        GOLD_GRAIN,
    )


def csv_path(folder: str, table: str, pattern: str) -> str:
    return f"{folder.rstrip('/')}/{pattern.format(table=table)}"


def load_market(lake: Lakehouse, folder: str, pattern: str = "{table}.csv") -> None:
    """CSV files to bronze snapshots, typed silver tables and marketplace gold.

    Each layer is written before the next reads it, so the CSV text is parsed once.
    """
    store = lake.market
    store.publish(
        {f"bronze_{t}": read_csv(lake.spark, t, csv_path(folder, t, pattern)) for t in CSV_COLUMNS}
    )
    raw = {t: store.read(f"bronze_{t}") for t in CSV_COLUMNS}
    store.publish(
        {
            "dim_customers": market_silver.dim_customers(raw["customers"]),
            "dim_sellers": market_silver.dim_sellers(raw["sellers"]),
            "dim_products": market_silver.dim_products(
                raw["products"], raw["product_category_name_translation"]
            ),
            "dim_geolocation_zip": market_silver.dim_geolocation_zip(raw["geolocation"]),
            "fact_orders": market_silver.fact_orders(raw["orders"]),
            "fact_order_items": market_silver.fact_order_items(raw["order_items"]),
            "fact_payments": market_silver.fact_payments(raw["order_payments"]),
            "fact_reviews": market_silver.fact_reviews(raw["order_reviews"]),
        }
    )
    orders, customers = store.read("fact_orders"), store.read("dim_customers")
    payments, reviews = store.read("fact_payments"), store.read("fact_reviews")
    store.publish(
        {
            "daily_commerce_kpis": market_gold.daily_commerce_kpis(orders, customers, payments),
            "delivery_performance": market_gold.delivery_performance(orders, customers),
            "seller_performance": market_gold.seller_performance(
                store.read("dim_sellers"), store.read("fact_order_items"), reviews
            ),
            "customer_360": market_gold.customer_360(orders, customers, payments),
            "payment_risk_signals": market_gold.payment_risk_signals(orders, customers, payments, reviews),
        }
    )


def load_replay(
    lake: Lakehouse, folder: str, pattern: str = "{table}.csv", limit: int = 0, **options: str
) -> dict[str, int]:
    """Operational tables of the CSV history; rows that are already there stay.

    Orders of unknown status go to a quarantine with their lines and payments. Gives the
    number of payments left out for want of a positive amount, and of unmapped orders.
    """
    files = {
        "customers_file": "customers", "orders_file": "orders", "items_file": "order_items",
        "payments_file": "order_payments", "products_file": "products",
        "translation_file": "product_category_name_translation", "sellers_file": "sellers",
    }
    # The text is parsed once; every table below reads columns of these.
    lake.replay.publish(
        {
            f"file_{t}": read_csv(lake.spark, t, csv_path(folder, t, pattern)).drop("_source_file", "_ingested_at")
            for t in files.values()
        }
    )
    frames = {name: lake.replay.read(f"file_{t}") for name, t in files.items()}
    replay = Replay(**frames, limit=limit, **options)
    quarantine = replay.quarantine()
    for table, (rows, keys) in {**replay.tables(), **quarantine}.items():
        lake.replay.add_absent(table, rows, keys)
    return {
        "skipped_payments": replay.skipped_payments().first()[0],
        "unmapped_orders": quarantine["unmapped_orders"][0].count(),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["bronze", "silver", "decisions", "gold", "verify", "market", "replay"])
    parser.add_argument("--root", required=True, help="lakehouse folder on shared storage")
    parser.add_argument("--log-folder", help="folder of record files for the bronze job")
    parser.add_argument("--kafka", help="bootstrap servers for the bronze job")
    parser.add_argument("--csv-folder", help="folder of the CSV files for market and replay")
    parser.add_argument("--csv-pattern", default="{table}.csv", help="file name of a table")
    parser.add_argument("--limit", type=int, default=0, help="orders to replay, 0 for all")
    parser.add_argument("--namespace", help="namespace text of replay identifiers")
    parser.add_argument("--buckets", type=int, default=16, help="buckets of new keyed tables")
    parser.add_argument("--batch-files", type=int, help="files a micro-batch takes at most, else bytes count")
    parser.add_argument("--batch-bytes", type=int, default=BatchBound().bytes, help="bytes a micro-batch takes at most")
    parser.add_argument("--batch-offsets", type=int, default=BatchBound().offsets, help="log records a micro-batch takes at most")
    parser.add_argument("--horizon", help="how long a payment is known to be decided, for ever by default")
    parser.add_argument("--drain", action="store_true", help="stop when the input is used up")
    args = parser.parse_args(argv)

    spark = build_session(f"riskmart-{args.job}")
    bound = BatchBound(args.batch_files, args.batch_bytes, args.batch_offsets)
    lake = Lakehouse(spark, args.root, args.buckets, bound, args.horizon)
    if args.job == "bronze":
        if args.kafka:
            log = log_from_kafka(spark, args.kafka, bound=bound)
        else:
            log = log_from_files(spark, args.log_folder, bound=bound)
        ingest(lake, log, args.drain).awaitTermination()
    elif args.job == "silver":
        curate(lake, args.drain).awaitTermination()
    elif args.job == "decisions":
        decide(lake, args.drain).awaitTermination()
    elif args.job == "gold":
        refresh_gold(lake)
    elif args.job == "verify":
        gates = verify(lake)
        gates.show(100, truncate=False)
        summary(lake).show(truncate=False, vertical=True)
        require(gates)
    elif args.job == "market":
        load_market(lake, args.csv_folder, args.csv_pattern)
    else:
        options = {"namespace": args.namespace} if args.namespace else {}
        print(load_replay(lake, args.csv_folder, args.csv_pattern, args.limit, **options))


if __name__ == "__main__":
    main()
