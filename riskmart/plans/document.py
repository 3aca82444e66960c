"""The dashboard extract as one nested document, and the pipeline summary as one row."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.gates import Gate, count_measure, evaluate, key_measures, measures
from riskmart.plans.decisions import group_counts, reason_counts
from riskmart.plans.serving import segment_counts, seller_watchlist
from riskmart.sources.json_extract import IdentifierLeak, identifier_fields, json_ready

# Sections of the document, source tables counted in its metadata.
SECTIONS = (
    "metadata", "daily_business_kpis", "daily_fraud_kpis", "seller_risk_watchlist", "customer_risk_segments",
)
SOURCES = ("customers", "orders", "payments", "decisions", "chargebacks")
#: Rows of a section. Daily rows grow with the calendar and not with the data: this is three
#: hundred years of a currency each day. A section with more is an error, it is not cut.
MAX_ROWS = 110_000


class BadDocument(ValueError):
    """The document lacks a section, has one too large, or one of the wrong kind."""


def metadata(counts: Mapping[str, int], gold_counts: Mapping[str, int], as_of: datetime | str) -> Column:
    """When the gold tables were made, and the rows of all tables.

    ``counts`` has bronze_records, quarantine_records and the tables of ``SOURCES``.
    """
    instant = F.date_format(F.lit(as_of).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX")
    number = lambda n: F.lit(n).cast("bigint")
    return F.struct(
        instant.alias("refreshed_at"),
        *(number(counts[name]).alias(name) for name in ("bronze_records", "quarantine_records")),
        *(number(counts[name]).alias(f"source_{name}") for name in SOURCES),
        F.struct(*(number(n).alias(name) for name, n in sorted(gold_counts.items()))).alias("gold_row_counts"),
    )


def _rows(frame: DataFrame) -> Column:
    """All rows as one sorted array, as a scalar sub-query."""
    return frame.agg(F.sort_array(F.collect_list(F.struct(*frame.columns)))).scalar()


def dashboard_document(
    gold: Mapping[str, DataFrame], counts: Mapping[str, int], gold_counts: Mapping[str, int], as_of: datetime | str
) -> DataFrame:
    """One row with the five sections; ``gold_counts`` are the known sizes of the gold tables."""
    for name in ("daily_business_kpis", "daily_fraud_kpis"):
        if gold_counts[name] > MAX_ROWS:
            raise BadDocument(f"{name} has {gold_counts[name]} rows, a document holds {MAX_ROWS}")
    parts = {
        "daily_business_kpis": gold["daily_business_kpis"].drop("refreshed_at"),
        "daily_fraud_kpis": gold["daily_fraud_kpis"].drop("refreshed_at"),
        "seller_risk_watchlist": seller_watchlist(gold["seller_performance"]),
        "customer_risk_segments": segment_counts(gold["customer_360"]),
    }
    spark = gold["daily_business_kpis"].sparkSession
    return spark.range(1).select(
        metadata(counts, gold_counts, as_of).alias("metadata"),
        *(_rows(json_ready(frame)).alias(name) for name, frame in parts.items()),
    )


def check_contract(schema: T.StructType) -> None:
    """All sections are there and of their kind, and no field at any depth is an identifier."""
    kinds = {field.name: field.dataType for field in schema.fields}
    missing = [name for name in SECTIONS if name not in kinds]
    if missing:
        raise BadDocument(f"sections are missing: {', '.join(missing)}")
    for name in SECTIONS:
        kind = kinds[name] if name == "metadata" else getattr(kinds[name], "elementType", None)
        if not isinstance(kind, T.StructType):
            raise BadDocument(f"{name} holds no rows")
    leaks = identifier_fields(schema)
    if leaks:
        raise IdentifierLeak(f"identifier fields in the extract: {', '.join(leaks)}")


DOCUMENT = (
    Gate("document_payments_reconcile", "source_payments", "payments"),
    Gate("document_decisions_reconcile", "source_decisions", "decisions"),
    Gate("document_customers_reconcile", "source_customers", "customers"),
    Gate("document_has_no_identifiers", 0, "identifiers"),
    Gate("document_has_all_sections", len(SECTIONS), "sections"),
)


def document_gates(document: DataFrame) -> DataFrame:
    """What the document says must equal what its metadata counts."""
    total = lambda section, name: F.max(
        F.aggregate(section, F.lit(0).cast("bigint"), lambda sum_, row: sum_ + row[name].cast("bigint"))
    )
    found = measures(
        document,
        payments=total("daily_business_kpis", "payment_count"),
        decisions=total("daily_fraud_kpis", "total_decisions"),
        customers=total("customer_risk_segments", "count"),
        **{f"source_{n}": F.max(f"metadata.source_{n}") for n in ("payments", "decisions", "customers")},
        identifiers=F.max(F.lit(len(identifier_fields(document.schema)))),
        sections=F.max(F.lit(sum(name in document.columns for name in SECTIONS))),
    )
    return evaluate([found], DOCUMENT)


def _counts(frame: DataFrame, key: str) -> Column:
    """(key, count) rows as a map in the order of its keys; few rows by their meaning."""
    pairs = F.sort_array(F.collect_list(F.struct(key, "count")))
    return frame.agg(F.map_from_entries(pairs)).scalar()


def pipeline_summary(
    bronze: DataFrame,
    quarantine: DataFrame,
    decisions: DataFrame,
    silver: Mapping[str, DataFrame],
    silver_keys: Mapping[str, str],
    gold: Mapping[str, DataFrame],
    gold_keys: Mapping[str, tuple[str, ...]],
) -> DataFrame:
    """One row with the counts of everything: records, topics, actions, reasons, tables, duplicates.

    Each table is looked at once, reduced on its keys.
    """
    keyed = [key_measures(decisions, "decisions", ["decision_id"]), count_measure(bronze, "bronze.rows")]
    keyed += [count_measure(quarantine, "quarantine.rows")]
    keyed += [key_measures(silver[name], f"silver.{name}", [key]) for name, key in silver_keys.items()]
    keyed += [key_measures(gold[name], f"gold.{name}", keys) for name, keys in gold_keys.items()]
    table = keyed[0]
    for more in keyed[1:]:
        table = table.unionByName(more)
    numbers = table.agg(F.map_from_entries(F.collect_list(F.struct("measure", "value"))).alias("n"))

    def all_of(layer: str, names, what: str) -> Column:
        pairs = (x for name in sorted(names) for x in (F.lit(name), F.col("n")[f"{layer}.{name}.{what}"]))
        return F.create_map(*pairs)

    return numbers.select(
        F.col("n")["bronze.rows"].alias("bronze_records"),
        _counts(group_counts(bronze, "topic"), "topic").alias("topic_counts"),
        F.col("n")["decisions.rows"].alias("fraud_decisions"),
        _counts(group_counts(decisions, "action"), "action").alias("action_counts"),
        _counts(reason_counts(decisions), "reason").alias("reason_counts"),
        F.col("n")["decisions.duplicates"].alias("duplicate_decision_ids"),
        all_of("silver", silver_keys, "rows").alias("silver_counts"),
        all_of("silver", silver_keys, "duplicates").alias("silver_duplicate_keys"),
        all_of("gold", gold_keys, "rows").alias("gold_counts"),
        all_of("gold", gold_keys, "duplicates").alias("gold_duplicate_keys"),
        gold["daily_business_kpis"].agg(F.max("refreshed_at")).scalar().alias("gold_refreshed_at"),
        F.col("n")["quarantine.rows"].alias("quarantine_records"),
    )
