"""What dashboards read: totals, series, rankings and the identifier-free extract."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.functions.values import percent
from riskmart.operators.observed import measure_rows

WATCHLIST_SIZE = 8
TOP_SELLERS = 25
TOP_PAYMENTS = 100
SEGMENTS = ("LOW", "MEDIUM", "HIGH")


# ---- marketplace dashboards ----------------------------------------------------


def market_global_kpis(daily: DataFrame, people: DataFrame) -> DataFrame:
    """Totals of the daily table, with the number of people as a scalar sub-query."""
    orders, revenue = F.sum("order_count"), F.sum("revenue_brl")
    population = people.agg(F.count(F.lit(1))).scalar()
    return daily.agg(
        orders.alias("orders"),
        F.round(revenue, 2).alias("revenue_brl"),
        F.round(revenue / orders, 2).alias("average_order_value_brl"),
        F.round(F.lit(100.0) * F.sum("delivered_orders") / orders, 2).alias("delivered_pct"),
    ).select(
        "orders", population.alias("unique_customers"), "revenue_brl",
        "average_order_value_brl", "delivered_pct",
    )


def daily_series(daily: DataFrame) -> DataFrame:
    return daily.select("order_date", "order_count", "revenue_brl", "average_order_value_brl").orderBy("order_date")


def risk_band_summary(signals: DataFrame) -> DataFrame:
    severity = F.when(F.col("risk_band") == "HIGH", 1).when(F.col("risk_band") == "MEDIUM", 2).otherwise(3)
    return (
        signals.groupBy("risk_band")
        .agg(
            F.count(F.lit(1)).alias("payments"),
            F.round(F.sum("payment_value_brl"), 2).alias("payment_value_brl"),
            F.round(F.avg("risk_score"), 2).alias("average_risk_score"),
        )
        .orderBy(severity)
    )


def top_sellers(sellers: DataFrame, size: int = TOP_SELLERS) -> DataFrame:
    """Best sellers by value; equal values rank by seller id, which is not shown."""
    return (
        sellers.orderBy(F.col("merchandise_value_brl").desc(), "seller_id")
        .limit(size)
        .select("state", "city", "orders", "merchandise_value_brl", "average_review_score")
    )


def delivery_table(delivery: DataFrame) -> DataFrame:
    return delivery.select(
        "customer_state", "delivered_orders", "average_delivery_days", "on_time_delivery_pct"
    ).orderBy(F.col("delivered_orders").desc(), "customer_state")


def top_risky_payments(signals: DataFrame, size: int = TOP_PAYMENTS) -> DataFrame:
    shown = (
        "order_id", "purchased_at", "payment_type", "payment_value_brl",
        "risk_score", "risk_band", "reason_codes", "label_status",
    )
    return (
        signals.filter(F.col("risk_band").isin("HIGH", "MEDIUM"))
        .orderBy(
            F.col("risk_score").desc(), F.col("payment_value_brl").desc(), "order_id", "payment_sequence"
        )
        .limit(size)
        .select(*shown)
    )


# ---- extract of the gold tables --------------------------------------------------


def seller_watchlist(sellers: DataFrame, size: int = WATCHLIST_SIZE) -> DataFrame:
    """Riskiest sellers as ranks without identifiers.

    The top rows are cut first, so the ranking window sees ``size`` rows only.
    """
    order = [
        F.col("confirmed_chargeback_count").desc(),
        F.col("flagged_rate_pct").desc(),
        F.col("gross_payment_value").desc(),
        F.col("seller_id"),
    ]
    top = sellers.orderBy(*order).limit(size)
    ranked = top.withColumn("seller_rank", F.row_number().over(Window.orderBy(*order)))
    hidden = ("seller_id", "latest_payment_at", "refreshed_at")
    return ranked.select("seller_rank", *(c for c in sellers.columns if c not in hidden))


def segment_counts(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_risk_segment").agg(F.count(F.lit(1)).alias("count"))


def segment_share(customers: DataFrame) -> DataFrame:
    """All three segments, also the empty ones, with their share of the customers."""
    found = customers.agg(
        *(F.count_if(F.col("customer_risk_segment") == s).alias(s) for s in SEGMENTS),
        F.count(F.lit(1)).alias("_all"),
    )
    rows = F.array(
        *(F.struct(F.lit(s).alias("customer_risk_segment"), F.col(s).alias("count")) for s in SEGMENTS)
    )
    share = F.coalesce(percent(F.col("count"), F.nullif("_all", F.lit(0))), F.lit(0.0))
    return found.select("_all", F.inline(rows)).select(
        "customer_risk_segment", "count", share.alias("share_pct")
    )


def headline_kpis(business: DataFrame, fraud: DataFrame, sellers: DataFrame, customers: DataFrame) -> DataFrame:
    """One row of totals over the four gold tables.

    Amounts of different currencies are added up as they are; ``currencies`` tells how many.
    """
    sums = business.agg(
        F.sum("payment_count").alias("payment_count"),
        F.sum("gross_payment_value").alias("gross_payment_value"),
        F.sum("chargeback_count").alias("chargeback_count"),
        F.countDistinct("currency").alias("currencies"),
    )
    decided = F.sum("total_decisions")
    risk = fraud.agg(
        decided.alias("total_decisions"),
        F.sum("approved_count").alias("approved_count"),
        F.sum("review_count").alias("review_count"),
        F.sum("declined_count").alias("declined_count"),
        F.sum("review_amount").alias("review_amount"),
        F.sum("declined_amount").alias("declined_amount"),
        F.sum("confirmed_fraud_amount").alias("confirmed_fraud_amount"),
        F.round(
            F.sum(F.col("average_risk_score").cast("double") * F.col("total_decisions")) / decided, 2
        ).alias("average_risk_score"),
    )
    people = customers.agg(F.count(F.lit(1)).alias("current_customers"))
    active = sellers.agg(F.count(F.lit(1)).alias("active_sellers"))
    # Four one-row results, stacked and folded into one row.
    stacked = reduce(
        lambda upper, lower: upper.unionByName(lower, allowMissingColumns=True), (sums, risk, people, active)
    )
    joined = stacked.agg(*(F.max(name).alias(name) for name in stacked.columns))
    flagged = F.col("review_count") + F.col("declined_count")
    return joined.withColumns(
        {
            "flagged_rate_pct": percent(flagged, F.col("total_decisions")),
            "chargeback_rate_pct": percent(F.col("chargeback_count"), F.col("payment_count")),
        }
    )


def currency_totals(business: DataFrame) -> DataFrame:
    """The same business totals without mixing currencies."""
    return business.groupBy("currency").agg(
        F.sum("payment_count").alias("payment_count"),
        F.sum("gross_payment_value").alias("gross_payment_value"),
        F.sum("chargeback_count").alias("chargeback_count"),
        F.sum("chargeback_amount").alias("chargeback_amount"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count); each table sends one number."""
    counts = (
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)


def known_counts(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The same for numbers that were taken while the tables were written."""
    return measure_rows(spark, counts).toDF("table_name", "row_count")


def refresh_summary(counts: DataFrame, as_of: datetime | str) -> DataFrame:
    """The metadata block: one row, one column per counted table."""
    return counts.groupBy().agg(
        F.lit(as_of).cast("timestamp").alias("refreshed_at"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("table_name", "row_count")))).alias("row_counts"),
    )


def extract_sections(
    business: DataFrame, fraud: DataFrame, sellers: DataFrame, customers: DataFrame, summary: DataFrame
) -> dict[str, DataFrame]:
    return {
        "metadata": summary,
        "daily_business_kpis": business.drop("refreshed_at"),
        "daily_fraud_kpis": fraud.drop("refreshed_at"),
        "seller_risk_watchlist": seller_watchlist(sellers),
        "customer_risk_segments": segment_counts(customers),
    }
