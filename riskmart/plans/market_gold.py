"""Marketplace KPIs and heuristic payment-risk signals.

Facts are reduced to one row per join key before they meet a dimension, so a
customer, order or seller with a third of all rows crosses the network as a few
partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.operators.scoring import BANDS, HEURISTIC_RULES, LABEL_STATUS, graded, points, reasons
from riskmart.operators.spread import hot_keys, spread_join

FAILED = ("canceled", "unavailable")
MONEY = "decimal(18,2)"


def order_payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value_brl").alias("revenue_brl"))


def _orders_with_value(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with what was paid for them, 0 when nothing was."""
    return orders.join(order_payment_totals(payments), "order_id", "left").withColumn(
        "value_brl", F.coalesce("revenue_brl", F.lit(0).cast(MONEY))
    )


def _status_is(*statuses: str) -> Column:
    return F.col("order_status").isin(*statuses)


def daily_commerce_kpis(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    per_customer_day = (
        _orders_with_value(orders, payments)
        .groupBy("customer_id", F.to_date("purchased_at").alias("order_date"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("value_brl").alias("value"),
            F.count_if(_status_is("delivered")).alias("delivered"),
            F.count_if(_status_is(*FAILED)).alias("failed"),
        )
    )
    people = customers.select("customer_id", "customer_unique_id")
    return per_customer_day.join(people, "customer_id").groupBy("order_date").agg(
        F.sum("orders").alias("order_count"),
        F.countDistinct("customer_unique_id").alias("unique_customers"),
        F.sum("value").cast(MONEY).alias("revenue_brl"),
        (F.sum("value") / F.sum("orders")).cast(MONEY).alias("average_order_value_brl"),
        F.sum("delivered").alias("delivered_orders"),
        F.sum("failed").alias("failed_orders"),
    )


def delivery_performance(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Whole hours from purchase to delivery, and the share delivered by the estimate.

    A missing estimate counts as late.
    """
    hours = F.timestamp_diff("HOUR", F.col("purchased_at"), F.col("delivered_at"))
    per_customer = (
        orders.filter(_status_is("delivered") & F.col("delivered_at").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.sum(hours).alias("hours"),
            F.count_if(F.col("delivered_at") <= F.col("estimated_delivery_at")).alias("on_time"),
        )
    )
    deliveries = F.sum("deliveries")
    return (
        per_customer.join(customers.select("customer_id", "state"), "customer_id")
        .groupBy(F.col("state").alias("customer_state"))
        .agg(
            deliveries.alias("delivered_orders"),
            F.round(F.sum("hours") / deliveries / 24.0, 2).alias("average_delivery_days"),
            F.round(F.lit(100.0) * F.sum("on_time") / deliveries, 2).alias("on_time_delivery_pct"),
        )
    )


def seller_performance(sellers: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sales of each seller, and the mean score of the orders the seller took part in.

    Items are first reduced to one row per (seller, order), reviews to one per order.
    An order with very many sellers is split.
    """
    per_order = items.groupBy("seller_id", "order_id").agg(
        F.sum("item_value_brl").alias("value"), F.sum("freight_value_brl").alias("freight")
    )
    order_scores = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score"), F.count("review_score").alias("scores")
    )
    sales = (
        spread_join(per_order, order_scores, "order_id", ["seller_id"])
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("value").cast(MONEY).alias("merchandise_value_brl"),
            F.sum("freight").cast(MONEY).alias("freight_value_brl"),
            F.sum("score").alias("score"),
            F.sum("scores").alias("scores"),
        )
    )
    mean_score = F.round(F.col("score") / F.nullif("scores", F.lit(0)), 2)
    return sellers.select("seller_id", "city", "state").join(sales, "seller_id").select(
        "seller_id", "city", "state", "orders", "merchandise_value_brl", "freight_value_brl",
        mean_score.alias("average_review_score"),
    )


def customer_360(orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Lifetime view per person; the files give every order its own customer id."""
    per_account = (
        _orders_with_value(
            orders.select("order_id", "customer_id", "purchased_at", "order_status").distinct(), payments
        )
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.min("purchased_at").alias("first_order_at"),
            F.max("purchased_at").alias("latest_order_at"),
            F.sum("value_brl").alias("value"),
            F.count_if(_status_is(*FAILED)).alias("failed"),
        )
    )
    people = customers.select("customer_id", "customer_unique_id", "state")
    return per_account.join(people, "customer_id").groupBy("customer_unique_id").agg(
        F.max("state").alias("state"),
        F.sum("orders").alias("order_count"),
        F.min("first_order_at").alias("first_order_at"),
        F.max("latest_order_at").alias("latest_order_at"),
        F.sum("value").cast(MONEY).alias("lifetime_value_brl"),
        (F.sum("value") / F.sum("orders")).cast(MONEY).alias("average_order_value_brl"),
        F.sum("failed").alias("failed_orders"),
    )


def payment_context(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Each distinct payment with its order, its person, the order's best review and
    the person's mean payment.

    Identical payments of one order count once. A window for the mean would bring all
    payments of a person to one task. Here payments are summed per order, orders per
    person, and the mean travels back the same way; payments themselves are joined
    once, at the end. The distinct steps shuffle all their columns, so Spark reuses
    their exchanges wherever they are read again, also to look for hot keys. That takes the
    same filters for all readers: rows without a key are left out before, and persons are
    told from none after the mean, where a join would ask for that below one reader only.
    """
    placed = (
        orders.select("order_id", "customer_id", "purchased_at", "order_status")
        .where(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull())
        .distinct()
    )
    people = customers.select("customer_id", "customer_unique_id").where(F.col("customer_id").isNotNull()).distinct()
    order_people = (
        spread_join(placed, people, "customer_id", ["order_id"], "inner", hot=hot_keys(placed, "customer_id"))
        .drop("customer_id")
        .distinct()
    )
    tender_key = ["payment_sequence", "payment_type", "installments", "payment_value_brl"]
    tenders = payments.select("order_id", *tender_key).where(F.col("order_id").isNotNull()).distinct()
    order_totals = tenders.groupBy("order_id").agg(
        F.sum("payment_value_brl").alias("total"), F.count("payment_value_brl").alias("tenders")
    )
    mean = (F.sum("total") / F.sum("tenders")).cast("decimal(22,6)")
    person = F.col("customer_unique_id")
    person_mean = (
        order_people.join(order_totals, "order_id")
        .groupBy(F.coalesce(person, F.lit("")).alias("_person"), person.isNull().alias("_none"))
        .agg(mean.alias("customer_average_brl"), F.count(person).alias("_named"))
        .where("_named > 0")
        .select(F.col("_person").alias("customer_unique_id"), "customer_average_brl")
    )
    best_review = reviews.groupBy("order_id").agg(F.max("review_score").alias("review_score"))
    order_side = spread_join(
        order_people, person_mean, "customer_unique_id", ["order_id", "purchased_at", "order_status"],
        hot=hot_keys(people, "customer_unique_id"),
    ).join(best_review, "order_id", "left")
    return spread_join(tenders, order_side, "order_id", tender_key, "inner", hot=hot_keys(payments, "order_id"))


def payment_risk_signals(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Triage signals. There is no fraud label in this data, and the rows say so."""
    context = payment_context(orders, customers, payments, reviews)
    score = points(HEURISTIC_RULES)
    return context.select(
        "order_id", "customer_unique_id", "purchased_at", "order_status", "payment_sequence",
        "payment_type", "installments", "payment_value_brl", "customer_average_brl", "review_score",
        score.alias("risk_score"),
        reasons(HEURISTIC_RULES).alias("reason_codes"),
        graded(score, BANDS).alias("risk_band"),
        F.lit(LABEL_STATUS).alias("label_status"),
    )
