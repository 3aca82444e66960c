"""Typed marketplace dimensions and facts from the all-text files.

Text that does not parse becomes NULL instead of stopping the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.values import (
    blank_to_null, instant, integer, lower_trim, money, real, upper_trim,
)
from riskmart.operators.latest import newest_per_key
from riskmart.operators.spread import spread_join


def _place(prefix: str):
    return (
        integer(f"{prefix}_zip_code_prefix").alias("zip_code_prefix"),
        lower_trim(f"{prefix}_city").alias("city"),
        upper_trim(f"{prefix}_state").alias("state"),
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    known = customers.dropna(subset=["customer_id", "customer_unique_id"])
    return known.select("customer_id", "customer_unique_id", *_place("customer")).distinct()


def dim_sellers(sellers: DataFrame) -> DataFrame:
    known = sellers.dropna(subset=["seller_id"])
    return known.select("seller_id", *_place("seller")).distinct()


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Category in English where a translation exists, else as given, else ``unknown``.

    Products are made distinct before the lookup, so the join sees each product once.
    A category that holds many of the products is split.
    """
    typed = (
        products.dropna(subset=["product_id"])
        .select(
            "product_id",
            "product_category_name",
            integer("product_name_lenght").alias("name_length"),
            integer("product_description_lenght").alias("description_length"),
            integer("product_photos_qty").alias("photo_count"),
            *(
                real(f"product_{measure}").alias(measure)
                for measure in ("weight_g", "length_cm", "height_cm", "width_cm")
            ),
        )
        .distinct()
    )
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    measures = [c for c in typed.columns if c not in ("product_id", "product_category_name")]
    return (
        spread_join(typed, translation, "product_category_name", ["product_id"])
        .select("product_id", category.alias("category"), *measures)
        .distinct()
    )


def geolocation_candidates(geolocation: DataFrame) -> DataFrame:
    """Mean position and number of points per (zip, city, state)."""
    known = geolocation.dropna(subset=["geolocation_zip_code_prefix"])
    return known.groupBy(*_place("geolocation")).agg(
        F.avg(real("geolocation_lat")).alias("latitude"),
        F.avg(real("geolocation_lng")).alias("longitude"),
        F.count(F.lit(1)).alias("point_count"),
    )


def dim_geolocation_zip(geolocation: DataFrame) -> DataFrame:
    """The place with most points stands for its zip; ties go to the first state, then city."""
    choice = F.struct(
        (-F.col("point_count")).alias("by_points"), "state", "city",
    )
    place = F.struct("city", "state", "latitude", "longitude", "point_count")
    return (
        geolocation_candidates(geolocation)
        .groupBy("zip_code_prefix")
        .agg(F.min_by(place, choice).alias("_place"))
        .select("zip_code_prefix", "_place.*")
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    moments = {
        "order_purchase_timestamp": "purchased_at",
        "order_approved_at": "approved_at",
        "order_delivered_carrier_date": "carrier_received_at",
        "order_delivered_customer_date": "delivered_at",
        "order_estimated_delivery_date": "estimated_delivery_at",
    }
    known = orders.dropna(subset=["order_id", "customer_id", "order_purchase_timestamp"])
    return known.select(
        "order_id",
        "customer_id",
        lower_trim("order_status").alias("order_status"),
        *(instant(source).alias(name) for source, name in moments.items()),
    ).distinct()


def fact_order_items(items: DataFrame) -> DataFrame:
    return items.dropna(subset=["order_id", "product_id", "seller_id"]).select(
        "order_id",
        integer("order_item_id").alias("order_item_id"),
        "product_id",
        "seller_id",
        instant("shipping_limit_date").alias("shipping_limit_at"),
        money(F.col("price")).alias("item_value_brl"),
        money(F.col("freight_value")).alias("freight_value_brl"),
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    value = money(F.col("payment_value"))
    return payments.filter(F.col("order_id").isNotNull() & (value >= 0)).select(
        "order_id",
        integer("payment_sequential").alias("payment_sequence"),
        upper_trim("payment_type").alias("payment_type"),
        integer("payment_installments").alias("installments"),
        value.alias("payment_value_brl"),
    )


def fact_reviews(reviews: DataFrame) -> DataFrame:
    """Latest version of each review of an order.

    Versions from one load share their load time; the later answer then decides, and
    after that the values themselves, so that the choice never depends on row order.
    """
    typed = reviews.dropna(subset=["review_id", "order_id"]).select(
        "review_id",
        "order_id",
        integer("review_score").alias("review_score"),
        blank_to_null(F.col("review_comment_title")).alias("review_title"),
        blank_to_null(F.col("review_comment_message")).alias("review_message"),
        instant("review_creation_date").alias("review_created_at"),
        instant("review_answer_timestamp").alias("review_answered_at"),
        "_ingested_at",
    )
    order = [
        F.col(name)
        for name in (
            "_ingested_at", "review_answered_at", "review_created_at",
            "review_score", "review_title", "review_message",
        )
    ]
    return newest_per_key(typed, ["review_id", "order_id"], order).drop("_ingested_at")
