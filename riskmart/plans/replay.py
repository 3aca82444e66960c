"""Marketplace history as operational tables, ready to be loaded.

Every key becomes a name-based UUID, so replaying the same or an overlapping slice
produces the same rows and conflict-safe inserts add nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskmart.functions.identity import DEFAULT_NAMESPACE, entity_uuid, listing_key
from riskmart.functions.values import blank_to_null, instant, integer, mean_half_even, or_unknown
from riskmart.operators.first_n import first_n
from riskmart.operators.spread import spread_join

# Source order status -> operational order status.
ORDER_STATUS = {
    "approved": "PAYMENT_PENDING",
    "canceled": "CANCELLED",
    "created": "CREATED",
    "delivered": "DELIVERED",
    "invoiced": "PAYMENT_PENDING",
    "processing": "PAYMENT_PENDING",
    "shipped": "SHIPPED",
    "unavailable": "FAILED",
}
# Statuses whose payments failed, account age at the first purchase,
# stock per listing, seller tier, currency.
DECLINED_STATUSES = ("canceled", "unavailable")
ACCOUNT_LEAD = "INTERVAL 30 DAYS"
INITIAL_STOCK = 1_000_000
SELLER_TIER = "LOW"
CURRENCY = "BRL"

# Sums keep six decimals; rounding to cents happens once, at the end, half to even.
EXACT = "decimal(20,6)"


def order_status(source: Column) -> Column:
    """Operational status, NULL for a status that is not known."""
    pairs = [F.lit(text) for pair in ORDER_STATUS.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(source)))


def payment_status(source: Column) -> Column:
    return F.when(F.lower(F.trim(source)).isin(*DECLINED_STATUSES), "DECLINED").otherwise("AUTHORIZED")


def payment_type(source: Column) -> Column:
    return or_unknown(F.replace(F.upper(F.trim(source)), F.lit(" "), F.lit("_")))


def exact(name: str) -> Column:
    return F.col(name).try_cast(EXACT)


def order_slice(orders: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` orders by purchase time, all of them for 0."""
    if limit < 0:
        raise ValueError("limit must be 0 (all orders) or positive")
    return orders.filter(first_n(orders, limit, "purchased_at", "order_id")) if limit else orders


@dataclass
class Replay:
    """The operational tables of one slice of the all-text marketplace files."""

    customers_file: DataFrame
    orders_file: DataFrame
    items_file: DataFrame
    payments_file: DataFrame
    products_file: DataFrame
    translation_file: DataFrame
    sellers_file: DataFrame
    limit: int = 0
    namespace: str = DEFAULT_NAMESPACE
    device_prefix: str = "trusted-"
    skipped: Observation | None = field(default=None)
    _selected: DataFrame | None = field(default=None, init=False, repr=False)

    def uuid(self, entity: str, key: Column) -> Column:
        return entity_uuid(entity, key, self.namespace)

    # ---- building blocks ---------------------------------------------------------

    def all_orders(self) -> DataFrame:
        return self.orders_file.select(
            "order_id",
            "customer_id",
            "order_status",
            instant("order_purchase_timestamp").alias("purchased_at"),
            instant("order_approved_at").alias("approved_at"),
        )

    def selected_orders(self) -> DataFrame:
        if self._selected is None:  # the end of the slice is looked for once
            self._selected = order_slice(self.all_orders(), self.limit)
        return self._selected

    def in_slice(self, rows: DataFrame) -> DataFrame:
        """Rows of the selected orders; a full replay needs no join for that."""
        if not self.limit:
            return rows
        return rows.join(self.selected_orders().select("order_id"), "order_id", "left_semi")

    def accounts(self) -> DataFrame:
        """Per-order customer id -> person and region."""
        return self.customers_file.select(
            "customer_id", "customer_unique_id", F.col("customer_state").alias("region")
        ).distinct()

    def order_totals(self) -> DataFrame:
        """Paid per order, over all orders."""
        return self.payments_file.groupBy("order_id").agg(F.sum(exact("payment_value")).alias("paid"))

    def person_stats(self) -> DataFrame:
        """First purchase and mean paid order of every person, over all orders.

        Orders shrink to one row per account before they meet the accounts.
        """
        per_account = (
            self.all_orders()
            .join(self.order_totals(), "order_id", "left")
            .groupBy("customer_id")
            .agg(
                F.min("purchased_at").alias("first_purchase"),
                F.sum("paid").alias("paid"),
                F.count("paid").alias("paid_orders"),
            )
        )
        stats = (
            per_account.join(self.accounts(), "customer_id")
            .groupBy("customer_unique_id")
            .agg(
                F.min("first_purchase").alias("first_purchase"),
                F.sum("paid").alias("paid"),
                F.sum("paid_orders").alias("paid_orders"),
            )
        )
        average = F.when(F.col("paid_orders") > 0, mean_half_even(F.col("paid"), F.col("paid_orders")))
        return stats.select(
            "customer_unique_id",
            (F.col("first_purchase") - F.expr(ACCOUNT_LEAD)).alias("account_created_at"),
            F.coalesce(average, F.lit(0).cast("decimal(18,2)")).alias("average_order_amount"),
        )

    def order_people(self) -> DataFrame:
        """Selected orders with the person and region of their account."""
        return spread_join(self.selected_orders(), self.accounts(), "customer_id", ["order_id"], "inner")

    def selected_items(self) -> DataFrame:
        items = self.items_file.select(
            "order_id", integer("order_item_id").alias("item_number"), "product_id", "seller_id",
            exact("price").alias("price"), exact("freight_value").alias("freight"),
        )
        return self.in_slice(items)

    # ---- dimensions ----------------------------------------------------------------

    def customers(self) -> DataFrame:
        states = self.customers_file.groupBy("customer_unique_id").agg(
            F.min_by("customer_state", "customer_id").alias("region")
        )
        people = states.join(self.person_stats(), "customer_unique_id")
        if self.limit:
            chosen = self.order_people().select("customer_unique_id").distinct()
            people = people.join(chosen, "customer_unique_id", "left_semi")
        person = F.col("customer_unique_id")
        return people.select(
            self.uuid("customer", person).alias("customer_id"),
            or_unknown(F.col("region")).alias("home_region"),
            "account_created_at",
            "average_order_amount",
            F.concat(F.lit(self.device_prefix), person).alias("trusted_device_id"),
        )

    def sellers(self) -> DataFrame:
        active = self.selected_items().select("seller_id").distinct()
        return self.sellers_file.join(active, "seller_id", "left_semi").select(
            self.uuid("seller", F.col("seller_id")).alias("seller_id"),
            or_unknown(F.col("seller_state")).alias("seller_region"),
            F.lit(SELLER_TIER).alias("risk_tier"),
        ).distinct()

    def categories(self) -> DataFrame:
        source = F.coalesce(blank_to_null(F.col("product_category_name")), F.lit("unknown"))
        named = self.products_file.select("product_id", source.alias("product_category_name"))
        translated = spread_join(named, self.translation_file, "product_category_name", ["product_id"])
        category = F.coalesce("product_category_name_english", "product_category_name")
        return translated.select("product_id", category.alias("category"))

    def listings(self) -> DataFrame:
        """One listing per product and seller, at the mean price it sold for.

        A product with very many sellers is split when it meets its category.
        """
        sold = self.selected_items().groupBy("product_id", "seller_id").agg(
            mean_half_even(F.sum("price"), F.count("price")).alias("unit_price")
        )
        return spread_join(sold, self.categories(), "product_id", ["seller_id"]).select(
            self.uuid("listing", listing_key()).alias("product_id"),
            self.uuid("seller", F.col("seller_id")).alias("seller_id"),
            F.coalesce("category", F.lit("unknown")).alias("category"),
            "unit_price",
        )

    def inventory(self) -> DataFrame:
        sold = self.selected_items().select("product_id", "seller_id").distinct()
        return sold.select(
            self.uuid("listing", listing_key()).alias("product_id"),
            F.lit(INITIAL_STOCK).alias("available_quantity"),
        )

    # ---- facts ----------------------------------------------------------------------

    def _orders_with_total(self) -> DataFrame:
        item_totals = self.selected_items().groupBy("order_id").agg(
            F.sum(F.col("price") + F.col("freight")).alias("item_total")
        )
        total = F.coalesce("paid", "item_total", F.lit(0).cast(EXACT))
        return (
            self.order_people()
            .join(self.order_totals(), "order_id", "left")
            .join(item_totals, "order_id", "left")
            .select(
                self.uuid("order", F.col("order_id")).alias("order_id"),
                self.uuid("customer", F.col("customer_unique_id")).alias("customer_id"),
                order_status(F.col("order_status")).alias("status"),
                F.bround(total, 2).cast("decimal(18,2)").alias("total_amount"),
                or_unknown(F.col("region")).alias("shipping_region"),
                F.col("purchased_at").alias("created_at"),
                F.col("order_status").alias("source_status"),
            )
        )

    def orders(self) -> DataFrame:
        return self._orders_with_total().filter(F.col("status").isNotNull()).drop("source_status")

    def unmapped_orders(self) -> DataFrame:
        """Orders whose source status has no counterpart, for the quarantine."""
        return self._orders_with_total().filter(F.col("status").isNull()).drop("status")

    def unmapped_keys(self) -> DataFrame:
        """Source keys of orders without an operational status; few in any sane history."""
        return self.all_orders().filter(order_status(F.col("order_status")).isNull()).select("order_id").distinct()

    def quarantine(self) -> dict[str, tuple[DataFrame, list[str]]]:
        """Source rows of unmapped orders, with their lines and payments, and their keys.

        What is in here is in none of the tables of ``tables``, and the other way round.
        """
        keys = self.unmapped_keys()
        rows = lambda frame: frame.join(keys, "order_id", "left_semi")
        return {
            "unmapped_orders": (rows(self.selected_orders()), ["order_id"]),
            "unmapped_order_items": (rows(self.selected_items()), ["order_id", "item_number"]),
            "unmapped_payments": (rows(self.in_slice(self.payments_file)), ["order_id", "payment_sequential"]),
        }

    def order_items(self) -> DataFrame:
        mapped = self.selected_items().join(self.unmapped_keys(), "order_id", "left_anti")
        lines = mapped.groupBy("order_id", "product_id", "seller_id").agg(
            F.count(F.lit(1)).alias("quantity"),
            mean_half_even(F.sum("price"), F.count("price")).alias("unit_price"),
        )
        return lines.select(
            self.uuid("order", F.col("order_id")).alias("order_id"),
            self.uuid("listing", listing_key()).alias("product_id"),
            "quantity",
            "unit_price",
        )

    def _tenders(self) -> DataFrame:
        """Payment rows with the context of their order. Orders without items have no
        seller to pay and yield none."""
        primary_seller = self.selected_items().groupBy("order_id").agg(
            F.min_by("seller_id", F.struct("item_number", "seller_id")).alias("seller_id")
        )
        people = spread_join(
            self.order_people(), self.person_stats(), "customer_unique_id", ["order_id"], "inner"
        )
        context = people.join(primary_seller, "order_id").select(
            "order_id",
            "customer_unique_id",
            "seller_id",
            "order_status",
            or_unknown(F.col("region")).alias("region"),
            F.coalesce("approved_at", "purchased_at").alias("event_time"),
            "account_created_at",
            "average_order_amount",
        )
        rows = self.payments_file.select(
            "order_id",
            "payment_sequential",
            "payment_type",
            F.bround(exact("payment_value"), 2).cast("decimal(18,2)").alias("amount"),
        )
        rows = rows.join(self.unmapped_keys(), "order_id", "left_anti")
        return spread_join(rows, context, "order_id", ["payment_sequential", "amount"], "inner")

    def payments(self) -> DataFrame:
        """Payments with neutral risk signals. Those without a positive amount are left
        out; ``skipped``, if given, counts them while the rows pass."""
        tenders = self._tenders()
        if self.skipped is not None:
            tenders = tenders.observe(self.skipped, F.count_if(F.col("amount") <= 0).alias("skipped_payments"))
        key = F.concat_ws(":", "order_id", "payment_sequential")
        person, region = F.col("customer_unique_id"), F.col("region")
        age = F.timestamp_diff("DAY", F.col("account_created_at"), F.col("event_time"))
        return tenders.filter(F.col("amount") > 0).select(
            self.uuid("transaction", key).alias("transaction_id"),
            self.uuid("payment-event", key).alias("event_id"),
            self.uuid("order", F.col("order_id")).alias("order_id"),
            self.uuid("customer", person).alias("customer_id"),
            self.uuid("seller", F.col("seller_id")).alias("seller_id"),
            "event_time",
            "amount",
            F.lit(CURRENCY).alias("currency"),
            payment_type(F.col("payment_type")).alias("payment_type"),
            F.concat(F.lit(self.device_prefix), person).alias("device_id"),
            F.lit(False).alias("is_new_device"),
            region.alias("ip_region"),
            region.alias("home_region"),
            region.alias("shipping_region"),
            F.greatest(F.lit(0), age).cast("int").alias("account_age_days"),
            F.lit(0).alias("login_failures"),
            F.lit(1).alias("attempt_number"),
            F.col("average_order_amount").alias("customer_average_amount"),
            payment_status(F.col("order_status")).alias("status"),
        )

    def skipped_payments(self) -> DataFrame:
        return self._tenders().agg(F.count_if(F.col("amount") <= 0).alias("skipped_payments"))

    def tables(self) -> dict[str, tuple[DataFrame, list[str]]]:
        """Every output with its key, in load order."""
        return {
            "customers": (self.customers(), ["customer_id"]),
            "sellers": (self.sellers(), ["seller_id"]),
            "products": (self.listings(), ["product_id"]),
            "inventory": (self.inventory(), ["product_id"]),
            "orders": (self.orders(), ["order_id"]),
            "order_items": (self.order_items(), ["order_id", "product_id"]),
            "payments": (self.payments(), ["transaction_id"]),
        }
