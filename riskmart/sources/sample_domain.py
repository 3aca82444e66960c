"""The sample star schema seen as the tables this library works on.

Payments, customers, orders, chargebacks and their change stream, and the
all-text marketplace files, are derived from the parquet tables of ``sf_dir``.
Arithmetic on keys stands in for attributes the star schema lacks (a device flag,
a review); it decides values, not which rows are worked on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskmart.contracts import CHARGEBACKS, CUSTOMERS, ORDERS, PAYMENTS, Entity

DECIMAL = "decimal(12,2)"
#: Source rows that a task makes change records of.
ROWS_PER_TASK = 250_000


# Schemas by path, so that a table opened again needs no look at its footers.
_SCHEMAS: dict[str, StructType] = {}


def _once(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build a frame once per domain; asking again returns the same plan."""

    @wraps(build)
    def cached(self: SampleDomain, *args) -> DataFrame:
        key = (build.__name__, *args)
        if key not in self._frames:
            self._frames[key] = build(self, *args)
        return self._frames[key]

    return cached


class SampleDomain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[tuple, DataFrame] = {}

    def holding(self, tables: dict[str, DataFrame]) -> SampleDomain:
        """The domain over stored copies of some of its operational tables.

        Whatever is derived from these reads the copies instead of working them out again.
        """
        other = SampleDomain(self.spark, self.sf_dir)
        other._frames = {(name,): frame for name, frame in tables.items()}
        return other

    @_once
    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @_once
    def _spread(self, name: str, key: str) -> DataFrame:
        """A table over all cores, in parts of ``ROWS_PER_TASK`` rows or less.

        Building JSON or date text for each row is costly, and the rows get many times as
        wide by it, so what a task sorts must not grow with the input. Inputs that have
        enough files are left alone: no shuffle is added to them.
        """
        frame, cores = self.table(name), self.spark.sparkContext.defaultParallelism
        parts = max(cores, -(-frame.count() // ROWS_PER_TASK))
        return frame.repartition(parts, key) if len(frame.inputFiles()) < parts else frame

    # ---- operational tables ------------------------------------------------

    @_once
    def _nations(self) -> DataFrame:
        nation = self.table("nation")
        region = self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", "n_name", "r_name"
        )

    @_once
    def _customer_regions(self) -> DataFrame:
        nations = self._nations()
        customer = self.table("customer")
        return customer.join(nations, customer.c_nationkey == nations.n_nationkey).select(
            "c_custkey", "c_acctbal", F.col("r_name").alias("home_region")
        )

    @_once
    def payments(self) -> DataFrame:
        """One payment per order that has lines; the seller of its first line gets it."""
        # Line number and seller packed into one number: a minimum over a struct would
        # make Spark sort all lines instead of hashing the orders.
        packed = F.col("l_linenumber").cast("bigint") * 10**12 + F.col("l_suppkey")
        first_line = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min(packed).alias("first"))
            .select("o_orderkey", (F.col("first") % 10**12).alias("s_suppkey"))
        )
        nations = self._nations()
        supplier = self.table("supplier")
        seller_regions = supplier.join(nations, supplier.s_nationkey == nations.n_nationkey).select(
            "s_suppkey", F.col("r_name").alias("seller_region")
        )
        key = F.col("o_orderkey")
        home, away = F.col("home_region"), F.col("seller_region")
        text_key = key.cast("string")
        event_time = F.col("o_orderdate").cast("timestamp")
        joined = (
            self._spread("orders", "o_orderkey")
            .join(first_line, "o_orderkey")
            .withColumnRenamed("o_custkey", "c_custkey")
            .join(self._customer_regions(), "c_custkey")
            .join(seller_regions, "s_suppkey")
        )
        return joined.select(
            text_key.alias("transaction_id"),
            F.concat(F.lit("evt-"), text_key).alias("event_id"),
            text_key.alias("order_id"),
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("s_suppkey").cast("string").alias("seller_id"),
            event_time.alias("event_time"),
            F.col("o_totalprice").cast(DECIMAL).alias("amount"),
            F.when(home == "AMERICA", "USD").when(home == "EUROPE", "EUR").otherwise("BRL").alias("currency"),
            F.lit("CARD").alias("payment_type"),
            F.concat(F.lit("dev-"), F.col("c_custkey").cast("string")).alias("device_id"),
            (key % 7 == 0).alias("is_new_device"),
            F.when(key % 5 == 0, away).otherwise(home).alias("ip_region"),
            home.alias("home_region"),
            F.when(key % 3 == 0, away).otherwise(home).alias("shipping_region"),
            (key % 1000).cast("int").alias("account_age_days"),
            (key % 6).cast("int").alias("login_failures"),
            (key % 5 + 1).cast("int").alias("attempt_number"),
            (F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 25).cast(DECIMAL).alias("customer_average_amount"),
            F.lit("AUTHORIZED").alias("status"),
            event_time.alias("created_at"),
            event_time.alias("kafka_timestamp"),
        )

    @_once
    def customers(self) -> DataFrame:
        spending = self.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.avg(F.col("o_totalprice").cast(DECIMAL)).cast(DECIMAL).alias("average_order_amount"),
            F.min("o_orderdate").cast("timestamp").alias("first_order_at"),
        )
        return (
            self._customer_regions()
            .join(spending, "c_custkey", "left")
            .select(
                F.col("c_custkey").cast("string").alias("customer_id"),
                "home_region",
                (F.col("first_order_at") - F.expr("INTERVAL 30 DAYS")).alias("account_created_at"),
                "average_order_amount",
            )
        )

    @_once
    def orders(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self._spread("orders", "o_orderkey").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.when(status == "F", "FAILED").when(status == "O", "CREATED").otherwise("PAID").alias("status"),
            F.col("o_totalprice").cast(DECIMAL).alias("total_amount"),
            F.lit("UNKNOWN").alias("shipping_region"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        )

    @_once
    def chargebacks(self) -> DataFrame:
        """One payment in eleven is disputed, thirty days later."""
        return self.chargebacks_of(self.payments())

    @staticmethod
    def chargebacks_of(payments: DataFrame) -> DataFrame:
        reported = F.col("event_time") + F.expr("INTERVAL 30 DAYS")
        return payments.filter(F.col("transaction_id").cast("bigint") % 11 == 0).select(
            F.concat(F.lit("cb-"), "transaction_id").alias("chargeback_id"),
            "transaction_id",
            reported.alias("reported_at"),
            F.lit("FRAUD").alias("reason"),
            reported.alias("created_at"),
        )

    def disputes(self) -> DataFrame:
        """Disputes as reported, also for orders that were never paid."""
        key = F.col("o_orderkey")
        return self.table("orders").filter(key % 11 == 0).select(
            F.concat(F.lit("cb-"), key.cast("string")).alias("chargeback_id"),
            key.cast("string").alias("transaction_id"),
        )

    # ---- change stream -----------------------------------------------------

    def customer_changes(self) -> DataFrame:
        """Snapshot of all customers, then one change per event, some of them bad."""
        customer_key = F.col("c_custkey")
        snapshot = self._spread("customer", "c_custkey").select(
            customer_key.cast("string").alias("record_key"),
            F.lit("r").alias("op"),
            F.lit(1).cast("bigint").alias("lsn"),
            (customer_key % 6).cast("int").alias("partition"),
            customer_key.alias("offset"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
            F.greatest(F.col("c_acctbal"), F.lit(0.0)).cast(DECIMAL).cast("string").alias("amount_text"),
            customer_key.alias("person"),
            F.lit(False).alias("tombstone"),
            F.lit(True).alias("wrapped"),
        )
        event, user = F.col("event_id"), F.col("user_id")
        kind = (
            F.when(event % 97 == 0, "x")
            .when(F.col("event_type") == "signup", "c")
            .when(F.col("event_type") == "error", "d")
            .otherwise("u")
        )
        amount = (
            F.when(event % 107 == 0, "-1")
            .when(event % 109 == 0, "not-a-number")
            .otherwise(F.col("value").cast(DECIMAL).cast("string"))
        )
        changes = self._spread("events", "event_id").select(
            F.when(event % 101 != 0, user.cast("string")).alias("record_key"),
            kind.alias("op"),
            (F.lit(1_000_000) + F.call_function("div", event, F.lit(3))).alias("lsn"),
            (user % 6).cast("int").alias("partition"),
            (F.lit(1_000_000) + event).alias("offset"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            amount.alias("amount_text"),
            user.alias("person"),
            (event % 103 == 0).alias("tombstone"),
            (event % 2 == 0).alias("wrapped"),
        )
        rows = snapshot.unionByName(changes)
        person = F.col("person")
        opened = F.lit("2023-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=(person % 300).cast("int"))
        image = {
            "customer_id": F.col("record_key"),
            "home_region": F.concat(F.lit("R"), (person % 5).cast("string")),
            "account_created_at": F.unix_micros(opened),
            "average_order_amount": F.col("amount_text"),
            "trusted_device_id": F.concat(F.lit("dev-"), person.cast("string")),
            "updated_at": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        }
        return _records(rows, CUSTOMERS, image)

    def order_changes(self) -> DataFrame:
        key = F.col("order_id").cast("bigint")
        rows = self._inserts(self.orders(), key, lsn_base=2_000_000)
        image = {
            "order_id": F.col("order_id"),
            "customer_id": F.col("customer_id"),
            "status": F.when(key % 223 == 0, "LOST").otherwise(F.col("status")),
            "total_amount": F.when(key % 211 == 0, "-5.00").otherwise(F.col("total_amount").cast("string")),
            "shipping_region": F.when(key % 227 == 0, "  ").otherwise(F.col("shipping_region")),
            "created_at": F.unix_micros("created_at"),
            "updated_at": F.unix_micros("updated_at"),
        }
        return _records(rows, ORDERS, image)

    def payment_changes(self, with_faults: bool = True) -> DataFrame:
        payments = self.payments()
        key = F.col("transaction_id").cast("bigint")
        rows = self._inserts(payments, key, lsn_base=3_000_000)
        image = {name: F.col(name) for name in PAYMENTS.fields}
        for name in ("amount", "customer_average_amount"):
            image[name] = F.col(name).cast("string")
        for name in ("event_time", "created_at"):
            image[name] = F.unix_micros(name)
        if with_faults:
            faults = {
                "amount": (229, "0.00"), "account_age_days": (233, -1), "login_failures": (239, -2),
                "attempt_number": (241, 0), "customer_average_amount": (251, "-1.00"),
                "status": (257, "LOST"), "currency": (263, ""),
            }
            for name, (divisor, bad) in faults.items():
                image[name] = F.when(key % divisor == 0, F.lit(bad)).otherwise(image[name])
        return _records(rows, PAYMENTS, image)

    def chargeback_changes(self) -> DataFrame:
        key = F.col("transaction_id").cast("bigint")
        rows = self._inserts(self.chargebacks(), key, lsn_base=4_000_000)
        image = {name: F.col(name) for name in CHARGEBACKS.fields}
        image["reason"] = F.when(key % 13 == 0, F.lit("")).otherwise(F.col("reason"))
        for name in ("reported_at", "created_at"):
            image[name] = F.unix_micros(name)
        return _records(rows, CHARGEBACKS, image)

    def later_changes(self, entity: Entity) -> DataFrame:
        """A second change of every order, payment and chargeback: an update, a delete, or an
        update that left the source before the insert and only arrives after it."""
        if entity is ORDERS:
            rows, status = self.orders(), F.col("status")
            updated, deleted = status == "FAILED", status == "PAID"
            change = {"status": F.when(updated, "CANCELLED").when(deleted, status).otherwise("DELIVERED")}
        elif entity is PAYMENTS:
            rows, region = self.payments(), F.col("home_region")
            updated, deleted = region == "ASIA", region == "AFRICA"
            change = {"status": F.when(updated, "DECLINED").otherwise("PENDING")}
        else:
            rows, weekday = self.chargebacks(), F.dayofweek("reported_at")
            updated, deleted = weekday == 2, weekday == 1
            change = {"reason": F.when(updated, "STOLEN_CARD").otherwise("UNKNOWN")}
        key = F.col("order_id" if entity is ORDERS else "transaction_id").cast("bigint")
        base = {ORDERS.name: 2_000_000, PAYMENTS.name: 3_000_000, CHARGEBACKS.name: 4_000_000}[entity.name]
        rows = self._inserts(rows, key, base).withColumns(
            {
                "op": F.when(deleted, "d").otherwise("u"),
                "lsn": F.when(updated | deleted, F.lit(3 * base) + key).otherwise(F.col("lsn") - 1),
                "offset": F.lit(10_000_000) + key,
                "timestamp": F.col("timestamp") + F.expr("INTERVAL 1 DAY"),
            }
        )
        image = {name: change.get(name, F.col(name)) for name in entity.fields}
        for name, kind in entity.fields.items():
            if kind == "instant":
                image[name] = F.unix_micros(name)
            elif kind == "decimal":
                image[name] = F.col(name).cast("string")
        return _records(rows, entity, image)

    def change_stream(self) -> DataFrame:
        """All four topics as raw log records."""
        parts = (
            self.customer_changes(), self.order_changes(),
            self.payment_changes(), self.chargeback_changes(),
        )
        return reduce(DataFrame.unionByName, parts)

    @staticmethod
    def _inserts(rows: DataFrame, key: Column, lsn_base: int) -> DataFrame:
        """History captured as one order per second, so log times are not event times."""
        captured = F.timestamp_seconds(F.unix_seconds(F.lit("2024-02-01 00:00:00").cast("timestamp")) + key)
        return rows.withColumns(
            {
                "record_key": key.cast("string"),
                "op": F.lit("c"),
                "lsn": F.lit(lsn_base) + key,
                "partition": (key % 6).cast("int"),
                "offset": key,
                "timestamp": captured,
                "tombstone": F.lit(False),
                "wrapped": key % 2 == 0,
            }
        )

    # ---- marketplace files, all text ----------------------------------------

    @_once
    def market(self, name: str) -> DataFrame:
        return getattr(self, f"_market_{name}")()

    def _market_customers(self) -> DataFrame:
        customer, nation = self.table("customer"), self.table("nation")
        key = F.col("c_custkey")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            key.cast("string").alias("customer_id"),
            F.call_function("div", key, F.lit(2)).cast("string").alias("customer_unique_id"),
            (key % 200).cast("string").alias("customer_zip_code_prefix"),
            F.concat(F.lit(" "), "c_mktsegment").alias("customer_city"),
            F.concat(F.lower("n_name"), F.lit(" ")).alias("customer_state"),
        )

    def _market_geolocation(self) -> DataFrame:
        customer, nation = self.table("customer"), self.table("nation")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            (F.col("c_custkey") % 200).cast("string").alias("geolocation_zip_code_prefix"),
            F.col("c_acctbal").cast(DECIMAL).cast("string").alias("geolocation_lat"),
            (-F.col("c_acctbal").cast(DECIMAL)).cast("string").alias("geolocation_lng"),
            F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("geolocation_city"),
            F.lower("n_name").alias("geolocation_state"),
        )

    def _market_sellers(self) -> DataFrame:
        supplier, nation = self.table("supplier"), self.table("nation")
        key = F.col("s_suppkey")
        return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
            key.cast("string").alias("seller_id"),
            (key % 200).cast("string").alias("seller_zip_code_prefix"),
            F.concat(F.lit("City "), (key % 40).cast("string")).alias("seller_city"),
            F.lower("n_name").alias("seller_state"),
        )

    def _market_products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        return self.table("part").select(
            key.cast("string").alias("product_id"),
            F.when(key % 50 != 0, F.col("p_type")).alias("product_category_name"),
            F.length("p_name").cast("string").alias("product_name_lenght"),
            (size * 10).cast("string").alias("product_description_lenght"),
            F.when(key % 31 == 0, "many").otherwise((size % 5).cast("string")).alias("product_photos_qty"),
            (size * 100).cast("string").alias("product_weight_g"),
            (size + 5).cast("string").alias("product_length_cm"),
            (size + 2).cast("string").alias("product_height_cm"),
            (size + 1).cast("string").alias("product_width_cm"),
        )

    def _market_product_category_name_translation(self) -> DataFrame:
        """English name of every category but one."""
        category = F.col("p_type")
        return (
            self.table("part").filter(category != "ECONOMY").select(category).distinct().select(
                category.alias("product_category_name"),
                F.concat(F.lower(category), F.lit("_en")).alias("product_category_name_english"),
            )
        )

    def _market_orders(self) -> DataFrame:
        key, bought = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
        status = F.col("o_orderstatus")

        def text(moment: Column) -> Column:
            return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")

        def later(days, hours=None) -> Column:
            step = F.make_dt_interval(days=days.cast("int"), hours=(hours if hours is not None else F.lit(0)).cast("int"))
            return text(bought + step)

        return self._spread("orders", "o_orderkey").select(
            key.cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.when(status == "F", "Canceled").when(status == "O", " shipped").otherwise("delivered").alias("order_status"),
            text(bought).alias("order_purchase_timestamp"),
            F.when(key % 13 == 0, "").otherwise(later(F.lit(0), F.lit(5))).alias("order_approved_at"),
            F.when(status != "F", later(F.lit(2))).otherwise("").alias("order_delivered_carrier_date"),
            F.when(status == "P", later(key % 20, key % 24)).otherwise("").alias("order_delivered_customer_date"),
            later(F.lit(12)).alias("order_estimated_delivery_date"),
        )

    @_once
    def _numbered_lines(self) -> DataFrame:
        """Lines with their place within the order; line numbers repeat in the source.

        One sort-merge pass over orders of a handful of lines: the window cannot be
        pre-reduced, because every line keeps its own number.
        """
        place = F.row_number().over(
            Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        )
        return self.table("lineitem").withColumn("place", place)

    def _market_order_items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast(DECIMAL)
        return self._numbered_lines().select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("place").cast("string").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipping_limit_date"),
            price.cast("string").alias("price"),
            (price * F.col("l_tax").cast("decimal(4,2)")).cast(DECIMAL).cast("string").alias("freight_value"),
        )

    def _market_order_payments(self) -> DataFrame:
        key = F.col("l_orderkey")
        value = F.col("l_extendedprice").cast(DECIMAL)
        scaled = F.when(key % 50 == 0, value * 20).otherwise(value).cast("decimal(14,2)")
        kind = F.col("l_linenumber") % 4
        return self._numbered_lines().select(
            key.cast("string").alias("order_id"),
            F.col("place").cast("string").alias("payment_sequential"),
            F.when(kind == 0, "credit_card").when(kind == 1, "boleto").when(kind == 2, " debit card").otherwise(" ")
            .alias("payment_type"),
            (F.col("l_quantity").cast("int") % 13).cast("string").alias("payment_installments"),
            scaled.cast("string").alias("payment_value"),
        )

    def payments_with_free_orders(self) -> DataFrame:
        """Marketplace payments in which some orders were paid in full by voucher (value 0)."""
        free = F.col("order_id").cast("bigint") % 61 == 0
        return self.market("order_payments").withColumn(
            "payment_value", F.when(free, "0.00").otherwise(F.col("payment_value"))
        )

    def _market_order_reviews(self) -> DataFrame:
        """Reviews of two orders in three; some have an older version with a better score."""
        key = F.col("o_orderkey")
        base = self.table("orders").filter(key % 3 != 0)
        written = F.col("o_orderdate").cast("timestamp")
        has_older = F.when(key % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
        version = F.col("version")
        ingested = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=version)
        return base.withColumn("version", F.explode(has_older)).select(
            F.concat(F.lit("rv-"), key.cast("string")).alias("review_id"),
            key.cast("string").alias("order_id"),
            F.when(version == 0, "5").otherwise((key % 5 + 1).cast("string")).alias("review_score"),
            F.when(key % 4 == 0, "  ").otherwise(F.concat(F.lit("title "), key.cast("string"))).alias("review_comment_title"),
            F.concat(F.lit('said "fine", then\nleft '), (key % 9).cast("string")).alias("review_comment_message"),
            F.date_format(written, "yyyy-MM-dd HH:mm:ss").alias("review_creation_date"),
            F.date_format(written + F.make_dt_interval(hours=version + 23), "yyyy-MM-dd HH:mm:ss").alias("review_answer_timestamp"),
            ingested.alias("_ingested_at"),
        )


def _records(rows: DataFrame, entity: Entity, image: dict[str, Column]) -> DataFrame:
    """Log records with JSON envelopes; deletes carry the old image only."""
    fields = F.struct(*(image[name].alias(name) for name in entity.fields))
    is_delete = F.col("op") == "d"
    envelope = F.struct(
        F.col("op").alias("op"),
        F.when(is_delete, fields).alias("before"),
        F.when(~is_delete, fields).alias("after"),
        F.struct(F.col("lsn").alias("lsn")).alias("source"),
    )
    text = F.when(F.col("wrapped"), F.to_json(F.struct(envelope.alias("payload")))).otherwise(F.to_json(envelope))
    return rows.select(
        F.lit(entity.topic).alias("topic"),
        "partition",
        F.col("offset").cast("bigint").alias("offset"),
        "timestamp",
        F.col("record_key").cast("binary").alias("key"),
        F.when(~F.col("tombstone"), text).cast("binary").alias("value"),
    )
