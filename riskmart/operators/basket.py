"""Catalogue baskets around a customer's usual spending.

For every customer: how many baskets (product x quantity) cost between half and one
and a half times the baseline, and the basket nearest to it.

Comparing customers with baskets pairwise grows with the product of both. Instead both
sides shrink to their distinct amounts, the amounts and the three points of interest of
each baseline are laid on one price axis, and running counts answer all questions. The
axis is cut into slabs. A slab is 100 wide and amounts have cents (baseline bounds have
half cents), so one slab holds at most some 60,000 points whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.operators.spread import spread_join

# Quantities per basket and the accepted share of the baseline.
QUANTITIES = (1, 2, 3)
LOWER_SHARE, UPPER_SHARE = "0.5", "1.5"

SLAB_WIDTH = 100
SLABS_PER_BLOCK = 10_000
AXIS = "decimal(16,3)"


def priced_baskets(catalogue: DataFrame) -> DataFrame:
    """Distinct basket amounts with how many baskets cost that and the first of them."""
    quantity = F.explode(F.array(*(F.lit(q) for q in QUANTITIES)))
    return (
        catalogue.select("product_key", quantity.alias("quantity"), "unit_price")
        .groupBy((F.col("unit_price") * F.col("quantity")).cast(AXIS).alias("at"))
        .agg(
            F.count(F.lit(1)).alias("baskets"),
            F.min(F.struct("product_key", "quantity")).alias("first"),
        )
        .withColumn("basket", F.struct(F.col("at").alias("amount"), "first.product_key", "first.quantity"))
        .drop("first")
    )


def _points(catalogue: DataFrame, levels: DataFrame) -> DataFrame:
    """Amounts and probes on one axis. ``turn`` orders equal positions: the lower bound
    comes before an amount it equals, the other probes after."""
    amounts = priced_baskets(catalogue).select(
        "at", F.lit(1).alias("turn"), "baskets", "basket",
        F.lit(None).cast("decimal(12,2)").alias("baseline"), F.lit(None).cast("string").alias("role"),
    )

    def probe(position: Column, turn: int, role: str) -> Column:
        return F.struct(position.cast(AXIS).alias("at"), F.lit(turn).alias("turn"), F.lit(role).alias("role"))

    baseline = F.col("baseline")
    probes = levels.select(
        "baseline",
        F.explode(
            F.array(
                probe(baseline * F.lit(LOWER_SHARE).cast("decimal(2,1)"), 0, "lower"),
                probe(baseline, 2, "level"),
                probe(baseline * F.lit(UPPER_SHARE).cast("decimal(2,1)"), 2, "upper"),
            )
        ).alias("p"),
    ).select("baseline", "p.*")
    return amounts.unionByName(probes, allowMissingColumns=True).withColumns(
        {
            "slab": F.floor(F.col("at") / SLAB_WIDTH),
            "block": F.floor(F.col("at") / (SLAB_WIDTH * SLABS_PER_BLOCK)),
        }
    )


def _carried(rows: DataFrame, group: str | None, order: str, prefix: str) -> DataFrame:
    """What lies before and after each slab (or block): baskets, last and first amount."""
    base = Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))
    before = base.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    after = base.orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns(
        {
            f"{prefix}_before": F.coalesce(F.sum("baskets").over(before), F.lit(0)),
            f"{prefix}_below": F.max("high").over(before),
            f"{prefix}_above": F.min("low").over(after),
        }
    ).drop("baskets", "low", "high")


def basket_match(customers: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``customers(customer_id, baseline)`` against ``catalogue(product_key, unit_price)``.

    Returns customer_id, baseline, in_band_baskets, in_band, product_key, quantity, amount.
    """
    levels = customers.select("baseline").filter(F.col("baseline").isNotNull()).distinct()
    points = _points(catalogue, levels)
    ends = [F.sum("baskets").alias("baskets"), F.min("basket").alias("low"), F.max("basket").alias("high")]
    slabs = _carried(points.groupBy("block", "slab").agg(*ends), "block", "slab", "slab")
    # A block spans a million; at most 30,000 of them fit the widest basket amount.
    blocks = _carried(points.groupBy("block").agg(*ends), None, "block", "block")

    # The rest of a slab is a running frame from its other end: Spark grows such a
    # frame row by row, but starts a frame that ends at the last row anew each time.
    slab = Window.partitionBy("block", "slab")
    so_far = slab.orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    rest = slab.orderBy(F.col("at").desc(), F.col("turn").desc()).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        points.withColumns(
            {
                "here": F.coalesce(F.sum("baskets").over(so_far), F.lit(0)),
                "here_below": F.max("basket").over(so_far),
                "here_above": F.min("basket").over(rest),
            }
        )
        .filter(F.col("role").isNotNull())
        .join(slabs, ["block", "slab"])
        .join(blocks, "block")
        .select(
            "baseline",
            "role",
            (F.col("here") + F.col("slab_before") + F.col("block_before")).alias("count"),
            F.coalesce("here_below", "slab_below", "block_below").alias("below"),
            F.coalesce("here_above", "slab_above", "block_above").alias("above"),
        )
    )

    def at(role: str, column: str) -> Column:
        return F.max(F.when(F.col("role") == role, F.col(column)))

    found = placed.groupBy("baseline").agg(
        (at("upper", "count") - at("lower", "count")).alias("in_band_baskets"),
        at("level", "below").alias("below"),
        at("level", "above").alias("above"),
    )

    def candidate(side: str) -> Column:
        basket = F.col(side)
        return F.when(
            basket.isNotNull(),
            F.struct(
                F.abs(basket.amount - F.col("baseline")).alias("distance"),
                basket.product_key.alias("product_key"),
                basket.quantity.alias("quantity"),
                basket.amount.cast("decimal(14,2)").alias("amount"),
            ),
        )

    nearest = found.withColumn("nearest", F.least(candidate("below"), candidate("above"))).select(
        "baseline",
        "in_band_baskets",
        (F.col("in_band_baskets") > 0).alias("in_band"),
        "nearest.product_key",
        "nearest.quantity",
        "nearest.amount",
    )
    return spread_join(customers, nearest, "baseline", ["customer_id"])
