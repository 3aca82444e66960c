"""Sharding with a k-d tree over document metadata.

The tree starts with all documents and the number of shards. A node that stands for more
than one shard is split across its widest dimension (measured against the width of all
documents) where the bytes below the cut are in proportion to the shards below it. Cuts
are weighted quantiles found in narrowing histograms: every round is one aggregate with a
fixed number of buckets per node, so the driver sees at most ``shards * BUCKETS`` rows.

A dimension's coordinate is one long: its value scaled to 20 bits, then 42 bits of a hash
of the row. The hash parts rows with equal values, so a source with a third of all rows is
cut at any size wanted. Only rows whose value and 42 hash bits agree stay together.

Defined cases: NULL text has size 16; NULL metadata counts as the empty string or as 0;
rows that agree in everything share a coordinate and stay together; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stored

SHARDS = 40
ROW_BYTES = 16
BUCKETS = 1024
VALUE_BITS, HASH_BITS = 20, 42
#: Rows that one task numbers inside a shard.
BLOCK_ROWS = 100_000
DIMENSIONS = ("by_length", "by_source", "by_lang", "by_doc_id")


def _scaled(share: Column) -> Column:
    """A number of 0 to 1 as the upper bits of a coordinate."""
    return (share * (2**VALUE_BITS - 1)).cast("long") * F.lit(1 << HASH_BITS)


def _name_share(name: Column) -> Column:
    return F.crc32(F.coalesce(name, F.lit(""))) / F.lit(2.0**32)


def coordinates(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, tie and one coordinate per dimension."""
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + ROW_BYTES).cast("long")
    tie = F.xxhash64("doc_id", "text", "source", "lang")
    base = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        tie.alias("tie"),
        F.log1p(size.cast("double")).alias("log_size"),
        _name_share(F.col("source")).alias("source_share"),
        _name_share(F.col("lang")).alias("lang_share"),
    )
    base = stored(base, "kd-rows")
    low, high, top = base.agg(F.min("doc_id"), F.max("doc_id"), F.max("log_size")).first()
    span = max((high or 0) - (low or 0), 1)
    doc_share = F.coalesce((F.col("doc_id") - (low or 0)) / F.lit(float(span)), F.lit(0.0))
    low_bits = F.pmod(F.col("tie"), F.lit(1 << HASH_BITS))
    shares = {
        "by_length": F.col("log_size") / F.lit(float(top or 1.0)),
        "by_source": F.col("source_share"),
        "by_lang": F.col("lang_share"),
        "by_doc_id": doc_share,
    }
    at = F.array(*[_scaled(shares[d]) + low_bits for d in DIMENSIONS])
    return base.select("doc_id", "size", "text_crc32", "tie", at.alias("at"))


@dataclass
class Node:
    """A part of the tree: shards first to first + count - 1, named by the first."""

    first: int
    count: int
    dimension: int = 0
    low: int = 0
    high: int = 0

    def parts(self) -> tuple[Node, Node]:
        half = self.count // 2
        return Node(self.first, half), Node(self.first + half, self.count - half)


def _long_map(values: dict[int, int]) -> Column:
    return F.create_map(*[F.lit(x).cast(t) for k, v in values.items() for x, t in ((k, "int"), (v, "long"))])


def _find_cuts(rows: DataFrame, nodes: dict[int, Node]) -> dict[int, int]:
    """Per node the largest coordinate that goes left.

    Each round narrows every node to one of its buckets, until one coordinate is left.
    """
    bounds = {n: (node.low, node.high) for n, node in nodes.items()}
    before = dict.fromkeys(bounds, 0)
    wanted: dict[int, float] = {}
    chosen: dict[int, int] = {}
    coordinate = F.get("at", F.try_element_at(_long_map({n: x.dimension for n, x in nodes.items()}), F.col("node")).cast("int"))
    while bounds:
        step = {n: (high - low) // BUCKETS + 1 for n, (low, high) in bounds.items()}
        low = F.try_element_at(_long_map({n: b[0] for n, b in bounds.items()}), F.col("node"))
        width = F.try_element_at(_long_map(step), F.col("node"))
        # Rows outside a node's bounds fall into buckets that nobody asks for.
        bucket = F.least(F.lit(BUCKETS), F.call_function("div", coordinate - low, width))
        counted = (
            rows.where(F.col("node").isin(list(bounds)))
            .groupBy("node", F.when(coordinate >= low, bucket).alias("bucket"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        histogram: dict[int, dict[int, int]] = defaultdict(dict)
        for row in counted:
            if row["bucket"] is not None and 0 <= row["bucket"] < BUCKETS:
                histogram[row["node"]][row["bucket"]] = row["bytes"]
        for number, (low_at, high_at) in list(bounds.items()):
            buckets = histogram[number]
            share = (nodes[number].count // 2) / nodes[number].count
            wanted.setdefault(number, sum(buckets.values()) * share)
            running, last_bucket = before[number], max(buckets)
            for bucket in sorted(buckets):
                if running + buckets[bucket] >= wanted[number] or bucket == last_bucket:
                    break
                running += buckets[bucket]
            first = low_at + bucket * step[number]
            last = min(first + step[number] - 1, high_at)
            if first >= last:
                # One coordinate is left: it goes to the side that comes closer.
                over = running + buckets[bucket] - wanted[number]
                chosen[number] = last if over <= wanted[number] - running else last - 1
                del bounds[number]
            else:
                before[number] = running
                bounds[number] = (first, last)
    return chosen


def kd_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, tie and shard (0 to shards - 1) of every row.

    All nodes of a level are split together; each level is one narrow stored table.
    """
    rows = coordinates(docs).withColumn("node", F.lit(0))
    level = {0: Node(0, shards)} if shards > 1 else {}
    while level:
        stats = (
            rows.where(F.col("node").isin(list(level)))
            .groupBy("node")
            .agg(
                *[
                    f(F.get("at", F.lit(d))).alias(f"{n}{d}")
                    for d in range(len(DIMENSIONS))
                    for n, f in (("low", F.min), ("high", F.max))
                ]
            )
        )
        nodes = {}
        for row in stats.collect():
            node = level[row["node"]]
            node.dimension = max(
                range(len(DIMENSIONS)),
                key=lambda d: ((row[f"high{d}"] >> HASH_BITS) - (row[f"low{d}"] >> HASH_BITS), -d),
            )
            node.low, node.high = row[f"low{node.dimension}"], row[f"high{node.dimension}"]
            nodes[node.first] = node
        if not nodes:
            break
        cuts = _find_cuts(rows, nodes)
        parts = [part for node in nodes.values() for part in node.parts()]
        dimension = _long_map({n: x.dimension for n, x in nodes.items()})
        right = _long_map({n: x.parts()[1].first for n, x in nodes.items()})
        coordinate = F.get("at", F.try_element_at(dimension, F.col("node")).cast("int"))
        above = coordinate > F.try_element_at(_long_map(cuts), F.col("node"))
        moved = F.when(above, F.try_element_at(right, F.col("node")).cast("int")).otherwise(F.col("node"))
        rows = stored(rows.withColumn("node", moved), "kd-level")
        level = {part.first: part for part in parts if part.count > 1}
    return rows.select("doc_id", "size", "text_crc32", "tie", F.col("node").alias("shard"))


def numbered(placed: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard, without a task that sees a whole shard.

    Rows are dealt to blocks by their hash. Blocks are counted, counts are summed up over the
    few blocks of a shard, and rows are numbered inside their block.
    """
    total = placed.count()
    blocks = total // BLOCK_ROWS + 1
    dealt = placed.withColumn("block", F.pmod(F.xxhash64("tie", F.lit(1)), F.lit(blocks)))
    counts = dealt.groupBy("shard", "block").agg(F.count("*").alias("rows"))
    offsets = counts.select(
        "shard", "block", F.expr("sum(rows) OVER (PARTITION BY shard ORDER BY block) - rows").alias("offset")
    )
    inside = dealt.withColumn(
        "place",
        F.expr("row_number() OVER (PARTITION BY shard, block ORDER BY doc_id, tie, text_crc32, size) - 1"),
    )
    return inside.join(offsets, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") + F.col("offset")).cast("long").alias("slot")
    )
