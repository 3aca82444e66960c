"""Line deduplication by overlapping windows of three lines.

Lines without a word are kept and skipped when windows are formed. A window is three
consecutive other lines of a document. Of all windows with the same lines the first by
(doc_id, text hash, line) stays; the lines that any later one covers are removed.

Defined cases: NULL text stays NULL; a document with fewer than three lines has no
window and stays as it is; rows that agree in doc_id and text are one document and all
get its result; NULL doc_ids come first; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import BLANK_RUN, text_key

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _full_positions(lines: Column) -> Column:
    """Indexes of the lines that hold a word."""
    indexed = F.transform(lines, lambda line, i: F.when(F.regexp_replace(line, BLANK_RUN, "") != "", i))
    return F.filter(indexed, lambda i: i.isNotNull())


def line_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per window: id, key, first (index among lines with words), two hashes."""
    lines = docs.select(
        F.col("doc_id").alias("id"),
        text_key(F.col("text")).alias("key"),
        F.filter(_lines(F.col("text")), lambda l: F.regexp_replace(l, BLANK_RUN, "") != "").alias("lines"),
    ).where(F.size("lines") >= window)
    starts = lines.select(
        "id", "key", "lines", F.explode(F.sequence(F.lit(0), F.size("lines") - window)).alias("first")
    )
    parts = [F.get("lines", F.col("first") + k) for k in range(window)]
    return starts.select(
        "id",
        "key",
        "first",
        F.xxhash64(*parts).alias("w1"),
        F.xxhash64(F.lit(window), *parts[::-1]).alias("w2"),
    )


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW, measures: bool = True) -> DataFrame:
    """The documents with ``text`` cut; ``measures`` adds n_lines and n_removed_lines, which
    replace columns of the same names.

    Windows are counted with map-side partial sums, so a window that a third of all
    documents hold is one row per task. Joining the first place back to the windows may
    be skewed on such a window; both sides are plain shuffles, which AQE splits.
    """
    windows = line_windows(docs, window)
    place = F.struct("id", "key", "first")
    repeated = (
        windows.groupBy("w1", "w2")
        .agg(F.min(place).alias("kept"), F.count("*").alias("times"))
        .where("times > 1")
        .select("w1", "w2", "kept")
    )
    later = (
        windows.join(repeated, ["w1", "w2"])
        .where(~place.eqNullSafe(F.col("kept")))
        .groupBy("id", "key")
        .agg(F.collect_set("first").alias("starts"))
    )
    names = docs.columns
    tagged = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col("doc_id").alias("id"),
        text_key(F.col("text")).alias("key"),
    )
    marks = later.select(F.col("id").alias("mark_id"), F.col("key").alias("mark_key"), "starts")
    joined = tagged.join(
        marks,
        tagged["id"].eqNullSafe(marks["mark_id"]) & (tagged["key"] == marks["mark_key"]),
        "left",
    )
    merged = joined.select(
        "row",
        _lines(F.col("row.text")).alias("lines"),
        F.array_distinct(
            F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (window - 1))))
        ).alias("covered"),
    ).select("row", "lines", "covered", _full_positions(F.col("lines")).alias("full"))
    kept = F.array_except(
        F.sequence(F.lit(0), F.size("lines") - 1),
        F.transform("covered", lambda k: F.get("full", k)),
    )
    text = F.when(F.col("covered").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    )
    added = {
        "n_lines": F.size("full").cast("long"),
        "n_removed_lines": F.when(F.col("covered").isNull(), 0).otherwise(F.size("covered")).cast("long"),
    }
    shown = [c for c in names if not measures or c not in added]
    return merged.select(
        *[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in shown],
        *[column.alias(name) for name, column in added.items() if measures],
    )
