"""The three streams: log to bronze, bronze to silver, payments to decisions.

Each stream restarts from its checkpoint and takes bounded batches. The file sinks of
bronze and of the decisions commit a batch once. Silver may see a batch again after a
crash, and applying it again changes nothing: merges only take newer versions, and the
quarantine is keyed.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskmart.contracts import DECISION_DDL, ENTITIES, QUARANTINE_DDL, schema_of
from riskmart.operators.latest import newest_per_key
from riskmart.plans.decisions import decide, new_payments
from riskmart.plans.silver_cdc import checked_records, newest_changes, parse_records, rejected_of_all
from riskmart.session import TIDY_SETTINGS, scoped_settings
from riskmart.sources.change_log import bronze_rows
from riskmart.sources.snapshot_store import SnapshotStore
from riskmart.streaming.state import STATE_SETTINGS, once_per_payment

QUARANTINE = "cdc_quarantine"
DECISIONS = "fraud_decisions"
TRIGGER_INTERVAL = "5 seconds"
#: The file sink writes by the settings of its caller's session, whatever the stream's are.
FILE_CODEC = TIDY_SETTINGS["spark.sql.parquet.compression.codec"]


def _start(rows: DataFrame, writer: DataStreamWriter, checkpoint: str, drain: bool, **settings: str) -> StreamingQuery:
    """Run for ever, or with ``drain`` until everything present now is processed.

    A stream takes its settings when it starts.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=TRIGGER_INTERVAL)
    with scoped_settings(rows.sparkSession, {**TIDY_SETTINGS, **settings}):
        return writer.start()


@dataclass(frozen=True)
class Run:
    """What a stream did: batches with rows, over all its starts."""

    batches: int
    starts: int


def run_twice(start: Callable[[bool], StreamingQuery], after: int = 2, patience: float = 600) -> Run:
    """Start a stream on its timer, stop it after some batches, and let a second start finish.

    The stop falls into the next batch, which the second start takes from the checkpoint
    again. Shows that a restart loses and repeats nothing.
    """
    query, until = start(False), time.monotonic() + patience
    seen: set[int] = set()

    def note() -> None:
        moved = (p for p in query.recentProgress if any(s.startOffset != s.endOffset for s in p.sources))
        seen.update(p.batchId for p in moved)

    while len(seen) < after and query.isActive and time.monotonic() < until:
        time.sleep(0.2)
        note()
    query.stop()
    note()
    query = start(True)
    query.awaitTermination()
    note()
    return Run(len(seen), 2)


def start_bronze(records: DataFrame, folder: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    # Every day's rows go to a few tasks: without that each task writes a file per day, and
    # a backlog has days as well as tasks in proportion to its size.
    writer = (
        bronze_rows(records)
        .hint("rebalance", "ingest_date")
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("ingest_date")
        .option("path", folder)
        .option("compression", FILE_CODEC)
    )
    return _start(records, writer, checkpoint, drain)


def apply_changes(store: SnapshotStore, batch: DataFrame) -> None:
    """Merge one batch of bronze rows into the current-state tables and the quarantine.

    Each record is parsed once, by the fields of its topic; the checked rows lie in the store's
    scratch folder until the batch is done, with the text of rejected records only.
    """
    checked = []
    try:
        for entity in ENTITIES:
            rows = store.scratch(entity.name, checked_records(parse_records(batch, entity)))
            store.merge_entity(newest_changes(rows, entity), entity, stored=True)
            checked.append(rows)
        store.ensure(QUARANTINE, schema_of(QUARANTINE_DDL), ["quarantine_id"])
        store.upsert(QUARANTINE, rejected_of_all(checked), ["quarantine_id"], stored=True)
    finally:
        store.drop_scratch(*(entity.name for entity in ENTITIES))


def start_silver(bronze: DataFrame, store: SnapshotStore, checkpoint: str, drain: bool = False) -> StreamingQuery:
    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_changes(store, batch)

    return _start(bronze, bronze.writeStream.foreachBatch(apply), checkpoint, drain)


def apply_decisions(store: SnapshotStore, batch: DataFrame) -> None:
    """Decide a batch's payments into a keyed table; a payment decided before keeps its decision.

    For loads outside a stream, as it reads the buckets of the table that the batch touches.
    """
    earliest = [-F.unix_micros("kafka_timestamp"), -F.col("risk_score")]
    decided = newest_per_key(decide(new_payments(batch)), ["decision_id"], earliest)
    store.ensure(DECISIONS, schema_of(DECISION_DDL), ["decision_id"])
    store.add_absent(DECISIONS, decided, ["decision_id"])


def start_decisions(
    bronze: DataFrame, folder: str, checkpoint: str, drain: bool = False, horizon: str | None = None
) -> StreamingQuery:
    """Scores straight from the bronze rows of the payments topic, into files that only grow.

    A batch is committed by the sink once, and the state of its checkpoint knows every
    payment that was decided before.
    """
    decided = once_per_payment(decide(new_payments(bronze)), horizon)
    writer = decided.writeStream.format("parquet").outputMode("append").option("path", folder)
    writer = writer.option("compression", FILE_CODEC)
    return _start(bronze, writer, checkpoint, drain, **STATE_SETTINGS)
