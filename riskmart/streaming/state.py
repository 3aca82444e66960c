"""One decision per payment, by keyed state instead of a look at all earlier decisions.

The key of a decision is looked up in a state store of the task that owns it, so a batch
costs what its own rows cost, however many decisions there are. State lies in RocksDB on
local disks, its changes with the checkpoint; a lost executor's part is rebuilt from there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

KEY = "decision_id"
#: What decides between announcements of a payment that come in one batch.
FIRST = (("kafka_timestamp", "ascending"), ("risk_score", "ascending"))

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def first_of_each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The earliest row of every key; a task sees all rows of its keys in this batch."""
    rows = [batch for batch in batches if batch.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    table = table.take(pc.sort_indices(table, sort_keys=[(KEY, "ascending"), *FIRST]))
    keys = table.column(KEY).combine_chunks()
    new = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
    yield from table.filter(pa.concat_arrays([pa.array([True]), new])).to_batches()


def once_per_payment(decisions: DataFrame, horizon: str | None = None) -> DataFrame:
    """A stream of decisions with the first one of every payment only.

    Batches are bounded, so a task holds a bounded number of rows while it picks the first
    of a batch; a streaming plan has no sort for that. State is kept for ever, or with
    ``horizon`` that long after a decision: a payment announced again after that time is
    decided again. The clock is the time of the decision, which never runs backwards, so no
    record is too late.
    """
    firsts = decisions.repartition(KEY).mapInArrow(first_of_each, decisions.schema)
    if horizon is None:
        return firsts.dropDuplicates([KEY])
    return firsts.withWatermark("decision_time", horizon).dropDuplicatesWithinWatermark([KEY])
