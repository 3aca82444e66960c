"""Bounded batches, restarts, and one decision per payment by keyed state."""

import os
import re

import pyarrow as pa
import pytest
from change_records import raw_frame, record
from pyspark.sql import functions as F

from riskmart import jobs
from riskmart.session import TIDY_SETTINGS
from riskmart.sources.change_log import BatchBound, log_from_files
from riskmart.streaming import pipeline
from riskmart.streaming.state import STATE_SETTINGS, first_of_each

RISKY = {"amount": "500.00", "login_failures": 4}


def write(spark, log, *files):
    """One log file per list of records, in order."""
    for rows in files:
        raw_frame(spark, rows).coalesce(1).write.mode("append").parquet(log)


def decided(lake):
    return sorted((r.transaction_id, r.action) for r in lake.decisions.read(pipeline.DECISIONS).collect())


def batches_of(query):
    query.awaitTermination()
    return [p for p in query.recentProgress if any(s.startOffset != s.endOffset for s in p.sources)]


@pytest.fixture
def lake(spark, tmp_path):
    return jobs.Lakehouse(spark, str(tmp_path / "house"), buckets=2, bound=BatchBound(files=1))


def ingest(spark, lake, log):
    return jobs.ingest(lake, log_from_files(spark, log, bound=lake.bound), drain=True)


def test_bounds_become_source_options():
    assert BatchBound(files=3).of_files() == {"maxFilesPerTrigger": 3}
    assert BatchBound(bytes=10).of_files() == {"maxBytesPerTrigger": 10}
    assert BatchBound().of_files() == {"maxBytesPerTrigger": 8 << 30}
    assert BatchBound(offsets=5).of_log() == {"maxOffsetsPerTrigger": 5}


def test_backlog_is_worked_off_in_bounded_batches(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    write(spark, log, *([record("customers", k, customer_id=f"c{k}")] for k in range(5)))
    assert [p.numInputRows for p in batches_of(ingest(spark, lake, log))] == [1] * 5
    by_bytes = jobs.Lakehouse(spark, str(tmp_path / "other"), bound=BatchBound(bytes=1))
    assert len(batches_of(ingest(spark, by_bytes, log))) == 5
    assert lake.bronze().count() == by_bytes.bronze().count() == 5


def test_older_change_in_a_batch_after_the_delete_stays_out(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    files = [[record("customers", 1)], [record("customers", 9, op="d")], [record("customers", 5, op="u", home_region="CA")]]
    write(spark, log, *files)
    ingest(spark, lake, log).awaitTermination()
    jobs.curate(lake, drain=True).awaitTermination()
    assert lake.silver.read("customers").count() == 0
    write(spark, log, [record("customers", 12, op="c", home_region="TX")])
    ingest(spark, lake, log).awaitTermination()
    jobs.curate(lake, drain=True).awaitTermination()
    assert [r.home_region for r in lake.silver.read("customers").collect()] == ["TX"]


@pytest.mark.parametrize("horizon", [None, "3 days"])
def test_one_decision_in_and_across_batches(spark, lake, tmp_path, horizon):
    lake.horizon, log = horizon, str(tmp_path / "log")
    # In one batch the earliest announcement counts, in any order of the rows; later batches add nothing.
    write(
        spark, log,
        [record("payments", 7, transaction_id="t1", op="r"), record("payments", 3, transaction_id="t1", **RISKY)],
        [record("payments", 1, transaction_id="t1"), record("payments", 8, transaction_id="t2")],
    )
    ingest(spark, lake, log).awaitTermination()
    assert decided(lake) == []
    jobs.decide(lake, drain=True).awaitTermination()
    assert decided(lake) == [("t1", "REVIEW"), ("t2", "APPROVE")]
    # The stream stops, the payments are announced again, and it goes on from its state.
    write(spark, log, [record("payments", 20, transaction_id=t, op="r", **RISKY) for t in ("t1", "t2", "t3")])
    ingest(spark, lake, log).awaitTermination()
    query = jobs.decide(lake, drain=True)
    query.awaitTermination()
    assert decided(lake) == [("t1", "REVIEW"), ("t2", "APPROVE"), ("t3", "REVIEW")]
    assert sum(s.numRowsTotal for s in query.lastProgress.stateOperators) == 3
    assert any("rocksdb" in k for k in query.lastProgress.stateOperators[0].customMetrics)


def files_below(folder, end):
    return [f"{at}/{name}" for at, _, names in os.walk(folder) for name in names if name.endswith(end)]


def test_batches_leave_no_shuffle_cache_or_scratch_behind(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    write(spark, log, *([record("payments", 10 * k + j, transaction_id=f"t{j}") for j in range(9)] for k in range(3)))
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = lambda: set(re.findall(r"(?:shuffle|rdd)_\w+", disk.getAllFiles().mkString(" ")))
    before = blocks()
    ingest(spark, lake, log).awaitTermination()
    for start in (jobs.curate, jobs.decide):
        start(lake, drain=True).awaitTermination()
    assert blocks() <= before
    assert not files_below(f"{lake.root}/silver/_scratch", ".parquet")
    assert lake.silver.read("payments").count() == lake.decisions.read(pipeline.DECISIONS).count() == 9
    written = [f for folder in ("bronze", "decisions") for f in files_below(f"{lake.root}/{folder}", ".parquet")]
    assert written and all(".zstd." in f for f in written)


def test_a_store_with_a_history_does_not_grow_by_its_past(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    write(spark, log, *([record("customers", 5 * k + j, customer_id=f"c{j}", op="u") for j in range(4)] for k in range(4)))
    ingest(spark, lake, log).awaitTermination()
    short = jobs.Lakehouse(spark, lake.root, buckets=2, bound=lake.bound, history=1)
    assert len(batches_of(jobs.curate(short, drain=True))) == 4
    assert sorted(r._source_lsn for r in short.silver.read("customers").collect()) == [15, 16, 17, 18]
    named = {f for e in short.silver._latest()[1].values() for parts in e["folders"].values() for f in parts}
    assert {os.path.dirname(f) for f in files_below(f"{lake.root}/silver", ".parquet")} == named
    assert len(files_below(f"{lake.root}/silver/_manifests", ".json")) == 1


def test_rejected_records_keep_their_text(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    bad = record("payments", 2, amount="-1.00")
    write(spark, log, [record("payments", 1, transaction_id="t1"), bad, record("orders", 3)])
    ingest(spark, lake, log).awaitTermination()
    jobs.curate(lake, drain=True).awaitTermination()
    assert [r.raw_payload for r in lake.silver.read(pipeline.QUARANTINE).collect()] == [bad[5].decode()]


def test_settings_of_the_caller_are_left_alone(spark, lake, tmp_path):
    before = {key: spark.conf.get(key, None) for key in (*STATE_SETTINGS, *TIDY_SETTINGS)}
    write(spark, str(tmp_path / "log"), [record("payments", 1)])
    ingest(spark, lake, str(tmp_path / "log")).awaitTermination()
    jobs.decide(lake, drain=True).awaitTermination()
    assert {key: spark.conf.get(key, None) for key in before} == before


def test_stop_in_the_middle_and_restart(spark, lake, tmp_path):
    log = str(tmp_path / "log")
    write(spark, log, *([record("customers", k, customer_id=f"c{k}")] for k in range(6)))
    source = log_from_files(spark, log, bound=lake.bound)
    run = pipeline.run_twice(lambda drain: jobs.ingest(lake, source, drain), after=2)
    assert run == pipeline.Run(batches=6, starts=2)
    assert sorted(r.offset for r in lake.bronze().collect()) == list(range(6))


def test_first_of_each_takes_any_batches():
    rows = [("b", 2, 5), ("a", 9, 1), ("b", 2, 3), ("a", 4, 7), ("c", None, 0)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("decision_id", "kafka_timestamp", "risk_score"), r)) for r in rows])
    found = [tuple(r.values()) for b in first_of_each([batch, batch.slice(0, 0), batch]) for r in b.to_pylist()]
    assert found == [("a", 4, 7), ("b", 2, 3), ("c", None, 0)]
    assert list(first_of_each([])) == list(first_of_each([batch.slice(0, 0)])) == []


def test_days_of_a_backlog_are_not_split_by_its_tasks(spark, tmp_path):
    lake = jobs.Lakehouse(spark, str(tmp_path / "house"), bound=BatchBound(files=6))
    log = str(tmp_path / "log")
    days = [f"2024-03-0{k} 10:00:00" for k in range(1, 6)]
    for part in range(6):
        rows = raw_frame(spark, [record("customers", 10 * part + k, customer_id=f"c{k}") for k in range(5)])
        when = F.element_at(F.array(*map(F.lit, days)), (F.col("offset") % 10 + 1).cast("int"))
        rows.withColumn("timestamp", when.cast("timestamp")).coalesce(1).write.mode("append").parquet(log)
    assert len(batches_of(ingest(spark, lake, log))) == 1
    found = lake.bronze()
    assert found.count() == 30 and len(found.inputFiles()) == 5
