"""The corpus pipeline: every stage takes effect on its own input."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from riskmart.llm import arrays, lsh_forest

SMALL = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("kept", F.lit(1)).withColumn("id", F.lit(2))
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] > 0
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    plain = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    texts = [plain(r.text) for r in docs.collect()]
    assert not any(plain(item) in text for item in items for text in texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(found.columns)
    assert found.count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_functions_travel_without_what_the_driver_worked_out():
    """The index of benchmark items hashes on the driver; powers of 33 MB went with every later function."""
    data = np.frombuffer(b"some words", np.uint8)
    hashes = arrays.word_hashes(data, np.array([0, 5]), np.array([4, 10]))
    assert arrays._POWERS
    for function in (lsh_forest._signatures(5), lsh_forest._confirm(5, 80), lsh_forest._dense(5, 80)):
        assert len(cloudpickle.dumps(function)) < 1 << 20
    there = cloudpickle.loads(cloudpickle.dumps(arrays.word_hashes))
    assert (there(data, np.array([0, 5]), np.array([4, 10])) == hashes).all()
