"""Toxicity scores by a factorization machine over hashed terms.

Terms are the words of a text without case and punctuation, and the first letters of longer
words (inflected insults share them). A text is the set of its terms. The machine adds to
the linear weights a product of factors for every pair of terms, so an insult next to a
group name may weigh more than both alone:

    score = sigmoid(bias + sum_i w_i + sum_{i<j} <v_i, v_j>)

Labels are learned from at most ``SAMPLE_ROWS`` labelled documents, those with the smallest
hash of their id; their hashed terms, not their texts, come to the driver. Of all terms the
``TERMS`` with the largest chi-square statistic are kept. Scores are computed for every
document, over its whole text, in the scan.

Defined cases: NULL and empty texts get the score of the bias; a term counts once per
text; unlabelled and NULL-labelled rows are not learned from; without labels of both
kinds every score is the smoothed share of label 1 (0.5 without any label); repeated rows
are scored alike; other columns are not read.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.arrays import U64, Stretches, mixed, pieces, text_bytes, word_bounds
from riskmart.llm.decontamination import _PLAIN

SAMPLE_ROWS = 20_000
BUCKET_BITS = 20
TERMS = 4096
FACTORS = 8
PREFIX = 4
EPOCHS, BATCH, RATE, DECAY = 8, 256, 0.05, 1e-5
#: Small samples are gone through more often, for this many steps at least.
LEAST_STEPS = 400
#: Documents that must hold a term before it is looked at.
LEAST_DOCS = 3


def hashed_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of the terms of a batch, each once per text."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    data = _PLAIN[data]
    starts, ends, bounds = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = Stretches(data.astype(U64) + U64(1))
    text = np.searchsorted(bounds, np.arange(len(starts)), "right") - 1
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    letter = np.searchsorted(begins, starts)
    after = np.append(begins, np.full(PREFIX + 1, len(data)))[letter + PREFIX]
    long_ = np.flatnonzero(after < ends)
    words = mixed(sums.of(starts, ends), 21)
    heads = mixed(sums.of(starts[long_], after[long_]), 22)
    bucket = (np.concatenate([words, heads]) >> U64(64 - BUCKET_BITS)).astype(np.int64)
    pair = np.unique(np.concatenate([text, text[long_]]) << BUCKET_BITS | bucket)
    return pair >> BUCKET_BITS, pair & ((1 << BUCKET_BITS) - 1)


@dataclass
class Machine:
    """slot[bucket] is the number of a kept term or -1."""

    slot: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        return _sigmoid(_margins(rows, terms, n, self.bias, self.weights, self.factors)[0])

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        rows, buckets = hashed_terms(texts)
        terms = self.slot[buckets]
        return self.scores(rows[terms >= 0], terms[terms >= 0], len(texts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _margins(rows, terms, n, bias, weights, factors):
    linear = np.bincount(rows, weights=weights[terms], minlength=n)
    v = factors[terms]
    sums = np.stack([np.bincount(rows, weights=v[:, f], minlength=n) for f in range(v.shape[1])], axis=1)
    squares = np.bincount(rows, weights=(v**2).sum(axis=1), minlength=n)
    return bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums, v


def fit(rows: np.ndarray, buckets: np.ndarray, labels: np.ndarray) -> Machine:
    """A machine from (row, bucket) pairs sorted by row, and 0/1 labels per row."""
    n, positive = len(labels), int(labels.sum())
    slot = np.full(1 << BUCKET_BITS, -1, np.int32)
    prior = (positive + 1) / (n + 2)
    bias = float(np.log(prior / (1 - prior)))
    if positive in (0, n):
        return Machine(slot, bias, np.zeros(1), np.zeros((1, FACTORS)))
    seen = np.bincount(buckets, minlength=1 << BUCKET_BITS).astype(float)
    hits = np.bincount(buckets, weights=labels[rows], minlength=1 << BUCKET_BITS)
    expected = seen * positive / n
    rest = np.maximum(seen - expected, 1e-9)
    chi = (hits - expected) ** 2 / np.maximum(expected, 1e-9) + (hits - expected) ** 2 / rest
    chi[seen < LEAST_DOCS] = 0
    kept = np.argsort(-chi, kind="stable")[:TERMS]
    kept = kept[chi[kept] > 0]
    slot[kept] = np.arange(len(kept))
    terms = slot[buckets]
    rows, terms = rows[terms >= 0], terms[terms >= 0]
    bounds = np.searchsorted(rows, np.arange(n + 1))

    random = np.random.default_rng(7)
    m = max(1, len(kept))
    weights, factors = np.zeros(m), random.normal(0, 0.01, (m, FACTORS))
    g_bias, g_weights, g_factors = 1e-6, np.full(m, 1e-6), np.full((m, FACTORS), 1e-6)
    for _ in range(max(EPOCHS, LEAST_STEPS * BATCH // n)):
        order = random.permutation(n)
        for at in range(0, n, BATCH):
            docs = order[at : at + BATCH]
            sizes = bounds[docs + 1] - bounds[docs]
            row = np.repeat(np.arange(len(docs)), sizes)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + bounds[docs][row]
            term = terms[place]
            margin, sums, v = _margins(row, term, len(docs), bias, weights, factors)
            error = (_sigmoid(margin) - labels[docs]) / len(docs)
            step = error.sum()
            g_bias += step**2
            bias -= RATE * step / np.sqrt(g_bias)
            used, inverse = np.unique(term, return_inverse=True)
            if not len(used):
                continue
            d_w = np.bincount(inverse, weights=error[row]) + DECAY * weights[used]
            d_v = error[row][:, None] * (sums[row] - v)
            d_v = np.stack([np.bincount(inverse, weights=d_v[:, f]) for f in range(FACTORS)], axis=1)
            d_v += DECAY * factors[used]
            g_weights[used] += d_w**2
            g_factors[used] += d_v**2
            weights[used] -= RATE * d_w / np.sqrt(g_weights[used])
            factors[used] -= RATE * d_v / np.sqrt(g_factors[used])
    return Machine(slot, float(bias), weights, factors)


def held_out(doc_id: Column) -> Column:
    """One fifth of all ids, never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(sample_rows)
    )
    # At most sample_rows pairs of numbers: small enough to send to every task.
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")

    def run(batches):
        for piece in pieces(batches):
            rows, buckets = hashed_terms(piece.column("text"))
            cuts = np.searchsorted(rows, np.arange(1, piece.num_rows))
            lists = [x.astype("<i4").tobytes() for x in np.split(buckets, cuts)]
            yield pa.record_batch(
                [piece.column("doc_id").cast(pa.int64()), piece.column("toxic"), pa.array(lists, pa.binary())],
                names=["doc_id", "toxic", "terms"],
            )

    found = chosen.select("doc_id", "toxic", "text").mapInArrow(run, "doc_id long, toxic int, terms binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["toxic"], bytes(r["terms"])))
    terms = [np.frombuffer(r["terms"], "<i4") for r in found]
    rows = np.repeat(np.arange(len(found)), [len(t) for t in terms])
    buckets = np.concatenate(terms).astype(np.int64) if terms else np.zeros(0, np.int64)
    return fit(rows, buckets, np.array([r["toxic"] == 1 for r in found], float))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(machine))

    def run(batches):
        machine = pickle.loads(sent.value)
        for piece in pieces(batches):
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(machine.of_texts(piece.column("text")), pa.float64())],
                names=["doc_id", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
