"""Ranked lexical search: exact BM25-like scores with geometric blocking of posting lists.

Terms are the runs of digits, letters and characters beyond ASCII, A-Z in lower case. With N
documents that have terms, L terms in all, n in a document, df documents that hold a term and tf
its occurrences, a term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); a document's m is
100 - 25 + 25 n N div L, and it scores w (10^9 tf div (1000 tf + 12 m)) for every term of an
item, repeats included. All but w is integer arithmetic, so scores are exact and ties are real.

Items are the stated query set. They are taken in groups of a bounded number of different terms;
one pass turns every document into the counts of the group's terms, kept as a table. From it
come N, L and df, by aggregation. The search runs over shards of that table, documents by their
scan order, so no posting list is shuffled and a frequent term is spread like the documents.
Inside a shard, per term from the heaviest to the lightest:

* the posting list is clustered: documents go to the most similar of evenly spaced ones;
* a block keeps the coordinatewise maximum of its documents, over the terms still to come;
* a block is skipped for an item only if the exact product of item and summary stays below the
  item's k-th best score; the documents of all other blocks are scored in full;
* an item is finished when even the summary of all lists still to come stays below.

Documents without any term worth something score 0 and are never returned. Similarity decides
which documents share a block, never the result.

Defined cases: NULL, empty and termless texts have no terms, are not counted in N and match
nothing, as items they return nothing; repeated documents are ranked each, in any order among
themselves, and repeated items get a ranking each; a NULL doc_id comes after all others of the
same score; other columns are not looked at; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.arrays import pieces, text_bytes, word_bounds
from riskmart.llm.common import stored

#: Different terms and items of a group; a longer item is a group of its own.
GROUP_TERMS, GROUP_ITEMS = 4096, 1024
#: Documents times terms that are searched at once.
SHARD_CELLS = 1 << 24

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_TERM_BYTES = np.arange(256, dtype=np.uint8)
for _c in range(128):
    _TERM_BYTES[_c] = ord(chr(_c).lower()) if chr(_c).isalnum() else 0x20

VECTOR_DDL = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND_DDL = "number long, item_id long, doc_id long, score long"


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(_LOWER))


@dataclass
class Group:
    """Items with their terms; ``first`` numbers them through all groups."""

    first: int
    item_ids: list[int | None] = field(default_factory=list)
    counts: list[Counter] = field(default_factory=list)
    terms: set[str] = field(default_factory=set)


def groups(items: Iterable[tuple[int | None, str | None]]) -> Iterator[Group]:
    group = Group(0)
    for item_id, text in items:
        counts = Counter(terms_of(text))
        if not counts:
            continue
        full = len(group.terms | counts.keys()) > GROUP_TERMS or len(group.item_ids) >= GROUP_ITEMS
        if full and group.item_ids:
            yield group
            group = Group(group.first + len(group.item_ids))
        group.item_ids.append(item_id)
        group.counts.append(counts)
        group.terms |= counts.keys()
    if group.item_ids:
        yield group


def term_vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, number of terms, and the given terms (by place in ``terms``) with their counts."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array([t.encode() for t in terms], pa.large_binary())
        for batch in pieces(batches):
            data, offsets = text_bytes(batch.column("text"))
            data = _TERM_BYTES[data]
            starts, ends, bounds = word_bounds(data, offsets)
            at = np.append(0, np.cumsum(ends - starts))
            buffers = [None, pa.py_buffer(at), pa.py_buffer(data[data != 0x20])]
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers)
            found = pc.index_in(words, value_set=known)
            hits = np.flatnonzero(np.asarray(found.is_valid()))
            term = np.asarray(found.drop_null(), dtype=np.int64)
            row = np.searchsorted(bounds, hits, "right") - 1
            pairs, times = np.unique(row * len(terms) + term, return_counts=True)
            row, term = np.divmod(pairs, len(terms))
            lists = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            columns = [
                batch.column("doc_id"),
                pa.array(np.diff(bounds), pa.int64()),
                pa.ListArray.from_arrays(lists, pa.array(term, pa.int32())),
                pa.ListArray.from_arrays(lists, pa.array(times, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(counted, VECTOR_DDL)


class Search:
    """The k best documents of each item among the shards seen so far."""

    def __init__(self, weights: np.ndarray, counts: list[dict[int, int]], total: int, length: int, k: int):
        # Heaviest term first: the thresholds rise early, and what is left is light.
        order = np.argsort(-weights, kind="stable")
        self.place = np.empty(len(weights), np.int64)
        self.place[order] = np.arange(len(weights))
        self.total, self.length, self.k = total, length, k
        weight = weights[order]
        gains = np.zeros((len(weights), len(counts)), np.int64)
        for q, own in enumerate(counts):
            for term, times in own.items():
                gains[self.place[term], q] = weight[self.place[term]] * times
        # Products of whole numbers are exact in doubles below 2**53; a term gives up to 10**6.
        exact = int(gains.sum(axis=0).max(initial=0)) * 10**6 < 1 << 53
        self.gains = gains.astype(np.float64 if exact else np.int64)
        self.own = [np.flatnonzero(gains[:, q]) for q in range(len(counts))]
        self.asked = [np.flatnonzero(row) for row in gains]
        none = np.zeros(0, np.int64)
        self.best = [(none, none.astype(bool), none) for _ in counts]
        self.least = np.ones(len(counts), self.gains.dtype)

    def _blocks(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order of the documents and the starts of the blocks in it."""
        n = len(vectors)
        width = math.isqrt(n - 1) + 1 if n > 4 else 1
        if width == 1:
            return np.arange(n), np.zeros(1, np.int64)
        centres = vectors[np.linspace(0, n - 1, width).astype(np.int64)]
        centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1)
        block = np.argmax(vectors @ centres.T, axis=1)
        order = np.argsort(block, kind="stable")
        return order, np.flatnonzero(np.diff(block[order], prepend=-1))

    def _take(self, q: int, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        mine = scores >= self.least[q]
        old = self.best[q]
        scores, nulls, ids = (
            np.concatenate([a, b[mine]]) for a, b in zip(old, (scores.astype(np.int64), nulls, ids))
        )
        first = np.lexsort((ids, nulls, -scores))[: self.k]
        self.best[q] = scores[first], nulls[first], ids[first]
        if len(first) == self.k:
            self.least[q] = max(1, scores[first[-1]])

    def add(self, ids: np.ndarray, nulls: np.ndarray, n: np.ndarray, row, term, times) -> None:
        """Searches one shard: documents and their (row, term, times) entries."""
        m = 75 + 25 * n * self.total // self.length
        value = 10**9 * times // (1000 * times + 12 * m[row])
        term = self.place[term]
        vectors = np.zeros((len(ids), len(self.place)), np.float32)  # whole numbers up to 10**6
        vectors[row, term] = value
        order = np.argsort(term, kind="stable")
        lists, starts = row[order], np.searchsorted(term[order], np.arange(len(self.place) + 1))
        kind = self.gains.dtype
        left = vectors.max(axis=0, initial=0).astype(kind) @ self.gains
        heaviest = vectors.max(axis=0, initial=0).astype(kind)
        seen = np.zeros((len(self.own), len(ids)), bool)
        for t, asked in enumerate(self.asked):
            docs = lists[starts[t] : starts[t + 1]]
            if not len(docs):
                continue
            asked_now = asked[left[asked] >= self.least[asked]]
            left[asked] -= heaviest[t] * self.gains[t, asked]
            if not len(asked_now):
                continue
            axes = np.unique(np.concatenate([own[np.searchsorted(own, t) :] for own in (self.own[q] for q in asked_now)]))
            near = vectors[np.ix_(docs, axes)]
            order, begins = self._blocks(near)
            summaries = np.maximum.reduceat(near[order], begins, axis=0).astype(kind)
            bounds = summaries @ self.gains[np.ix_(axes, asked_now)]
            sizes = np.diff(np.append(begins, len(docs)))
            for column, q in enumerate(asked_now.tolist()):
                opened = bounds[:, column] >= self.least[q]
                if not opened.any():
                    continue
                rows = docs[order[np.repeat(opened, sizes)]]
                rows = rows[~seen[q, rows]]
                seen[q, rows] = True
                own = self.own[q]
                self._take(q, vectors[np.ix_(rows, own)].astype(kind) @ self.gains[own, q], nulls[rows], ids[rows])


def _shards(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - size)
            batch = batch.slice(part.num_rows)
            held.append(part)
            size += part.num_rows
            if size == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _searched(vectors: DataFrame, group: Group, terms: list[str], k: int) -> DataFrame:
    """The k best documents of each item per task."""
    total, length = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
    frequency = {r["term"]: r["count"] for r in held.collect()}  # a row per term of the group at most
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * frequency.get(i, 0) + 1))) for i in range(len(terms))])
    number = {t: i for i, t in enumerate(terms)}
    counts = [{number[t]: times for t, times in own.items() if number[t] in frequency} for own in group.counts]
    item_ids, first = group.item_ids, group.first
    shard_rows = max(64, SHARD_CELLS // len(terms))

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(weights, counts, total, length, k)
        for shard in _shards(batches, shard_rows):
            ids, n, found, times = (c.chunk(0) for c in shard.columns)
            row = np.repeat(np.arange(len(ids)), np.asarray(pc.list_value_length(found), dtype=np.int64))
            search.add(
                np.asarray(pc.fill_null(ids, 0)), np.asarray(ids.is_null()), np.asarray(n), row,
                np.asarray(found.flatten(), dtype=np.int64), np.asarray(times.flatten(), dtype=np.int64),
            )
        for q, (scores, nulls, ids) in enumerate(search.best):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), first + q)),
                    pa.array([item_ids[q]] * len(ids), pa.int64()),
                    pa.array(ids, pa.int64(), mask=nulls),
                    pa.array(scores, pa.int64()),
                ],
                ["number", "item_id", "doc_id", "score"],
            )

    return vectors.where(F.size("terms") > 0).mapInArrow(searched, FOUND_DDL)


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item."""
    found = []
    for group in groups(map(tuple, items.selectExpr("CAST(item_id AS LONG)", "text").toLocalIterator())):
        terms = sorted(group.terms)
        vectors = stored(term_vectors(docs, terms), "term-vectors")
        found.append(stored(_searched(vectors, group, terms, k), "search"))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
