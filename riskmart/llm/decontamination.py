"""Benchmark decontamination: BM25 retrieval with block-max WAND, then overlap checks.

The test items are indexed: per term the items that hold it with their BM25 weight, and
the largest weight per block of items. Weights are divided by the score an item gives
itself, so a score says which share of an item a passage covers and one threshold fits
all. The index is sent to all tasks; it is built in shards of a bounded number of words,
and each shard is one more filter over the documents in the same stage.

Every document is cut into overlapping passages, each long enough to hold any item of the
shard whole. A passage asks the index: bounds from the heavy terms of the items end most queries at
once, a block-max WAND walk over the postings finds all items above the threshold for the
rest.
What is retrieved is verified in the document around the passage: of both the question
and the answer of the item, ``OVERLAP`` percent of the words must be there in order, in a
stretch little longer than the part. So one changed word never hides a part of five words
or more; shorter parts must be there whole, as another word makes another answer.

Question and answer part at the last question mark; items without one (or with nothing
after it) have their last quarter of words as the answer.

Defined cases: NULL, empty and wordless texts, items included, match nothing; repeated
items match like one each; repeated documents are judged alike; an empty benchmark leaves
all documents; other columns pass through ``decontaminated`` untouched.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.arrays import pieces, text_bytes, word_bounds, word_hashes

THRESHOLD = 0.6
OVERLAP = 80
K1, B = 1.2, 0.75
BLOCK = 64
#: Least number of words between the starts of two passages; a passage has twice as many.
STRIDE = 64
#: Words of a shard of the index: some 100 MB in a task at most.
SHARD_WORDS = 1_000_000

MATCH_DDL = "doc_id long, item_id long, passages long, score double, question_percent int, answer_percent int"
_PLAIN = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _PLAIN[_c] = 0x20


def plain_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, without case and punctuation, and their bounds."""
    data, offsets = text_bytes(pc.utf8_lower(column))
    data = _PLAIN[data]
    starts, ends, bounds = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), bounds


def _in_order(part: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, all rows of its table at once in one number."""
    masks: dict[int, int] = {}
    for k, word in enumerate(part):
        masks[word] = masks.get(word, 0) | 1 << k
    full = (1 << len(part)) - 1
    row = full
    for word in text:
        hits = row & masks.get(word, 0)
        row = (row + hits | row - hits) & full
    return len(part) - row.bit_count()


@dataclass
class Part:
    """The words of a question or an answer."""

    words: np.ndarray

    def percent(self, words: np.ndarray, least: int) -> int:
        """Share of the part that is in order in one stretch of ``words``; 0 if below ``least``."""
        n = len(self.words)
        if not n:
            return 100
        # Inserted and lost words move the rest off its diagonal by ``slack`` at most.
        slack = max(1, n // 5)
        place, at = np.nonzero(self.words[:, None] == words[None, :])
        diagonals = np.sort(at - place)
        heads = np.unique(diagonals)
        inside = np.searchsorted(diagonals, heads + slack, "right") - np.searchsorted(diagonals, heads - slack, "left")
        part, best = self.words.tolist(), 0
        for k in np.argsort(-inside, kind="stable").tolist():
            if inside[k] <= best or 100 * int(inside[k]) < least * n:
                break
            head = int(heads[k])
            best = max(best, _in_order(part, words[max(0, head - slack) : max(0, head + n + slack)].tolist()))
        return 100 * best // n


class Index:
    """Postings of one shard of items: term -> items and weights, by item number."""

    def __init__(self, items: list[tuple[int, str]]):
        items = [(i, t or "") for i, t in items]
        asked = [t[: t.rfind("?") + 1] for _, t in items]
        rest = [t[len(q) :] for q, (_, t) in zip(asked, items)]
        words, bounds = plain_words(pa.array([t for _, t in items], pa.string()))
        heads = np.diff(plain_words(pa.array(asked, pa.string()))[1])
        tails = np.diff(plain_words(pa.array(rest, pa.string()))[1])
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        self.ids = [items[i][0] for i in full]
        self.parts = []
        for i in full:
            own = words[bounds[i] : bounds[i + 1]]
            cut = heads[i] if heads[i] and tails[i] else len(own) - max(1, len(own) // 4)
            self.parts.append((Part(own[:cut]), Part(own[cut:])) if cut else (Part(own), Part(own)))
        self.stride = max(STRIDE, int(sizes.max(initial=0)))

        number = np.repeat(np.arange(len(full)), sizes[full])
        self.terms, term = np.unique(words, return_inverse=True)
        pair, times = np.unique(term.astype(np.int64) * max(1, len(full)) + number, return_counts=True)
        term, item = np.divmod(pair, max(1, len(full)))
        df = np.bincount(term, minlength=len(self.terms))
        idf = np.log1p((len(full) - df + 0.5) / (df + 0.5))
        length = sizes[full] / max(1e-9, sizes[full].mean() if len(full) else 1)
        weight = idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * length[item]))
        weight /= np.bincount(item, weights=weight, minlength=len(full))[item]
        self.starts = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.items, self.weights = item, weight
        self.highest = np.maximum.reduceat(weight, self.starts[:-1]) if len(weight) else weight
        # Per item, its lightest terms up to half the threshold only add to a bound.
        order = np.lexsort((weight, item))
        light = np.cumsum(weight[order])
        begins = np.searchsorted(item[order], np.arange(len(full)))
        light -= np.append(0, light)[begins][item[order]]
        heavy = order[light > THRESHOLD / 2]
        self.bounds = np.ones(len(full)) - np.bincount(item[heavy], weights=weight[heavy], minlength=len(full))
        heavy.sort()
        self.heavy_items, self.heavy_weights = item[heavy], weight[heavy]
        self.heavy_starts = np.searchsorted(term[heavy], np.arange(len(self.terms) + 1))
        # Blocks of BLOCK items: first posting and largest weight of each block of a term.
        block = term * (len(full) // BLOCK + 1) + item // BLOCK
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
        self.block_of = item[first] // BLOCK
        self.block_weights = np.maximum.reduceat(weight, first) if len(first) else weight
        self.block_starts = np.searchsorted(term[first], np.arange(len(self.terms) + 1))

    def hopeful(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> np.ndarray:
        """Passages for which the bound of some item reaches the threshold.

        Only postings of an item's heavy terms are looked at; the rest of the item counts as
        if the passage had all of it. An item above the threshold has a heavy term, as its
        other terms weigh half of THRESHOLD at most.
        """
        sizes = self.heavy_starts[term + 1] - self.heavy_starts[term]
        owner = np.repeat(np.arange(len(term)), sizes)
        at = np.repeat(self.heavy_starts[term] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(owner))
        pair, place = np.unique(passage[owner] * len(self.ids) + self.heavy_items[at], return_inverse=True)
        sums = np.bincount(place, weights=self.heavy_weights[at], minlength=len(pair))
        number, item = np.divmod(pair, len(self.ids))
        return np.unique(number[sums + self.bounds[item] >= threshold - 1e-9])

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """All items with a score of at least ``threshold``: block-max WAND."""
        slack = 1e-9
        cursors = [_Cursor(self, int(t)) for t in terms]
        found = []
        while True:
            cursors = sorted((c for c in cursors if c.item is not None), key=lambda c: c.item)
            bound, pivot = 0.0, None
            for k, cursor in enumerate(cursors):
                bound += cursor.highest
                if bound >= threshold - slack:
                    pivot = k
                    break
            if pivot is None:
                return found
            at = cursors[pivot].item
            while pivot + 1 < len(cursors) and cursors[pivot + 1].item == at:
                pivot += 1
            front = cursors[: pivot + 1]
            limits = [c.block_limit(at) for c in front]
            if sum(w for w, _ in limits) < threshold - slack:
                # No item up to the end of the nearest block can reach the threshold.
                to = min(end for _, end in limits)
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1].item)
                for c in front:
                    c.seek(max(to, at + 1))
            elif cursors[0].item == at:
                score = sum(c.weight for c in front)
                if score >= threshold - slack:
                    found.append((at, score))
                for c in front:
                    c.seek(at + 1)
            else:
                for c in front:
                    if c.item < at:
                        c.seek(at)


class _Cursor:
    """A place in the postings of one term."""

    def __init__(self, index: Index, term: int):
        a, b = int(index.starts[term]), int(index.starts[term + 1])
        self.items, self.weights = index.items[a:b], index.weights[a:b]
        a, b = int(index.block_starts[term]), int(index.block_starts[term + 1])
        self.blocks, self.block_weights = index.block_of[a:b], index.block_weights[a:b]
        self.highest = float(index.highest[term])
        self.at = 0

    @property
    def item(self) -> int | None:
        return int(self.items[self.at]) if self.at < len(self.items) else None

    @property
    def weight(self) -> float:
        return float(self.weights[self.at])

    def seek(self, item: int) -> None:
        self.at += int(np.searchsorted(self.items[self.at :], item))

    def block_limit(self, item: int) -> tuple[float, int]:
        """Largest weight in the block of ``item`` and the first item behind that block."""
        k = int(np.searchsorted(self.blocks, item // BLOCK))
        if k < len(self.blocks) and self.blocks[k] == item // BLOCK:
            return float(self.block_weights[k]), (item // BLOCK + 1) * BLOCK
        return 0.0, (int(self.blocks[k]) * BLOCK if k < len(self.blocks) else 1 << 62)


def matches_of(texts: pa.Array, index: Index, threshold: float, overlap: int) -> list[tuple]:
    """(text, item id, passages, best score, question percent, answer percent) of a batch.

    ``threshold`` is above half of THRESHOLD, which the index is built for.
    """
    if not index.ids:
        return []
    words, bounds = plain_words(texts)
    place = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[place] == words)
    if not len(known):
        return []
    text = np.searchsorted(bounds, known, "right") - 1
    step = (known - bounds[text]) // index.stride
    per_text = (np.diff(bounds) - 1) // index.stride + 1
    before = np.cumsum(per_text) - per_text
    # A word lies in the passage that starts in its step and in the one before.
    own = before[text] + step
    passage = np.concatenate([own, (own - 1)[step > 0]])
    term = np.concatenate([place[known], place[known][step > 0]])
    pair = np.unique(passage * len(index.terms) + term)
    passage, term = np.divmod(pair, len(index.terms))
    edge = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    ends = np.append(edge[1:], len(term))
    hopeful = np.searchsorted(passage[edge], index.hopeful(passage, term, threshold))
    found: dict[tuple[int, int], list] = {}
    for k in hopeful.tolist():
        number = int(passage[edge[k]])
        doc = int(np.searchsorted(before, number, "right")) - 1
        while per_text[doc] == 0:
            doc -= 1
        for item, score in index.search(term[edge[k] : ends[k]], threshold):
            first = int(bounds[doc]) + (number - int(before[doc])) * index.stride
            around = words[max(int(bounds[doc]), first - index.stride) : min(int(bounds[doc + 1]), first + 3 * index.stride)]
            question, answer = (part.percent(around, overlap) for part in index.parts[item])
            if question >= overlap and answer >= overlap:
                seen = found.setdefault((doc, item), [0, 0.0, 0, 0])
                found[doc, item] = [
                    seen[0] + 1, max(seen[1], score), max(seen[2], question), max(seen[3], answer)
                ]
    return [(doc, index.ids[item], *rest) for (doc, item), rest in sorted(found.items())]


def shards(items: DataFrame, shard_words: int = SHARD_WORDS):
    """Indexes over all items, one shard after the other."""
    n = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    total = items.agg(F.sum(n)).first()[0] or 0
    count = total // shard_words + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        rows = items.where(part == k).select(F.col("item_id").cast("long"), "text").collect()
        yield Index(sorted(((r[0], r[1]) for r in rows), key=lambda x: (x[0] is None, x)))


def contaminations(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP
) -> DataFrame:
    """One row per document and item found in it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in shards(items):
        sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))

        def run(batches, sent=sent):
            index = pickle.loads(sent.value)
            types = [pa.int64()] * 3 + [pa.float64()] + [pa.int32()] * 2
            names = ["doc_id", "item_id", "passages", "score", "question_percent", "answer_percent"]
            for piece in pieces(batches):
                found = matches_of(piece.column("text"), index, threshold, overlap)
                ids = piece.column("doc_id").to_pylist()
                found = [(ids[doc], *rest) for doc, *rest in found]
                columns = zip(*found) if found else [[]] * len(names)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        part = rows.mapInArrow(run, MATCH_DDL)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP
) -> DataFrame:
    """The documents in which no item was found, with all their columns."""
    for index in shards(items):
        sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))

        def run(batches, sent=sent):
            index = pickle.loads(sent.value)
            for piece in pieces(batches):
                keep = np.ones(piece.num_rows, bool)
                keep[[doc for doc, *_ in matches_of(piece.column("text"), index, threshold, overlap)]] = False
                yield piece.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
