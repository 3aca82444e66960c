"""Ranked lexical search against scoring every document in plain Python."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
from helpers import AWKWARD, PROSE, SCHEMA, frame
from pyspark.sql import functions as F

from riskmart.llm import lexical_search
from riskmart.llm.lexical_search import Search, groups, ranked, terms_of

ITEMS = [
    (1, "The baker and the harvest of the quiet town"),
    (2, None),
    (3, "... !"),
    (4, "ONE one l1 B ü€😀 \x1cx a"),
    (4, "ONE one l1 B ü€😀 \x1cx a"),
    (None, "street mud 7"),
    (6, "nowhere to be found"),
]


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def plain(rows, items, k):
    counted = [(i, collections.Counter(terms(t))) for i, t in rows]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        asked, found = collections.Counter(terms(text)), []
        for i, c, n in counted:
            m, score = 75 + 25 * n * total // length, 0
            for t, times in asked.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score:
                found.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if null else i, -score))
    return collections.Counter(out)


def crowd(seed, size):
    """Copies, near copies and unrelated texts over few words, so that scores tie."""
    chance = random.Random(seed)
    vocabulary = [f"w{int(chance.paretovariate(0.5))}" for _ in range(400)]
    base = chance.choices(vocabulary, k=40)
    rows = [(i, " ".join(base[: chance.randint(30, 40)])) for i in range(size // 3)]
    rows += [(size + i, " ".join(chance.choices(vocabulary, k=chance.randint(1, 60)))) for i in range(size - len(rows))]
    chance.shuffle(rows)
    items = [(i, " ".join(chance.choices(vocabulary, k=chance.randint(1, 30)))) for i in range(25)]
    return rows, [*items, (99, " ".join(base))]


def test_awkward_rows(spark):
    docs = frame(spark, AWKWARD).withColumns({"item_id": F.lit(1), "rank": F.lit(2), "score": F.lit("x")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("number", F.lit(0))
    found = ranked(docs.repartition(3), items).collect()
    assert collections.Counter(map(tuple, found)) == plain(AWKWARD, ITEMS, 20)


@pytest.mark.parametrize("cells", [1 << 24, 1 << 10])
def test_crowds_and_ties(spark, monkeypatch, cells):
    monkeypatch.setattr(lexical_search, "SHARD_CELLS", cells)
    rows, items = crowd(3, 900)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = ranked(frame(spark, rows).repartition(2), asked, k=7).collect()
    assert collections.Counter(map(tuple, found)) == plain(rows, items, 7)


def test_groups_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "GROUP_TERMS", 40)
    monkeypatch.setattr(lexical_search, "GROUP_ITEMS", 9)
    rows, items = crowd(4, 200)
    made = list(groups(items))
    assert len(made) > 3 and sum(len(g.item_ids) for g in made) == len(items)
    assert [g.first for g in made] == np.cumsum([0, *(len(g.item_ids) for g in made[:-1])]).tolist()
    found = ranked(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert collections.Counter(map(tuple, found)) == plain(rows, items, 20)


def test_very_long_text_and_item(spark):
    rows = [(1, PROSE * 20_000), (2, PROSE), (3, "mud " * 100_000)]
    items = [(1, PROSE), (2, " ".join(f"x{k}" for k in range(6000)) + " mud mud")]
    found = ranked(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert collections.Counter(map(tuple, found)) == plain(rows, items, 20)


def test_empty_tables(spark):
    asked = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked(spark.createDataFrame([], SCHEMA), asked).count() == 0
    assert ranked(frame(spark, AWKWARD), asked.limit(0)).count() == 0


def test_terms():
    assert terms_of("A-b_c É1\x7f\x80z  ÀÉ") == terms("A-b_c É1\x7f\x80z  ÀÉ") == ["a", "b", "c", "É1", "\x80z", "ÀÉ"]


@pytest.mark.parametrize("seed", range(6))
def test_blocks_are_skipped_but_nothing_is_lost(seed):
    """Random vectors in shards: the same best documents as full scoring, fewer scored."""
    chance = np.random.default_rng(seed)
    n, t, k = 3000, 60, 5
    weights = np.sort(chance.integers(0, 9000, t))[::-1].copy()
    counts = [{int(x): int(chance.integers(1, 3)) for x in chance.choice(t, 8, replace=False)} for _ in range(12)]
    topic = chance.integers(0, 30, n)
    likely = chance.random((30, t)) ** 6
    times = (chance.random((n, t)) < likely[topic]) * chance.integers(1, 4, (n, t))
    length = np.maximum(times.sum(axis=1), 1)
    search = Search(weights, counts, n, int(length.sum()), k)
    scored = []
    take = search._take
    search._take = lambda q, scores, *rest: (scored.append(len(scores)), take(q, scores, *rest))
    for a in range(0, n, 1000):
        row, term = np.nonzero(times[a : a + 1000])
        search.add(np.arange(a, a + 1000), np.zeros(1000, bool), length[a : a + 1000], row, term, times[a : a + 1000][row, term])
    m = 75 + 25 * length * n // length.sum()
    value = np.where(times > 0, 10**9 * times // (1000 * times + 12 * m[:, None]), 0)
    for q, own in enumerate(counts):
        full = sum(value[:, x] * int(weights[x]) * c for x, c in own.items())
        want = np.lexsort((np.arange(n), -full))[:k]
        assert search.best[q][2].tolist() == want.tolist()
        assert search.best[q][0].tolist() == full[want].tolist()
    assert sum(scored) < sum(int((value[:, list(own)].sum(axis=1) > 0).sum()) for own in counts) / 2


def test_scores_beyond_doubles_stay_exact():
    search = Search(np.array([9000]), [{0: 10**7}], 2, 2, 1)
    assert search.gains.dtype == np.int64
    search.add(np.array([5, 6]), np.zeros(2, bool), np.array([1, 1]), np.array([0, 1]), np.array([0, 0]), np.array([3, 3]))
    assert search.best[0][0].tolist() == [9000 * 10**7 * (3 * 10**9 // (3000 + 12 * 100))]
    assert search.best[0][2].tolist() == [5]
