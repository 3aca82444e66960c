"""The trie against a plain one, and its rollup against sums over parents."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from riskmart.llm import conversation_trie as module
from riskmart.llm.conversation_trie import conversation_trie, subtree_totals

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

AWKWARD = [
    (0, 1, "user", "hello there"), (0, None, None, None), (0, 2, "user", ""), (0, 3, "a", "four words in here"),
    (1, 0, "user", "own turn"), (1, 0, "user", "own turn"), (1, 5, None, "later one"),
    (3, 0, "user", "x"), (7, 2, "bot", "tie b"), (7, 2, "bot", "tie a"), (7, 2, "bo", "ttie a"), (7, 3, "q", "z z"),
    (21, 0, "user", "no donor"), (21, 1, "user", "second"), (21, 2, "user", "third"), (21, 3, "user", "fourth"),
    (-3, 0, "user", "hello there"), (-3, 1, "a", "b c"), (None, 0, "user", "lost"), (40, 0, "user", "own turn"),
    (45, 0, "user", "\x1c odd\tblank"), (45, 1, "user", "é €"), (45, 2, "user", "é €"), (45, 3, "user", "é €"),
]


def word_count(text):
    return len([w for w in text.translate({c: 32 for c in (9, 10, 11, 12, 13)}).split(" ") if w])


def plain(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(t)] for c, t in turns.items()}
    members = collections.defaultdict(list)
    for c, mine in own.items():
        donor = c - (c % 20 if c >= 0 else -(-c % 20))
        h = zlib.crc32(str(c).encode()) % 4
        full = tuple(own.get(donor, [])[:h] + mine[h:])
        for d in range(len(full) + 1):
            members[full[:d]].append((c, len(full) == d))
    kids = collections.Counter(p[:-1] for p in members if p)
    sums = {p: [int(not kids[p]), (len(m) - 1) * word_count(p[-1][1]) if p else 0] for p, m in members.items()}
    totals = {p: list(v) for p, v in sums.items()}
    for p in members:
        for d in range(len(p)):
            totals[p[:d]][0] += sums[p][0]
            totals[p[:d]][1] += sums[p][1]
    low = {p: min(c for c, _ in m) for p, m in members.items()}
    return collections.Counter(
        (
            low[p], len(p), low[p[:-1]] if p else None, len(m), kids[p], totals[p][0], totals[p][1],
            hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in m if end)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def shared_starts(seed, size):
    """Conversations that share beginnings, a third of them copies, and one that is very long."""
    chance = random.Random(seed)
    rows, starts = [], [[]]
    for c in chance.sample(range(3 * size), size):
        turns = list(chance.choice(starts[-30:]))[: chance.randint(0, 6)]
        turns += [f"t{chance.randint(0, 3)} w w"[: chance.choice([2, 4, 6])] for _ in range(chance.randint(0, 3))]
        turns = turns if chance.random() < 0.66 else ["hot", "hot turn"]
        starts.append(turns)
        rows += [(c, k, "user", t) for k, t in enumerate(turns)]
    rows += [(5 * size, k, "user", f"turn {k // 3}") for k in range(300)]
    chance.shuffle(rows)
    return rows


def found(spark, rows, part_nodes=module.PART_NODES, schema=SCHEMA):
    out = conversation_trie(spark.createDataFrame(rows, schema).repartition(3), part_nodes)
    assert out.columns == COLUMNS
    return collections.Counter(map(tuple, out.collect()))


@pytest.mark.parametrize("part_nodes", [module.PART_NODES, 3])
def test_awkward_rows(spark, part_nodes):
    assert found(spark, AWKWARD, part_nodes) == plain(AWKWARD)


@pytest.mark.parametrize("seed, part_nodes", [(1, 40), (2, module.PART_NODES)])
def test_shared_beginnings(spark, monkeypatch, seed, part_nodes):
    monkeypatch.setattr(module, "SLICE_TURNS", 16)
    monkeypatch.setattr(module, "PIECE_MEMBERS", 4)
    rows = shared_starts(seed, 150)
    assert found(spark, rows, part_nodes) == plain(rows)


def test_clashing_columns_and_empty_table(spark):
    rows = [(*r, 1, 2, "x") for r in AWKWARD]
    clash = SCHEMA + ", depth int, part int, place string"
    assert found(spark, rows, schema=clash) == plain(AWKWARD)
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_very_long_texts(spark):
    rows = [(0, 0, "user", "w " * 400_000), (0, 1, "user", "x"), (4, 0, "user", "w " * 400_000), (6, 0, "u", "y")]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("shape", ["random", "chain", "star", "heavy"])
def test_centroid_rollup(shape):
    chance = random.Random(shape)
    n = 400
    parents = [-1]
    for k in range(1, n):
        parents.append({"random": chance.randrange(k), "chain": k - 1, "star": 0, "heavy": max(0, k - chance.randint(1, 3))}[shape])
    own = [chance.choice([1, 1, 50]) if shape == "heavy" else 1 for _ in range(n)]
    values = [(chance.randint(0, 9), chance.randint(0, 9)) for _ in range(n)]
    weights, totals = list(own), [list(v) for v in values]
    for k in range(n - 1, 0, -1):
        weights[parents[k]] += weights[k]
        totals[parents[k]][0] += totals[k][0]
        totals[parents[k]][1] += totals[k][1]
    assert subtree_totals(parents, weights, values) == totals
    assert subtree_totals([], [], []) == []


def test_plan_gathers_no_conversation(spark):
    """No aggregate collects lists, and no join lacks keys."""
    docs = spark.createDataFrame(AWKWARD, SCHEMA).withColumn("x", F.lit(1))
    plan = conversation_trie(docs)._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
