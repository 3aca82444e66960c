"""Near-duplicates and decontamination against brute force."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from helpers import AWKWARD, PROSE, SCHEMA, frame, words
from pyspark.sql import functions as F

from riskmart.llm import lsh_forest
from riskmart.llm.components import components
from riskmart.llm.decontamination import Index, contaminations, decontaminated
from riskmart.llm.lsh_forest import near_duplicates, without_near_duplicates

LAST = 1 << 63


def near_copies(seed):
    """Groups of one to sixty edits of a base text, and unrelated texts."""
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows, i = [], 0
    for size in (60, 12, 5, 2, 2, *[1] * 40):
        base = random.choices(vocabulary, k=random.randint(40, 200))
        for _ in range(size):
            text = list(base)
            for _ in range(random.randint(0, max(1, len(text) // 40))):
                text[random.randrange(len(text))] = random.choice(vocabulary)
            rows.append((i, " ".join(text)))
            i += 1
    random.shuffle(rows)
    return rows


def linked(rows, k):
    sets = []
    for i, text in rows:
        own = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(own[j : j + k]) for j in range(max(1, len(own) - k + 1))} if own else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    number = [LAST if i is None else i for i, _ in rows]
    lowest = {}
    for x in range(len(rows)):
        lowest[find(x)] = min(lowest.get(find(x), LAST), number[x])
    out = collections.Counter()
    for x, (i, _) in enumerate(rows):
        low = lowest[find(x)] if sets[x] else number[x]
        out[i, len(sets[x]), None if low == LAST else low, number[x] == low] += 1
    return out


@pytest.mark.parametrize("rows, k", [(AWKWARD, 4), (near_copies(1), 4), (near_copies(2), 5)])
def test_components_follow_the_definition(spark, rows, k):
    found = near_duplicates(frame(spark, rows).repartition(3), words=k).collect()
    assert collections.Counter(tuple(r) for r in found) == linked(rows, k)


def crowd(seed, n, planted, edits, shared):
    """Texts alike below the threshold, as each has its own changes of one base; some have an edited copy."""
    random.seed(seed)
    base = [f"b{k}" for k in range(240)]

    def edited(text, count, tag):
        text = list(text)
        for k, at in enumerate(random.sample(range(len(text) // 6), count)):
            text[6 * at] = f"{tag}x{k}"
        return text

    texts = [edited(base, edits, f"d{i}") for i in range(n)]
    texts += [edited(text, shared, f"e{i}") for i, text in enumerate(random.sample(texts, planted))]
    rows = [(i, " ".join(text)) for i, text in enumerate(texts)]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("edits, shared", [(5, 6), (6, 5)])
def test_no_link_is_lost_in_a_crowd(spark, monkeypatch, edits, shared):
    rows = crowd(edits, 500, 60, edits, shared)
    for name, value in (("REGION_ROWS", 200), ("SKETCH_ROWS", 150), ("SET_ROWS", 40)):
        monkeypatch.setattr(lsh_forest, name, value, raising=False)
    found = near_duplicates(frame(spark, rows).repartition(3), words=4).collect()
    assert collections.Counter(tuple(r) for r in found) == linked(rows, 4)


def test_common_counts():
    random.seed(5)
    sets = [{*random.sample(range(300), 60), *range(300, 300 + k)} for k in range(50)]
    h = np.array([x for own in sets for x in own], np.uint64)
    owner = np.repeat(np.arange(50), [len(own) for own in sets])
    found = lsh_forest.common_counts(h, owner, 50)
    assert all(found[a, b] == len(sets[a] & sets[b]) for a in range(50) for b in range(50) if a != b)


def test_one_of_each_group_stays_whole(spark):
    rows = [(2, PROSE, 7), (1, PROSE + " more", 8), (3, "other words here", 9), (4, None, 10), (5, "", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    kept = without_near_duplicates(docs)
    assert kept.columns == ["doc_id", "text", "key"]
    assert sorted(r.key for r in kept.collect()) == [8, 9, 10, 11]


def test_repeated_rows_and_rows_without_id_stay_once(spark):
    rows = [(2, PROSE)] * 5 + [(None, PROSE)] * 3 + [(None, "some other words that no document has")] * 4
    rows += [(7, "text that comes once"), (8, ""), (8, ""), (None, None), (None, None)]
    kept = without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = [(2, PROSE), (None, rows[8][1]), rows[12], (8, ""), (8, ""), (None, None), (None, None)]
    assert collections.Counter(map(tuple, kept)) == collections.Counter(want)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


ITEMS = [
    (1, "Which river runs through the old stone city of Tarn and past the seven mills? The river Orla does."),
    (2, "name all nine wonders of the eastern coast in the order of their discovery by sailors from the north"),
    (3, None),
    (4, ""),
    (5, "Too short?"),
]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_leaks_are_found_in_any_place(spark):
    leak = ITEMS[0][1].replace("?", " ?").upper()
    rows = [
        (1, PROSE), (2, PROSE + " " + leak), (3, leak + " " + " ".join([PROSE] * 9)), (4, None), (5, ""),
        (6, " ".join([PROSE] * 5) + "\n" + ITEMS[1][1] + ". " + PROSE), (6, ITEMS[1][1]),
        # The question without the answer, and the answer alone.
        (7, PROSE + ITEMS[0][1].split("?")[0]), (8, "The river Orla does."), (None, leak),
    ]
    docs = frame(spark, rows).withColumn("item_id", F.lit(77))
    found = {(r.doc_id, r.item_id) for r in contaminations(docs, items(spark)).collect()}
    assert found == {(2, 1), (3, 1), (6, 2), (None, 1)}
    kept = decontaminated(docs, items(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 7, 8]


def test_one_changed_word_at_any_place_hides_no_leak(spark):
    chance = random.Random(4)
    own = [f"{chance.choice('bdfg')}{chance.choice('aeiou')}{k}x" for k in range(38)]
    item = spark.createDataFrame([(1, " ".join(own))], "item_id long, text string")
    rows = [(k, " ".join([PROSE, *own[:k], "changed", *own[k + 1 :], PROSE])) for k in range(38)]
    rows += [(100 + k, " ".join([PROSE, *own[:k], *own[k + 1 :], PROSE])) for k in range(38)]
    rows += [(200 + k, " ".join([PROSE, *own[:k], "more", *own[k:], PROSE])) for k in range(38)]
    # The question without its answer, and all words in another order.
    other = [(1000, " ".join([PROSE, *own[:28], PROSE])), (1001, " ".join([PROSE, *own[::-1], PROSE]))]
    found = contaminations(frame(spark, rows + other).repartition(3), item).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)


def test_empty_benchmark_and_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminations(frame(spark, AWKWARD), none).count() == 0
    assert decontaminated(frame(spark, AWKWARD), none).count() == len(AWKWARD)
    assert contaminations(spark.createDataFrame([], SCHEMA), items(spark)).count() == 0


def test_wand_finds_all_above_the_threshold():
    random.seed(5)
    vocabulary = [f"t{k}" for k in range(60)]
    index = Index([(i, " ".join(random.choices(vocabulary, k=random.randint(3, 12)))) for i in range(400)])
    for threshold in (0.3, 0.6, 0.9):
        for _ in range(30):
            asked = sorted(random.sample(range(len(index.terms)), 15))
            scores = collections.defaultdict(float)
            for t in asked:
                for p in range(index.starts[t], index.starts[t + 1]):
                    scores[int(index.items[p])] += index.weights[p]
            got = dict(index.search(asked, threshold))
            sure = {i for i, s in scores.items() if s > threshold + 1e-6}
            assert sure <= got.keys() <= {i for i, s in scores.items() if s > threshold - 1e-6}
            assert all(abs(s - scores[i]) < 1e-9 for i, s in got.items())
