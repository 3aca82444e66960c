"""Byte and passage deduplication against their definitions."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from helpers import AWKWARD, PROSE, frame, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskmart.llm import queries, repeats
from riskmart.llm.arrays import Stretches, merged_spans, sliding_min
from riskmart.llm.lsh_forest import near_duplicates, without_near_duplicates
from riskmart.llm.phrase_automata import as_letters, remove_repeated_passages
from riskmart.llm.suffix_ranks import remove_repeated_bytes

LAST = 1 << 63


def noisy(seed, n=60):
    """Texts that share stretches of all lengths, with small vocabularies and periodic parts."""
    random.seed(seed)
    vocabulary = ["ab", "c", "the", "dd d", "é", "xyz"]
    bits = [" ".join(random.choices(vocabulary, k=random.randint(5, 90))) for _ in range(12)]
    out = []
    for i in range(n):
        text = " ".join(random.choices(bits, k=random.randint(1, 3)) + random.choices(vocabulary, k=4))
        out.append((random.randint(0, n), text))
    return out


def kept_bytes(rows, window):
    first = {}
    number = lambda i: LAST if i is None else i
    for i, text in sorted(rows, key=lambda r: number(r[0])):
        raw = (text or "").encode()
        for k in range(len(raw) - window + 1):
            first.setdefault(raw[k : k + window], number(i))
    out = collections.Counter()
    for i, text in rows:
        raw = (text or "").encode()
        gone = set()
        for k in range(len(raw) - window + 1):
            if first[raw[k : k + window]] < number(i):
                gone |= set(range(k, k + window))
        out[i, len(raw), bytes(b for k, b in enumerate(raw) if k not in gone)] += 1
    return out


def kept_words(rows, window):
    times = collections.Counter()
    for _, text in rows:
        own = words(text)
        times.update(tuple(own[k : k + window]) for k in range(len(own) - window + 1))
    out = collections.Counter()
    for i, text in rows:
        own = words(text)
        gone = set()
        for k in range(len(own) - window + 1):
            if times[tuple(own[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        out[i, len(own), " ".join(w for k, w in enumerate(own) if k not in gone)] += 1
    return out


@pytest.mark.parametrize("rows", [AWKWARD, noisy(1), noisy(2)], ids=["awkward", "noisy", "noisier"])
def test_bytes_follow_the_definition(spark, rows):
    found = remove_repeated_bytes(frame(spark, rows).repartition(3)).collect()
    got = collections.Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in found)
    assert got == kept_bytes(rows, 50)


@pytest.mark.parametrize("rows", [AWKWARD, noisy(3), noisy(4)], ids=["awkward", "noisy", "noisier"])
def test_passages_follow_the_definition(spark, rows):
    found = remove_repeated_passages(frame(spark, rows).repartition(3)).collect()
    got = collections.Counter((r.doc_id, r.n_words, r.kept) for r in found)
    assert got == kept_words(rows, 35)


def echoed(length, echo, n=200):
    """Pairs of documents that share one passage; in one of both its end comes again at once."""
    chance = random.Random(5)
    text = lambda k: [f"{chance.randrange(10**6):06}" for _ in range(k)]
    out = []
    for k in range(n):
        passage = " ".join(text(60)).split(" ")[:length] if echo < 10 else list(" ".join(text(12))[:length])
        join = " ".join if echo < 10 else "".join
        plain = join(text(1) + passage + text(40))
        again = join(text(1) + passage + passage[-echo:] + text(40))
        out += [(2 * k, plain), (2 * k + 1, again)] if k % 2 else [(2 * k, again), (2 * k + 1, plain)]
    return out


def test_passages_whose_end_comes_again_in_one_document(spark):
    rows = echoed(50, 20)
    found = remove_repeated_bytes(frame(spark, rows).repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in found) == kept_bytes(rows, 50)
    rows = echoed(35, 6)
    found = remove_repeated_passages(frame(spark, rows).repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.kept) for r in found) == kept_words(rows, 35)


@pytest.mark.parametrize("longest", [1, 7])
def test_long_runs_in_several_rows(spark, monkeypatch, longest):
    monkeypatch.setattr(repeats, "LONGEST", longest)
    rows = [(1, "a" * 900), (2, "a" * 900), (3, "b" * 400), (4, "a" * 70 + PROSE), (5, PROSE + "b" * 60), (5, "a" * 51)]
    found = remove_repeated_bytes(frame(spark, rows).repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in found) == kept_bytes(rows, 50)
    rows = [(i, t.replace("a", "a ").replace("b", "b ")) for i, t in rows]
    found = remove_repeated_passages(frame(spark, rows).repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.kept) for r in found) == kept_words(rows, 35)


def test_parts_of_very_long_runs():
    owner, first, n = repeats._parted(np.array([5, 100]), np.array([(1 << 24) + 10, 3]))
    assert n.sum() == (1 << 24) + 13 and n.max() <= repeats.LONGEST and n.min() > 0
    assert first[0] == 5 and (first[1:17] == first[:16] + n[:16]).all() and first[-1] == 100 and owner[-1] == 1


def test_rows_without_id_whose_short_hashes_agree(spark):
    """Two texts with nothing in common but 31 bits of their hash are two documents."""
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(39)), lambda j: F.concat("id", F.lit("x"), j)), " ")
    texts = spark.range(300_000).select(text.alias("text")).withColumn("h", F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)))
    pair = texts.groupBy("h").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").first()
    rows = [(1, pair.a), (None, pair.a), (None, pair.b), (7, pair.b + " and more"), (7, pair.a)]
    docs = frame(spark, rows).repartition(2)
    found = collections.Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in remove_repeated_bytes(docs).collect())
    assert found == kept_bytes(rows, 50)
    found = collections.Counter((r.doc_id, r.n_words, r.kept) for r in remove_repeated_passages(docs).collect())
    assert found == kept_words(rows, 35)
    docs = frame(spark, rows[:3])
    assert {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()} == {(1, 1), (None, 1), (None, None)}
    assert sorted(r.text for r in without_near_duplicates(docs).collect()) == sorted([pair.a, pair.b])


def test_more_distinct_words_than_letters(spark):
    rows = noisy(6)[:40]
    found = remove_repeated_passages(frame(spark, rows), letters=6).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.kept) for r in found) == kept_words(rows, 35)
    texts, width = as_letters(np.arange(5, dtype=np.uint64), np.array([0, 5]), most=4)
    assert width == 2 and len(texts[0]) == 10 and len({texts[0][k : k + 2] for k in range(0, 10, 2)}) == 5


def test_spans_are_maximal(spark):
    rows = [(1, "x" * 10 + PROSE), (2, PROSE[:60] + "#" + PROSE[60:120])]
    found = {r.doc_id: r.spans for r in remove_repeated_bytes(frame(spark, rows)).collect()}
    assert found[1] == []
    assert [(s.start, s.end) for s in found[2]] == [(0, 60), (61, 121)]


def test_empty_tables(spark):
    assert remove_repeated_bytes(frame(spark, [])).count() == 0
    assert remove_repeated_passages(frame(spark, [])).count() == 0


def test_query_columns(spark):
    folder = "/root/testdata/sf0.001"
    assert queries.QUERIES["op7_suffix_ranks"](spark, folder).columns == [
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
    ]
    assert queries.QUERIES["op8_phrase_automata"](spark, folder).columns == [
        "doc_id", "n_words", "n_removed", "kept_sha256",
    ]


@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 12))
@settings(max_examples=60, deadline=None)
def test_array_helpers(values, width):
    values = np.array(values, np.uint64)
    if len(values) >= width:
        want = [values[k : k + width].min() for k in range(len(values) - width + 1)]
        assert sliding_min(values, width).tolist() == want
        same = collections.defaultdict(set)
        for k, h in enumerate(Stretches(values + np.uint64(1)).fixed(width)):
            same[tuple(values[k : k + width])].add(h)
        assert all(len(hashes) == 1 for hashes in same.values())
    starts, ends = merged_spans(values.astype(np.int64), values.astype(np.int64) + 2)
    covered = {x for v in values.tolist() for x in (v, v + 1)}
    assert {x for s, e in zip(starts, ends) for x in range(s, e)} == covered
