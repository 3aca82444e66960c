"""Quality rules, line windows and k-d shards."""

from __future__ import annotations

import collections
import math
import random
import re
import unicodedata
import zlib

import duckdb
import pytest
from helpers import AWKWARD, PROSE, SCHEMA, frame, words
from pyspark.sql import functions as F

from riskmart.llm import quality_divergence, queries
from riskmart.llm.kd_shards import kd_shards, numbered
from riskmart.llm.line_windows import remove_repeated_windows
from riskmart.llm.quality_divergence import judged, passing

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def measures(text):
    own = words(text)
    times = collections.Counter(tuple(own[k : k + 3]) for k in range(len(own) - 2))
    covered = {k + j for k in range(len(own) - 2) if times[tuple(own[k : k + 3])] > 1 for j in range(3)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (
        len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
        len(covered), len(own) < 50 or 100 * len(covered) > 50 * len(own),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_measures_follow_the_definition(spark):
    rows = AWKWARD + [(20, "a b c d a b c e a b c"), (21, "x x x x"), (22, "#1 |<> l\n#1 |<> l\n \nq")]
    found = judged(frame(spark, rows)).collect()
    got = collections.Counter((r.doc_id, *[r[n] for n in NAMES]) for r in found)
    assert got == collections.Counter((i, *measures(t)) for i, t in rows)
    assert not any(r.kept and r.base_failed for r in found)


def test_plain_documents_stay_and_odd_ones_go(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    table = str.maketrans({c: "#" for c in "aeiou"})
    odd = docs.where(F.length("text") > 2000).limit(5).collect()
    changed = [(1_000_000 + k, r.text.translate(table), r.lang, r.source, 0) for k, r in enumerate(odd)]
    found = judged(docs.unionByName(spark.createDataFrame(changed, docs.schema))).collect()
    assert all(not r.kept for r in found if r.doc_id >= 1_000_000)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    clean = [r for r in found if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)


def test_small_languages_are_kept(spark):
    """Clean texts of a language with few of all words, with and without enough for a reference."""
    rows = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "lang").collect()
    chance = random.Random(3)
    vocabulary = [f"{chance.choice('kmt')}{chance.choice('aeiou')}{chance.choice('lnr')}{k:x}".translate(
        str.maketrans("0123456789", "ghjpqsvwyz")) for k in range(500)]
    weights = [1 / (k + 1) for k in range(500)]
    text = lambda n: " ".join(chance.choices(vocabulary, weights, k=n)) + "."
    small = [(10**6 + k, text(150), "xa") for k in range(8)]
    enough = [(2 * 10**6 + k, text(400), "xb") for k in range(20)]
    odd = [(3 * 10**6 + k, " ".join(f"#{chance.random()}" for _ in range(70)), "xb") for k in range(2)]
    assert 10 * sum(len(words(r.text)) for r in rows) > 200 * 400 * 20
    docs = [tuple(r) for r in rows for _ in range(10)] + small + enough + odd
    found = judged(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)).collect()
    by = {r.doc_id: r for r in found}
    assert all(by[i].kept and by[i].word_distance is None for i, _, _ in small)
    assert all(by[i].kept and by[i].word_distance is not None for i, _, _ in enough)
    assert not any(by[i].kept for i, _, _ in odd)


def test_quality_on_empty_tables_and_clashing_columns(spark):
    assert judged(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = frame(spark, [(1, PROSE), (2, "short")]).withColumn("kept", F.lit("mine")).withColumn("words", F.lit(3))
    assert passing(docs).columns == docs.columns
    assert {r.kept for r in passing(docs).collect()} <= {"mine"}
    assert judged(docs).count() == 2


def test_line_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLES["op3_line_windows"]).fetchall(), key=repr)
    found = queries.QUERIES["op3_line_windows"](spark, SMALL).collect()
    assert sorted(map(tuple, found), key=repr) == want


def test_lines_of_awkward_texts(spark):
    docs = frame(spark, AWKWARD).withColumn("n_lines", F.lit("mine")).withColumn("row", F.lit(1))
    found = remove_repeated_windows(docs, measures=False)
    assert found.columns == docs.columns
    by = collections.defaultdict(list)
    for r in found.collect():
        assert r.n_lines == "mine"
        by[r.doc_id].append(r.text)
    assert by[9] == ["l1 a\n\nl2 b\nl3 c\nl4 d"]
    assert by[10] == [""]
    assert by[1] == [None] and by[2] == [""] and by[3] == [" \n\t "] and by[4] == ["one"]
    assert sorted(by[5]) == sorted([PROSE, PROSE, PROSE.upper()])
    assert remove_repeated_windows(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_are_near_equal_and_numbered(spark, shards):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("source", F.lit("hot"))
    found = numbered(kd_shards(docs, shards)).collect()
    sizes = {r.doc_id: len((r.text or "").encode()) + 16 for r in docs.collect()}
    by = collections.defaultdict(list)
    for r in found:
        assert r["size"] == sizes[r.doc_id]
        by[r.shard].append(r)
    assert set(by) == set(range(shards)) and len(found) == len(sizes)
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    totals = [sum(r["size"] for r in rows) for rows in by.values()]
    assert max(totals) - min(totals) <= 2 * max(sizes.values())


def test_shards_of_awkward_rows(spark):
    rows = AWKWARD + [(7, "same")] * 30
    found = numbered(kd_shards(frame(spark, rows), 4)).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.text_crc32) for r in found} == {(i, zlib.crc32((t or "").encode())) for i, t in rows}
    assert numbered(kd_shards(spark.createDataFrame([], SCHEMA), 4)).count() == 0


def classes(text):
    """Counts of character classes in the order of the operator."""
    sets = {
        "lower": lambda c: unicodedata.category(c) == "Ll", "blank": lambda c: c in " \t\n\x0b\x0c\r",
        "upper": lambda c: unicodedata.category(c) == "Lu", "digit": lambda c: c in "0123456789",
        "stop": lambda c: c in ".,;:!?'\"()-", "symbol": lambda c: c in "#*$%&|<>@^~_=+/\\{}[]`",
    }
    found = collections.Counter(next((n for n, has in sets.items() if has(c)), "other") for c in text)
    return [found[n] for n in ("lower", "upper", "digit", "stop", "symbol", "blank", "other")]


def divergence(counts, total, shares):
    if not total:
        return None
    p = [c / total for c in counts]
    p, q = [*p, max(0.0, 1 - sum(p))], [*shares, max(0.0, 1 - sum(shares))]
    bits = lambda x, y: x * math.log2(2 * x / (x + y)) if x > 0 else 0.0
    return math.sqrt(max(0.0, sum(bits(x, y) + bits(y, x) for x, y in zip(p, q)) / 2))


def test_distances_and_verdicts_follow_the_definition(spark, monkeypatch):
    monkeypatch.setattr(quality_divergence, "LANGUAGE_WORDS", 2000)
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows += [(1000, None, "en"), (1001, "", None), (1002, "The THE the tHe 12 " * 30, "xx"), (1003, PROSE * 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    common = 8
    chars, vocabulary = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        if len(text or "") >= quality_divergence.MIN_CHARS:
            chars[lang or ""].update(dict(enumerate(classes(text))))
            vocabulary[lang or ""].update(w.lower() for w in words(text))
    refs = {}
    for lang, times in vocabulary.items():
        n = sum(times.values())
        if n >= 2000:
            top = sorted(times, key=lambda w: (-times[w], w))[:common]
            refs[lang] = top, [times[w] / n for w in top], [chars[lang][k] / sum(chars[lang].values()) for k in range(7)]
    assert len(refs) >= 2
    forms = {f for top, _, _ in refs.values() for w in top for f in (w, w.capitalize(), w.upper())}
    for r in judged(docs, common).collect():
        text, ref = r.text or "", refs.get(r.lang or "")
        n, _, _, _, _, failed = measures(text)
        want = None, None
        if ref:
            hits = collections.Counter(w.lower() for w in words(text) if w in forms)
            want = divergence(classes(text), len(text), ref[2]), divergence([hits[w] for w in ref[0]], n, ref[1])
        assert (r.char_distance, r.word_distance) == (pytest.approx(want[0]), pytest.approx(want[1])), r.doc_id
        near = (want[0] or 0) <= 0.2 + 0.8 / math.sqrt(max(1, len(text))) and (want[1] or 0) <= 0.16 + 2.2 / math.sqrt(max(1, n))
        assert r.kept == (not failed and near)
