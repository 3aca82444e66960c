"""HTML extraction, toxicity and packing."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import AWKWARD, PROSE, SCHEMA, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskmart.llm import queries
from riskmart.llm.site_templates import main_texts, parse
from riskmart.llm.toxicity_fm import held_out, learn, scored
from riskmart.llm.window_packing import Encoder, best_cuts, pack_windows

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain & simple < text", "plain & simple < text"),
        ("<p>a<p>b &lt;i&gt; <i>c</i>d<br>e", "a b <i> cd e"),
        ("<nav>n</nav><article><header><h1>T</h1></header><p>x<footer>f</footer></article><footer>g", "T x"),
        ("<article><p>a</p><section class='comments'><article>c</article></section>b</article>", "a b"),
        ("<div id=cookie-notice>c</div><main>m <span class=ad>z</span> n</main>", "m n"),
        ("<script>var t='</p><p>x';</script><article>a<!-- <p>b</p> --><style>p{}</style></article>", "a"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>", "a b 1 2"),
        ("<article>a&nbsp;&amp;amp;  b\n\tc</article>", "a &amp; b c"),
        ("<article><a title='>'>link</a><img alt=x>pic</article><form>f</form>", "linkpic"),
        ("<article>never closed <b>bold", "never closed bold"),
    ],
)
def test_blocks(page, text):
    blocks, _ = parse(page)
    inside = [t for t, marked in blocks if marked]
    assert " ".join(inside or [t for t, _ in blocks]) == text


def test_long_odd_pages_take_no_long_time():
    for page in ("<" * 200_000, "<a '" * 50_000, "<div>" * 30_000 + "x", "<p>" * 30_000, "&" * 100_000):
        parse(page)


def test_templates_go_on_pages_without_an_article(spark):
    rows = [(k, f"http://h.example/{k}", f"<div>Our site</div><p>story {k}</p><div>Call us</div>") for k in range(6)]
    rows += [(10, "http://other.example/", "<div>Our site</div><p>one</p>"), (11, None, None), (12, "odd", "<p>x"), (12, "odd", "<p>x")]
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r.text for r in found}
    assert all(by[k] == f"story {k}" for k in range(6))
    assert by[10] == "Our site one" and by[11] == "" and by[12] == "x"
    assert main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(spark, pages):
    """Text by page_id of pages given as (page_id, host, html)."""
    rows = [(k, f"http://{host}/{k}", html) for k, host, html in pages]
    found = main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r.page_id for r in found) == sorted(k for k, *_ in pages)
    return {r.page_id: r.text for r in found}


def test_templates_go_in_articles_too(spark):
    notice, lines = "<div>Sign up for our weekly letter</div>", "<p>All rights reserved by the author.</p>"
    pages = [(k, "a", f"<nav>n</nav><article><h1>T {k}</h1><p>story {k}</p>{notice}</article>") for k in range(6)]
    # Only in a part of a large host, in whatever share of it.
    pages += [
        (100 + k, "b", f"<main><p>a long enough story {k}, told</p>{'<ul><li>Also read this</ul>' if k < 5 else ''}</main>")
        for k in range(300)
    ]
    # What an author repeats stays, unless it is all over the site.
    pages += [(500 + k, "c", f"<article><p>story {k}</p>{lines if k < 6 else ''}</article>") for k in range(20)]
    pages += [(600 + k, "d", f"<article><p>story {k}</p>{lines}</article>") for k in range(6)]
    # Stories that are almost the same on some pages, and an article that is nothing else.
    parts = "".join(f"<div>paragraph {k} of a story</div>" for k in range(5))
    pages += [(700 + k, "e", f"<article>{parts if k < 4 else ''}<p>version {k}</p></article>") for k in range(12)]
    pages += [(800, "a", f"<article>{notice}</article>")]
    found = texts_of(spark, pages)
    assert all(found[k] == f"T {k} story {k}" for k in range(6))
    assert all(found[100 + k] == f"a long enough story {k}, told" for k in range(300))
    assert all(found[500 + k] == f"story {k}" + " All rights reserved by the author." * (k < 6) for k in range(20))
    assert all(found[600 + k] == f"story {k}" for k in range(6))
    story = " ".join(f"paragraph {k} of a story" for k in range(5))
    assert all(found[700 + k] == (f"{story} " if k < 4 else "") + f"version {k}" for k in range(12))
    assert found[800] == "Sign up for our weekly letter"


def test_copies_of_a_page_are_one_content(spark):
    pages = [(k, "h", "<div>a story</div><p>and its end</p>") for k in (1, 1, 2, 3, 4, 5)]
    assert set(texts_of(spark, pages).values()) == {"a story and its end"}


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div>x</div><article class='post share comments-open'>a</article>", "a"),
        ("<div class='social-content'><article>a<div class=share>s</div></article></div>b", "a"),
        ("<div id='menu-page'>m<article>a</article></div>", "a"),
        ("<div class=sidebar><article>s</article></div><article>a</article>", "a"),
        ("<div>story</div><div id=comments><article>c</article></div><article class=comment>d</article>", "story"),
        ("<nav><article>n</article></nav>story", "story"),
        ("<article>a<article class=share>s</article></article>", "a"),
    ],
)
def test_class_words_drop_no_only_article(page, text):
    blocks, subtrees = parse(page)
    inside = [t for t, marked in blocks if marked]
    assert " ".join(inside or [t for t, _ in blocks]) == text
    assert all(0 <= first <= end <= len(blocks) for _, first, end in subtrees)


def test_pages_give_the_texts_they_were_made_of(spark):
    pages = queries.QUERIES["op5_site_templates"](spark, MEDIUM).collect()
    texts = {" ".join(r.text.split()) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    assert pages
    for r in pages:
        assert r.n_chars == len(r.text)
        # The heading comes first, with the first 60 characters or so of the document.
        assert any(r.text[k + 1 :] in texts for k in range(min(100, len(r.text))) if r.text[k] == " ")


def test_held_out_scores(spark):
    found = queries.QUERIES["op6_toxicity_fm"](spark, MEDIUM)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum((r.score >= 0.5) == (r.toxic == 1) for r in test) >= 0.93 * len(test)
    bad, good = [r.score for r in test if r.toxic], [r.score for r in test if not r.toxic]
    pairs = [(b > g) + 0.5 * (b == g) for b in bad for g in good]
    assert sum(pairs) / len(pairs) >= 0.9


def test_interactions_are_learned(spark):
    """Neither word alone marks a text, both together do."""
    rows, labels = [], []
    for k in range(400):
        insult, group = k % 2, k // 2 % 2
        rows.append((k, f"word{k % 7} {'fool' if insult else 'friend'} then {'group' if group else 'nobody'} end"))
        labels.append((k, int(insult and group)))
    docs = frame(spark, rows)
    machine = learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    right = {r.doc_id: r.score >= 0.5 for r in scored(docs, machine).collect()}
    assert sum(right[i] == bool(y) for i, y in labels) >= 0.97 * len(labels)


def test_scores_without_labels_and_of_awkward_texts(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = frame(spark, AWKWARD)
    assert {r.score for r in scored(docs, learn(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(5, 1), (4, None), (None, 1)], "doc_id long, toxic int")
    assert scored(docs, learn(docs, one)).count() == len(AWKWARD)
    assert docs.where(held_out(F.col("doc_id")).isNull()).count() == 0


def packed(spark, rows, **options):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    docs, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in pack_windows(frame(spark, rows).coalesce(1), TOKENIZER, **options).collect():
        docs[r.doc_id, r.doc_tokens].append(r)
        windows[r.sequence_id].append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for pieces in windows.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= options.get("size", 2048)
    want = collections.Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[i, len(ids), sum(ids)] += 1
    got = collections.Counter()
    for (i, n), pieces in docs.items():
        copies = sum(p.length for p in pieces) // n
        got[i, n, sum(x for p in pieces for x in p.ids) // copies] += copies
        assert sorted(p.start for p in pieces)[0] == 0
    assert got == want
    return windows


@pytest.mark.parametrize("options", [{}, {"size": 64, "block": 500}, {"size": 16, "block": 50}])
def test_every_id_lies_in_one_piece(spark, options):
    packed(spark, AWKWARD + [(30 + k, (PROSE + ". ") * k) for k in range(12)], **options)


def test_little_padding(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(400).collect()]
    windows = packed(spark, rows)
    used = sum(p.length for pieces in windows.values() for p in pieces)
    assert 1 - used / (2048 * len(windows)) < 0.02


def test_ids_are_those_of_the_library():
    """Capitals, white space, signs on letters and marks at the end of words, which are words of their own."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    encoder = Encoder(TOKENIZER)
    some = np.random.default_rng(5)
    parts = [
        *"abIXZ \u00e9\u00c9\u00df\u00d1\u00d7\u00f7.,!?'$%&*-_<|>\n\t\x02\x1c\x1f\x85\xa0\u2003\u2028\u3000019\u0663\u4e2d\u3002",
        *"\u0338\u0301\u0307\u0323\u0130\u212a\u03a3\u2019\u00aa\u00b5\u017f\ufb01\u200b\U0001f600", "'s", "'t ", "<|endoftext|>",
    ]
    texts = ["".join(some.choice(parts, some.integers(0, 50))) for _ in range(4000)]
    texts += ["", "I\u0307\u0338", "\u00e9" * 3000 + "!!", "ab.\u3000" * 300, " ", "a" * 5000, "\u00f7!! \u00d7?"]
    for text, (ids, lengths, ends) in zip(texts, encoder.encode(pa.array(texts))):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)
        assert len(lengths) == len(ends) and lengths.sum() == len(ids)
    encoder.clear()
    list(encoder.encode(pa.array(["Abc!! def!! ghi!!", "abc%%% def%%% \u00e9hi%%%\tghi"])))
    assert set(encoder.numbers) == {"abc", "def", "ghi", "\u00e9hi", "!!", "%%%"}


def test_cuts_are_the_cheapest():
    def brute(position, penalty, size):
        best = {0: 0}
        for j, p in enumerate(position):
            best[p] = min(best[q] + penalty[j] + size - (p - q) for q in best if p - q <= size)
        return best[position[-1]]

    random = np.random.default_rng(3)
    for _ in range(50):
        size = int(random.integers(8, 40))
        position = np.cumsum(random.integers(1, size + 1, 30)).tolist()
        penalty = random.integers(0, 20, 30).tolist()
        cuts = best_cuts(position, penalty, size)
        ends = [position[k] for k in cuts]
        cost = sum(penalty[k] for k in cuts) + sum(size - (b - a) for a, b in zip([0, *ends], ends))
        assert ends[-1] == position[-1] and cost == brute(position, penalty, size)


def test_empty_tables(spark):
    assert pack_windows(spark.createDataFrame([], SCHEMA), TOKENIZER).count() == 0
    assert queries.QUERIES["op2_window_packing"](spark, SMALL).columns[:4] == ["doc_id", "start", "length", "ids_crc32"]
