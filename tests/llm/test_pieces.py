"""Encoding and decoding of pieces against the library itself."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, SCHEMA, frame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from riskmart.llm import piece_encoding
from riskmart.llm.piece_encoding import Encoder, Vocabulary, encode_pieces, merged
from riskmart.llm.queries import QUERIES, tokenizer_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(model):
    return SentencePieceProcessor(model_proto=model)


@pytest.fixture(scope="module")
def encoder(model):
    return Encoder(Vocabulary(model))


def odd_texts(encoder):
    chance = random.Random(1)
    tokens = encoder.vocabulary.tokens
    texts = ["".join(chance.choices("aaab  ▁\n\t.é€😀\x00　the", k=chance.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(chance.choices(tokens, k=chance.randint(0, 10))) for _ in range(3000)]
    places = [(1, 0xD800), (0xE000, 0x10FFFF), (32, 127)]
    texts += ["".join(chr(chance.randrange(*chance.choice(places))) for _ in range(20)) for _ in range(1000)]
    return texts + ["a" * 5000, " " * 500, "=" * 300 + " " + "-" * 999, "<s> <0x41> </s> <unk>", "\r\n", "", None]


def check(encoder, library, texts):
    for text, (ids, words) in zip(texts, encoder.encode(pa.array(texts, pa.string())), strict=True):
        want = library.encode(text or "", add_bos=True, add_eos=True)
        assert ids.tolist() == want, text
        assert encoder.decode(ids, words) == library.decode(want), text


def test_odd_texts(encoder, library):
    check(encoder, library, odd_texts(encoder))


def test_small_caches_change_nothing(model, library, monkeypatch):
    for name in ("CACHE_WORDS", "CACHE_IDS", "CACHE_PAIRS"):
        monkeypatch.setattr(piece_encoding, name, 7)
    encoder = Encoder(Vocabulary(model))
    for text in odd_texts(encoder)[::40]:
        check(encoder, library, [text, "the words of a text", text])


@pytest.mark.parametrize("size", [3, 50])
def test_texts_decoded_in_slices(encoder, library, monkeypatch, size):
    monkeypatch.setattr(piece_encoding, "SLICE", size)
    check(encoder, library, ["  two  spaces and some more words é€😀  ", "x" * 300, "▁ a\n b", " ", ""])


def test_table_holds_the_definition(encoder):
    """Every prefix's last token is that of merging the prefix alone."""
    for word in ("▁internationalization", "▁▁▁▁▁aaaaaa", "unbelievably", "▁0000001", "ererererinininging"):
        for end in range(1, len(word) + 1):
            tokens = [encoder.texts[i] for i in encoder.word(word[:end])]
            assert tokens == merged(word[:end], encoder.vocabulary.scores)


def test_one_very_long_word_and_text(encoder, library):
    check(encoder, library, ["ab" * 200_000, "some words in a line\n" * 30_000])


def test_rows_of_a_table(spark, model, library):
    docs = frame(spark, AWKWARD).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x"))
    found = encode_pieces(docs.repartition(3), model).collect()
    want = []
    for i, text in AWKWARD:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r[0], r[1], bytes(r[2]), r[3]) for r in found), key=key) == sorted(want, key=key)
    assert encode_pieces(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_query_gives_digests_of_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = QUERIES["op11_piece_encoding"](spark, SMALL).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode(texts[row.doc_id] or "", add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
