"""Removal of repeated passages with sharded Aho-Corasick automata.

1. Candidates and confirmation: windows of ``window`` words that occur at least twice in
   the corpus are found by their hashes (see ``repeats``). Neighbouring repeated windows
   of a document form a passage.
2. Shards: documents and the passages confirmed in them are dealt out together by
   document. Each piece of documents compiles one automaton of its distinct passages, over
   words as letters, so no automaton outgrows the texts of its piece.
3. All texts of the piece stream through it; every word inside an occurrence is removed.

All occurrences go, the first one included. Windows are judged on the input.

Defined cases: NULL text has no words; a text with fewer words than a window stays whole;
two rows with the same text are two occurrences, equal doc_ids included; NULL doc_ids stay
NULL; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskmart.llm.arrays import merged_spans, pieces, word_bounds, word_hashes
from riskmart.llm.repeats import ANYWHERE, NO_ID, Unit, marked_texts, repeated_stretches, unpack
from riskmart.llm.suffix_ranks import spans_of

WINDOW = 35
GRAM = 6
#: Letters start after the surrogates. Where a piece has more distinct words than there are
#: letters, a word is two letters, the first from one half of them and the second from the other.
FIRST_LETTER = 0xE000
LETTERS = 0x110000 - FIRST_LETTER
PIECE = 512 << 10

OUT_DDL = "doc_id long, n_words long, spans array<struct<start: int, end: int>>, kept string"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def as_letters(hashes: np.ndarray, bounds: np.ndarray, most: int = LETTERS) -> tuple[list[str], int]:
    """Each text as a string of words, and the letters of a word; equal words are equal letters."""
    _, number = np.unique(hashes, return_inverse=True)
    width = 1
    if number.max(initial=0) >= most:
        half, width = most // 2, 2
        number = np.stack([number // half, half + number % half], axis=1).ravel()
    letters = (number + FIRST_LETTER).astype("<u4").tobytes().decode("utf-32-le")
    return [letters[width * a : width * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], width


def automaton(passages: set[str]) -> ahocorasick.Automaton | None:
    if not passages:
        return None
    found = ahocorasick.Automaton()
    for passage in passages:
        found.add_word(passage, len(passage))
    found.make_automaton()
    return found


def _cut(window: int, letters: int):
    def run(batches):
        for piece in pieces(batches, "blob", PIECE):
            data, offsets = unpack(piece.column("blob"))
            starts, ends, bounds = word_bounds(data, offsets)
            texts, width = as_letters(word_hashes(data, starts, ends), bounds, letters)
            passages = {
                text[width * a : width * b]
                for text, (firsts, lasts) in zip(texts, spans_of(piece, window))
                for a, b in zip(firsts.tolist(), lasts.tolist())
            }
            search = automaton(passages)
            raw = data.tobytes()
            kept, spans = [], []
            for i, text in enumerate(texts):
                own = range(int(bounds[i]), int(bounds[i + 1]))
                hits = np.array([(end + 1 - n, end + 1) for end, n in search.iter(text)] if search else [], np.int64)
                firsts, lasts = merged_spans(*hits.reshape(-1, 2).T // width)
                out, at = [], 0
                for a, b in [*zip(firsts.tolist(), lasts.tolist()), (len(own), len(own))]:
                    out += [raw[starts[k] : ends[k]] for k in own[at:a]]
                    at = b
                kept.append(b" ".join(out).decode())
                spans.append([{"start": a, "end": b} for a, b in zip(firsts.tolist(), lasts.tolist())])
            ids = piece.column("id")
            yield pa.record_batch(
                [
                    pc.if_else(pc.equal(ids, NO_ID), pa.scalar(None, pa.int64()), ids),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(spans, pa.list_(_SPAN)),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "spans", "kept"],
            )

    return run


def remove_repeated_passages(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, letters: int = LETTERS
) -> DataFrame:
    """doc_id, n_words, the removed spans (word offsets) and the kept words, joined by a space."""
    unit = Unit(words=True, window=window, gram=gram, rule=ANYWHERE)
    marks = repeated_stretches(docs, unit)
    return marked_texts(docs, marks, "left").mapInArrow(_cut(window, letters), OUT_DDL)
