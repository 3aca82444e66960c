"""Suffix-array deduplication of byte strings by distributed prefix doubling.

Every byte that a string of ``threshold`` bytes covers is removed where that string also
starts in a document with a smaller doc_id. Sorting all suffixes is not needed for that:
positions matter only up to the rank of their first ``threshold`` bytes, so ranks are
doubled once, from half the threshold to all of it.

1. Positions whose string cannot repeat drop out: neighbouring positions with the same
   minimizer form runs (see ``repeats``), Spark sorts the runs by minimizer and content, and
   only runs whose minimizer comes with several contents still need ranks. Runs with equal
   contents are settled here, whole.
2. For what is left every position gets the pair (rank of its first half, rank at the
   offset of half the threshold); ranks are 64-bit names of the byte strings. Spark sorts
   the pairs; equal pairs are equal strings of the whole threshold, and pairs that are
   unique end there.
3. The spans are merged per document and cut out.

Defined cases: NULL text counts as empty; a text shorter than the threshold stays whole;
documents with equal doc_ids never remove each other's bytes; rows with a NULL doc_id
count as the last ones; rows that agree in doc_id and text get the same result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskmart.llm.arrays import merged_spans, pieces
from riskmart.llm.repeats import EARLIER, NO_ID, Unit, marked_texts, repeated_stretches, unpack

THRESHOLD = 50
#: Bytes of a gram; a smaller one makes more positions look alike.
GRAM = 20

OUT_DDL = "doc_id long, n_bytes long, spans array<struct<start: int, end: int>>, kept binary"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def spans_of(batch: pa.RecordBatch, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row of ``marked_texts`` the maximal spans that its marks cover."""
    out = []
    for first, n in zip(batch.column("first"), batch.column("n")):
        if first.values is None:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        start = np.asarray(first.values).astype(np.int64)
        out.append(merged_spans(start, start + np.asarray(n.values) + window - 1))
    return out


def _cut(threshold: int):
    def run(batches):
        for piece in pieces(batches, "blob", 1 << 20):
            data, offsets = unpack(piece.column("blob"))
            kept, spans = [], []
            for i, (starts, ends) in enumerate(spans_of(piece, threshold)):
                text = data[offsets[i] : offsets[i + 1]]
                if len(starts):
                    edges = np.zeros(len(text) + 1, np.int8)
                    np.add.at(edges, starts, 1)
                    np.add.at(edges, ends, -1)
                    text = text[np.cumsum(edges[:-1]) == 0]
                kept.append(text.tobytes())
                spans.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())])
            ids = piece.column("id")
            yield pa.record_batch(
                [
                    pc.if_else(pc.equal(ids, NO_ID), pa.scalar(None, pa.int64()), ids),
                    pa.array(np.diff(offsets)),
                    pa.array(spans, pa.list_(_SPAN)),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return run


def remove_repeated_bytes(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, the removed spans (byte offsets) and the bytes that are kept."""
    unit = Unit(words=False, window=threshold, gram=gram, rule=EARLIER)
    marks = repeated_stretches(docs, unit)
    return marked_texts(docs, marks, "left").mapInArrow(_cut(threshold), OUT_DDL)
