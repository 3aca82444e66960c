"""Packing tokenised documents into windows by order-preserving dynamic programming.

Documents stay in the order of the input; their ids, each followed by an end id, form one
stream per task. Windows of at most ``size`` ids are cut at boundaries of the stream: the
end of a document costs nothing, the end of a sentence ``SENTENCE_CUT`` and a cut inside a
long sentence ``INNER_CUT``. A window with fewer than ``size`` ids also costs its padding.
The cheapest set of cuts is found with

    cost(j) = penalty(j) + size - position(j) + min(cost(i) + position(i))

over the boundaries i in reach of j, whose minimum a monotone queue keeps.

The stream is worked off in blocks: after each block all windows but the last are final
and the stream goes on behind them. A task therefore holds one block and one document, and
pads one window at its end. No rows are shuffled.

Defined cases: NULL and blank texts are the end id alone; a document longer than a window
fills several; repeated rows are packed like any others; an empty table gives an empty
result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections import deque
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.arrays import lowered, pieces, text_bytes, word_bounds

SIZE = 2048
END_ID = 1
SENTENCE_CUT, INNER_CUT = 6, 20
#: Longest way between two boundaries.
MAX_GAP = 64
#: Ids of a block.
BLOCK = 1 << 20
#: Words whose ids a task remembers.
CACHE_WORDS = 1 << 20
#: White space of more than one byte. Separators are none for tokenizers; texts that hold some keep all of it, in words.
SPACES = "[\u0085   -     　]"
SEPARATORS = "[\x1c-\x1f]"
#: Normalizers that leave small Latin letters as they are, and a split that takes letters, digits and all else apart.
KNOWN_NORMALIZERS = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]
KNOWN_SPLIT = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Words that such a tokenizer takes as they are, in one run.
PLAIN = re.compile("[a-zß-öø-ÿ]+")
#: ASCII marks, and bytes of ASCII letters and digits.
_MARKS, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_MARKS[[k for k in range(33, 127) if not chr(k).isalnum()]] = True
_ALNUM[[k for k in range(128) if chr(k).isalnum()]] = True
MARK = "\x02"
SENTENCE_ENDS = (".", "!", "?", "。", "！", "？")

OUT_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids array<int>"
)
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


class _Numbers(dict):
    """Numbers words as they come; words seen for the first time are put in ``new``."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.size = np.zeros(1 << 12, kind), 0

    def extend(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.room):
            self.room = np.concatenate([self.room, np.zeros(max(len(self.room), len(values)), self.room.dtype)])
        self.room[self.size : self.size + len(values)] = values
        self.size += len(values)


def closing_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where in a word a run of ASCII marks begins that ends it and follows a letter or a digit."""
    last = np.maximum.accumulate(np.where(_MARKS[data], -1, np.arange(len(data))))
    at = last[ends - 1] + 1
    at = at[(at > starts) & (at < ends)]
    # Letters of two bytes are those of Latin-1, which have signs of times and division among them.
    before, lead = data[at - 1], data[np.maximum(at - 2, 0)]
    latin = (at > 1) & (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
    return at[_ALNUM[before] | latin]


class Encoder:
    """Ids of texts under a tokenizer that never merges across white space.

    Ids are kept per white-space-free word; new words are encoded in batches. Under a tokenizer of
    the known kind capitals and marks at the end of a word need no words of their own, and words of
    small Latin letters pass the model only.
    """

    def __init__(self, path: str):
        # A task has one core; threads of the tokenizer would take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Without an id of its own for the mark, words are encoded one by one.
        own = self._ids([MARK])[0]
        self.mark = own[0] if len(own) == 1 else -1
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.known = bool(suffix) and self._parts() == (KNOWN_NORMALIZERS, KNOWN_SPLIT)
        if self.known:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
            vocabulary = self.model.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[k for token, k in vocabulary.items() if token.endswith(suffix)]] = True
        self.clear()

    def _parts(self) -> tuple:
        """The steps before the model."""
        parts = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if None in parts:
            return parts
        normalizer, split = (json.loads(x.__getstate__()) for x in parts)
        return normalizer.get("normalizers"), split.get("pretokenizers")

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.numbers.new = []
        self.starts, self.lengths = _Grown(np.int64), _Grown(np.int32)
        self.ends, self.ids = _Grown(bool), _Grown(np.int32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and their number per word, parted by a mark whose id tells them apart."""
        ids = np.array(self._ids([f" {MARK} ".join(words)])[0], np.int32)
        edges = np.flatnonzero(ids == self.mark)
        if len(edges) != len(words) - 1:  # a word holds the mark itself, or is very odd
            found = self._ids(words)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths
        return np.delete(ids, edges), np.diff(np.concatenate([[-1], edges, [len(ids)]])) - 1

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of plain words, whose last ids are known as such."""
        ids = np.array(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        last = np.flatnonzero(self.last[ids])
        return (ids, np.diff(last, prepend=-1)) if len(last) == len(words) else self._marked(words)

    def _encode_new(self) -> None:
        """Words are encoded many at a time."""
        new = self.numbers.new
        plain = np.fromiter((self.known and PLAIN.fullmatch(w) is not None for w in new), bool, len(new))
        starts, lengths = np.zeros(len(new), np.int64), np.zeros(len(new), np.int32)
        for rows, encoded in ((np.flatnonzero(plain), self._plain), (np.flatnonzero(~plain), self._marked)):
            for at in range(0, len(rows), 1024):
                some = rows[at : at + 1024]
                ids, n = encoded([new[k] for k in some.tolist()])
                starts[some], lengths[some] = self.ids.size + np.cumsum(n) - n, n
                self.ids.extend(ids)
        self.starts.extend(starts)
        self.lengths.extend(lengths)
        self.ends.extend(np.fromiter((w.endswith(SENTENCE_ENDS) for w in new), bool, len(new)))
        new.clear()

    def _words(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of all texts, and per text the number of words before it."""
        if pc.any(pc.match_substring_regex(texts, SPACES)).as_py():
            apart = pc.match_substring_regex(texts, SEPARATORS)
            texts = pc.if_else(apart, texts, pc.replace_substring_regex(texts, SPACES, " "))
        data, offsets = text_bytes(texts)
        if self.known:
            small = lowered(data)
            # Only a capital I with a dot and another sign above has other small signs, in another order.
            at = np.flatnonzero((data[:-1] == ord("I")) & (data[1:] >= 0x80))
            small[at] = ord("I")
            data = small
        starts, ends, bounds = word_bounds(data, offsets)
        if self.known and len(starts):
            at = closing_marks(data, starts, ends)
            starts, ends = np.sort(np.concatenate([starts, at])), np.sort(np.concatenate([ends, at]))
            bounds = np.searchsorted(starts, offsets, "left")
        sizes = ends - starts
        edges = np.append(0, np.cumsum(sizes))
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] = 1
        inside[ends] -= 1
        full = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
        words = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(edges), pa.py_buffer(full))
        return words.dictionary_encode(), bounds

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text its ids, the number of ids per word, and which words end a sentence."""
        if len(self.numbers) > CACHE_WORDS:
            self.clear()
        words, bounds = self._words(texts)
        different = words.dictionary.to_pylist()
        numbers = np.fromiter(map(self.numbers.__getitem__, different), np.int64, len(different))
        numbers = numbers[np.asarray(words.indices)]
        self._encode_new()
        lengths, ends = self.lengths.room[numbers].astype(np.int64), self.ends.room[numbers]
        before = np.append(0, np.cumsum(lengths))
        at = np.repeat(self.starts.room[numbers] - before[:-1], lengths) + np.arange(before[-1])
        ids = self.ids.room[at]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield ids[before[a] : before[b]], lengths[a:b], ends[a:b]


def boundaries(lengths: np.ndarray, ends: np.ndarray, max_gap: int = MAX_GAP) -> tuple[np.ndarray, np.ndarray]:
    """Positions inside a document where a cut is allowed, and what a cut there costs.

    ``lengths`` are ids per word, ``ends`` marks words that end a sentence; the end id
    comes last. Gaps over ``max_gap`` get inner boundaries; these may split a word.
    """
    total = int(lengths.sum()) + 1
    at = np.cumsum(lengths)[ends]
    at = at[(at > 0) & (np.diff(at, prepend=0) > 0)]
    edges = np.concatenate([[0], at, [total]])
    gaps = np.diff(edges)
    more = (gaps - 1) // max_gap
    if more.any():
        base = np.repeat(edges[:-1], more)
        step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        inner = base + step * max_gap
    else:
        inner = np.zeros(0, np.int64)
    position = np.concatenate([at, inner, [total]]).astype(np.int64)
    cost = np.concatenate(
        [np.full(len(at), SENTENCE_CUT), np.full(len(inner), INNER_CUT), [0]]
    )
    order = np.argsort(position, kind="stable")
    return position[order], cost[order]


def best_cuts(position: list[int], penalty: list[int], size: int = SIZE) -> list[int]:
    """Indexes of the boundaries at which windows end; the last boundary is one of them.

    The stream starts at position 0 and no two boundaries are more than ``size`` apart.
    """
    where = [0, *position]
    price = [0, *penalty]
    cost, previous = [0] * len(where), [0] * len(where)
    queue = deque([0])  # boundaries in reach, by rising cost + position
    for j in range(1, len(where)):
        while where[j] - where[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        previous[j] = i
        cost[j] = price[j] + size - where[j] + cost[i] + where[i]
        while queue and cost[queue[-1]] + where[queue[-1]] >= cost[j] + where[j]:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(where) - 1
    while j > 0:
        cuts.append(j - 1)
        j = previous[j]
    return cuts[::-1]


class Stream:
    """Documents of one task, in order, and the windows cut from them."""

    def __init__(self, task: int, size: int):
        self.size, self.next = size, task << 40
        self.docs: list[tuple[int | None, np.ndarray, np.ndarray, np.ndarray, int]] = []
        self.pending = 0

    def add(self, doc_id, ids: np.ndarray, position: np.ndarray, cost: np.ndarray) -> None:
        self.docs.append((doc_id, ids, position, cost, 0))
        self.pending += len(ids)

    def cut(self, final: bool) -> pa.RecordBatch | None:
        """The windows that are settled; what is behind them stays."""
        if not self.docs:
            return None
        starts, positions, costs, at = [], [], [], 0
        for _, ids, position, cost, done in self.docs:
            starts.append(at - done)
            open_ = position > done
            positions.append(position[open_] + (at - done))
            costs.append(cost[open_])
            at += len(ids) - done
        position = np.concatenate(positions)
        cuts = position[best_cuts(position.tolist(), np.concatenate(costs).tolist(), self.size)]
        if not final:
            cuts = cuts[:-1]
        if not len(cuts):
            return None
        rows: dict[str, list] = {name: [] for name in _NAMES}
        window, begin = 0, 0
        kept = []
        for (doc_id, ids, bounds, cost, done), start in zip(self.docs, starts):
            here = done
            while here < len(ids) and window < len(cuts):
                there = min(len(ids), int(cuts[window]) - start)
                part = np.ascontiguousarray(ids[here:there], "<u4")
                for name, value in zip(
                    _NAMES,
                    (doc_id, here, there - here, crc32(part.tobytes()), len(ids), self.next, start + here - begin,
                     part.astype(np.int32)),
                ):
                    rows[name].append(value)
                here = there
                if start + there == cuts[window]:
                    begin, window, self.next = int(cuts[window]), window + 1, self.next + 1
            if here < len(ids):
                kept.append((doc_id, ids, bounds, cost, here))
        self.docs, self.pending = kept, sum(len(d[1]) - d[4] for d in kept)
        types = [pa.int64()] * 7 + [pa.list_(pa.int32())]
        return pa.record_batch([pa.array(rows[n], t) for n, t in zip(_NAMES, types)], names=_NAMES)


def _pack(tokenizer: str, size: int, block: int):
    def run(batches):
        encoder = Encoder(tokenizer)
        stream = None
        for piece in pieces(batches):
            if stream is None:
                stream = Stream(piece.column("task")[0].as_py(), size)
            encoded = encoder.encode(piece.column("text"))
            for doc_id, (ids, lengths, ends) in zip(piece.column("doc_id").to_pylist(), encoded):
                ids = np.append(ids, np.int32(END_ID))
                stream.add(doc_id, ids, *boundaries(lengths, ends, min(MAX_GAP, size)))
                if stream.pending >= block:
                    out = stream.cut(final=False)
                    if out is not None:
                        yield out
        if stream is not None:
            out = stream.cut(final=True)
            if out is not None:
                yield out

    return run


def pack_windows(docs: DataFrame, tokenizer: str, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``tokenizer`` is the path of a file for the tokenizers library, present on every
    executor. Sequence ids are unique, not gapless: the task's number, then a count.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.spark_partition_id().alias("task"),
    )
    return rows.mapInArrow(_pack(tokenizer, size, block), OUT_DDL)
