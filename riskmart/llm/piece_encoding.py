"""SentencePiece encoding by a prefix table of merge-type tokens, and decoding.

A prefix of a text has one encoding, so it has one last token. The table holds that token for
every prefix of a word: an Aho-Corasick automaton over all pieces names the pieces that end at
a position, and the one that is compatible with the last token before it is taken. Two tokens
are compatible if merging their joined text from single characters gives back just these two;
an encoding is right exactly if all its neighbours are compatible. The ids are then read off
the table backwards, from the end of the word.

No token crosses two neighbouring characters that are neighbours in no piece. So texts are cut
into words there, and before spaces, as no piece of the models taken here has a space after
another character; every different word is encoded once. A word of any length takes time in
proportion to its length. Texts are worked on in the scan, without a shuffle.

Ids and texts equal those of the library's ``encode(text, add_bos=True, add_eos=True)`` and
``decode(ids)``.

Defined cases: a NULL text counts as empty and has the two ids for begin and end; repeated rows
give repeated rows; a NULL doc_id passes through; other columns are not looked at; an empty
table gives none.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from riskmart.llm.arrays import pieces, text_bytes

SPACE = "▁"
#: Words whose ids a task remembers, and ids of them; beyond either it begins anew.
CACHE_WORDS, CACHE_IDS = 1 << 19, 1 << 23
#: Pairs of tokens whose compatibility a task remembers.
CACHE_PAIRS = 1 << 21
#: Ids that are decoded at once.
SLICE = 1 << 20

OUT_DDL = "doc_id long, n_tokens long, ids binary, decoded string"


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The tokens of a short text by the definition: the best neighbours merge, leftmost first."""
    tokens = list(text)
    while True:
        best, at = None, -1
        for i in range(len(tokens) - 1):
            score = scores.get(tokens[i] + tokens[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            return tokens
        tokens[at : at + 2] = [tokens[at] + tokens[at + 1]]


class Vocabulary:
    """Pieces of a BPE model with byte fallback; ``model`` is its serialized form."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        rules, kinds = spec.normalizer_spec, spec.SentencePiece
        if (
            spec.trainer_spec.model_type != spec.trainer_spec.BPE
            or not spec.trainer_spec.byte_fallback
            or spec.trainer_spec.treat_whitespace_as_suffix
            or rules.precompiled_charsmap
            or not rules.add_dummy_prefix
            or rules.remove_extra_whitespaces
            or not rules.escape_whitespaces
        ):
            raise ValueError("a BPE model with byte fallback and texts left as they are is needed")
        self.model = model
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == kinds.NORMAL}
        self.bytes = [i for i, p in enumerate(spec.pieces) if p.type == kinds.BYTE]
        self.ends = (spec.trainer_spec.bos_id, spec.trainer_spec.eos_id)
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces) or len(self.bytes) != 256:
            raise ValueError("pieces that are never split, or that are switched off, are not taken")
        if any(c not in self.ids or c == SPACE and p.lstrip(SPACE).count(SPACE) for p in self.ids for c in p):
            raise ValueError("a piece has a character that is none, or a space after another character")
        #: Neighbours among the first 128 characters that no piece has.
        self.parted = np.zeros((256, 256), bool)
        self.parted[:128, :128] = True
        for piece in self.ids:
            plain = np.frombuffer(piece.replace(SPACE, " ").encode(), np.uint8)
            self.parted[plain[:-1], plain[1:]] = False
        #: Pieces that merging can reach.
        self.tokens = [p for p, i in self.ids.items() if i and merged(p, self.scores) == [p]]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.vocabulary = vocabulary
        self.texts = dict(zip(map(vocabulary.ids.get, vocabulary.tokens), vocabulary.tokens))
        self.automaton = ahocorasick.Automaton()
        for token in vocabulary.tokens:
            self.automaton.add_word(token, (vocabulary.ids[token], len(token) - 1))
        self.automaton.make_automaton()
        self.known = frozenset(t for t in vocabulary.tokens if len(t) == 1)
        self.pairs: dict[int, dict[int, bool]] = {}
        self.tested = 0
        self.library = SentencePieceProcessor(model_proto=vocabulary.model)
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.bounds, self.ids = array("q", [0]), array("I")

    def compatible(self, left: int, right: int) -> bool:
        self.tested += 1
        if self.tested % CACHE_PAIRS == 0:
            self.pairs.clear()
        a, b = self.texts[left], self.texts[right]
        found = merged(a + b, self.vocabulary.scores) == [a, b]
        self.pairs.setdefault(left, {})[right] = found
        return found

    def _run(self, text: str) -> list[int]:
        """Ids of a text of known characters."""
        # The last token of the prefix that ends with a character; no token has the id 0.
        last, pairs, none = array("i", bytes(4 * len(text))), self.pairs, {}
        for end, (token, more) in self.automaton.iter(text):
            if last[end]:
                continue
            if more == end:  # the token begins the text
                last[end] = token
                continue
            left = last[end - more - 1]
            fits = pairs.get(left, none).get(token)
            if self.compatible(left, token) if fits is None else fits:
                last[end] = token
        found, at = [], len(text)
        while at:
            found.append(last[at - 1])
            at -= len(self.texts[last[at - 1]])
        return found[::-1]

    def word(self, text: str) -> list[int]:
        """Ids of any text without a dummy prefix, spaces escaped."""
        if self.known.issuperset(text):
            return self._run(text)
        found: list[int] = []
        for known, run in groupby(text, self.known.__contains__):
            part = "".join(run)
            found += self._run(part) if known else [self.vocabulary.bytes[b] for b in part.encode()]
        return found

    def _numbered(self, words: list[str]) -> np.ndarray:
        if len(self.numbers) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            self.clear()
        numbers = np.empty(len(words), np.int64)
        for k, word in enumerate(words):
            number = self.numbers.get(word)
            if number is None:
                number = self.numbers[word] = len(self.numbers)
                self.ids.extend(self.word(word.replace(" ", SPACE)))
                self.bounds.append(len(self.ids))
            numbers[k] = number
        return numbers

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids, and the places of those that begin with a space after another character."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
        full = pc.greater(pc.binary_length(texts), 0)
        blank, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        texts = pc.if_else(full, pc.binary_join_element_wise(blank, texts, none), texts)
        data, offsets = text_bytes(texts)
        begins = data == 0x20
        begins[1:] &= data[:-1] != 0x20
        begins[1:] |= self.vocabulary.parted[data[:-1], data[1:]]
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(begins)
        words = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        number = self._numbered(words.dictionary.to_pylist())[np.asarray(words.indices)]
        bounds, ids = np.array(self.bounds, np.int64), np.array(self.ids, "<u4")
        lengths = bounds[number + 1] - bounds[number]
        before = np.append(0, np.cumsum(lengths))
        ids = ids[np.repeat(bounds[number] - before[:-1], lengths) + np.arange(before[-1])]
        first, last = self.vocabulary.ends
        places = np.searchsorted(starts, offsets)
        for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
            own = np.empty(before[b] - before[a] + 2, "<u4")
            own[0], own[1:-1], own[-1] = first, ids[before[a] : before[b]], last
            yield own, (before[a:b] - before[a] + 1)[data[starts[a:b]] == 0x20]

    def decode(self, ids: np.ndarray, words: np.ndarray) -> str:
        """The library's text, for long ones in slices that begin with a word."""
        if len(ids) <= SLICE:
            return self.library.decode(ids.tolist())
        cuts = [0]
        for at in words.tolist():
            if at - cuts[-1] >= SLICE:
                cuts.append(at)
        slices = [self.library.decode(ids[a:b].tolist()) for a, b in zip(cuts, [*cuts[1:], len(ids)])]
        # A slice loses the space that begins it.
        return " ".join(slices)


def encode_pieces(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, 32 bits each) and decoded text of every row."""
    vocabulary = Vocabulary(model)

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in pieces(batches):
            ids, decoded = [], []
            for own, words in encoder.encode(batch.column("text")):
                ids.append(own.tobytes())
                decoded.append(encoder.decode(own, words))
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), counts, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(encoded, OUT_DDL)
