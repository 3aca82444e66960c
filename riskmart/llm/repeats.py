"""Finding stretches of fixed length that occur more than once, in a corpus of any size.

A document is a sequence of symbols (bytes or words). All windows of ``window`` symbols are
put into runs: neighbouring windows with the same smallest hash among their grams of
``gram`` symbols (a minimizer). Equal windows have the same smallest hash, so they meet in
one group, and one run stands for about a dozen windows. Nothing is lost by this.

Level one compares runs by their whole content. Runs of one group that differ may still
share windows; of these, one run per content goes on. Level two ranks them by a longer
part of the text around their gram, and drops what is unique; level three compares windows.

Before the shuffle, a task keeps one row per content and piece of input: a passage that a
third of all documents hold is one row per piece and not one per document.

Two rules exist. EARLIER: a window counts as repeated where a document with a smaller
number has it. ANYWHERE: every window that occurs twice is repeated, all its places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.arrays import (
    U64, Stretches, merged_spans, mixed, pieces, signed, sliding_min, text_bytes, word_bounds, word_hashes,
)
from riskmart.llm.common import released, stored, text_key

EARLIER, ANYWHERE = "earlier", "anywhere"
RUNS, RANKS, WINDOWS = "runs", "ranks", "windows"
#: Kinds of rows: still to be compared; a repeated stretch; a run that differs in its group;
#: a part of an unclear run, which others of its group are compared with.
OPEN, COVER, UNCLEAR, WITNESS = 0, 1, 2, 3
#: NULL document numbers are taken as the largest.
NO_ID = (1 << 63) - 1

ROW_DDL = "a long, b long, id long, key long, at long"
ROW_SCHEMA = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("id", pa.int64()), ("key", pa.int64()), ("at", pa.int64())]
)
#: ``at`` holds first window (31 bits), windows (24 bits), times (2 bits) and kind (2 bits).
_N_BITS, _TIMES_BITS, _KIND_BITS = 24, 4, 4
#: Most windows of a run or of a stretch in one row; a longer one is several.
LONGEST = 1 << 20


@dataclass(frozen=True)
class Unit:
    """What is compared: ``words`` or bytes, in windows of ``window``."""

    words: bool
    window: int
    gram: int
    rule: str


def identified(docs: DataFrame) -> DataFrame:
    """id, key (the text's hash, to part rows with equal ids or without one) and text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        text_key(F.col("text")).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _rows(*, kind, id, key, first, n, times=1, a=None, b=0) -> pa.RecordBatch:
    """Rows in the narrow form that is shuffled; without ``a`` they are dealt by document."""
    size = len(id)
    wide = lambda x: np.broadcast_to(np.asarray(x), (size,)).astype(np.int64)
    at = ((wide(first) << _N_BITS | wide(n)) << _TIMES_BITS | wide(times)) << _KIND_BITS | wide(kind)
    a = signed(mixed(np.asarray(id).astype(U64), 3)) if a is None else wide(a)
    return pa.record_batch(
        [pa.array(a), pa.array(wide(b)), pa.array(wide(id)), pa.array(wide(key)), pa.array(at)],
        schema=ROW_SCHEMA,
    )


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    x = {f.name: np.asarray(batch.column(f.name)) for f in ROW_SCHEMA}
    at = x.pop("at")
    x["kind"], at = at & ((1 << _KIND_BITS) - 1), at >> _KIND_BITS
    x["times"], at = at & ((1 << _TIMES_BITS) - 1), at >> _TIMES_BITS
    x["n"], x["first"] = at & ((1 << _N_BITS) - 1), at >> _N_BITS
    return x


def _readable(rows: DataFrame) -> DataFrame:
    """id, key, first, n, times and kind of rows."""
    at = F.col("at")
    return rows.select(
        "id",
        "key",
        F.shiftright(at, _N_BITS + _TIMES_BITS + _KIND_BITS).cast("int").alias("first"),
        F.shiftright(at, _TIMES_BITS + _KIND_BITS).bitwiseAND(F.lit((1 << _N_BITS) - 1)).cast("int").alias("n"),
        F.shiftright(at, _KIND_BITS).bitwiseAND(F.lit((1 << _TIMES_BITS) - 1)).cast("int").alias("times"),
        at.bitwiseAND(F.lit((1 << _KIND_BITS) - 1)).cast("int").alias("kind"),
    )


def symbols_of(data: np.ndarray, offsets: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts and per text the number of symbols before it."""
    if not words:
        return data.astype(U64) + U64(1), offsets
    starts, ends, bounds = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), bounds


def _parted(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges in parts of ``LONGEST`` at most: which range, first and size of every part."""
    parts = -(-n // LONGEST)
    owner = np.repeat(np.arange(len(n)), parts)
    skipped = LONGEST * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
    return owner, first[owner] + skipped, np.minimum(n[owner] - skipped, LONGEST)


def _runs(symbols: np.ndarray, bounds: np.ndarray, unit: Unit):
    """text index, first window (within its text), windows, group hash, content hash and
    whether the smallest gram comes twice, so that windows of the run may be equal."""
    n, w = len(symbols), unit.window
    if n < w:
        return [np.zeros(0, np.int64)] * 6
    sums = Stretches(symbols)
    grams = mixed(sums.fixed(unit.gram), 1)
    smallest = sliding_min(grams, w - unit.gram + 1)
    sizes = np.diff(bounds)
    ends = np.repeat(bounds[1:], sizes)[: n - w + 1]
    valid = ends - np.arange(n - w + 1) >= w
    same = np.zeros(n - w + 1, bool)
    same[1:] = valid[1:] & valid[:-1] & (smallest[1:] == smallest[:-1])
    first = np.flatnonzero(valid & ~same)
    last_mask = valid.copy()
    last_mask[:-1] &= ~same[1:]
    last = np.flatnonzero(last_mask)
    _, first, sizes = _parted(first, last - first + 1)
    last = first + sizes - 1
    text = np.searchsorted(bounds, first, "right") - 1
    content = mixed(sums.of(first, last + w), 2)
    twice = np.zeros(len(first), bool)
    if unit.rule == ANYWHERE and len(first):
        sizes = last - first + w - unit.gram + 1
        run = np.repeat(np.arange(len(first)), sizes)
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(run))
        twice = np.bincount(run[grams[at] == smallest[first][run]], minlength=len(first)) > 1
    return text, first - bounds[text], last - first + 1, smallest[first], content, twice


def _extract(unit: Unit) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for piece in pieces(batches):
            data, offsets = text_bytes(piece.column("text"))
            symbols, bounds = symbols_of(data, offsets, unit.words)
            text, first, n, a, b, twice = _runs(symbols, bounds, unit)
            if not len(text):
                continue
            ids = np.asarray(piece.column("id"))[text]
            keys = np.asarray(piece.column("key"))[text]
            order = np.lexsort((first, ids, b, a))
            sa, sb = a[order], b[order]
            head = np.ones(len(order), bool)
            head[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
            group = np.cumsum(head) - 1
            times = np.bincount(group)
            heads = np.flatnonzero(head)
            if unit.rule == EARLIER:
                # All places in the first document stay open: an earlier piece may settle them.
                sid = ids[order]
                known = sid > sid[heads][group]
                keep, weight = order[~known], 1
            else:
                known = times[group] > 1
                keep, weight = order[heads], np.minimum(times, 2)
            yield _rows(
                kind=OPEN, a=signed(a[keep]), b=signed(b[keep]), id=ids[keep], key=keys[keep],
                first=first[keep], n=n[keep], times=weight,
            )
            again = keep[twice[keep]]
            if len(again):
                yield _rows(
                    kind=UNCLEAR, id=ids[again], key=keys[again], first=first[again], n=n[again],
                )
            found = order[known]
            if len(found):
                yield from _spans(ids[found], keys[found], first[found], n[found], text[found], unit.window)

    return run


def _spans(ids, keys, first, n, text, window) -> Iterator[pa.RecordBatch]:
    """Repeated runs of a piece as COVER rows, neighbours joined; dealt by document."""
    wide = text.astype(np.int64) << 32
    starts, ends = merged_spans(wide + first, wide + first + n + window - 1)
    place = {t: i for i, t in enumerate(text.tolist())}
    at = np.fromiter((place[t] for t in (starts >> 32).tolist()), np.int64, len(starts))
    owner, first, n = _parted(starts & 0xFFFFFFFF, ends - starts - window + 1)
    yield _rows(kind=COVER, id=ids[at[owner]], key=keys[at[owner]], first=first, n=n)


def _resolve(rule: str, level: str):
    """Over rows sorted by a, b, id: finds repeated contents and what is still unclear.

    RUNS: equal a and b are equal runs; a group of equal a with several b is unclear.
    RANKS: equal a is an equal part of a window; groups that come twice stay unclear.
    WINDOWS: equal a and b are equal windows.
    """

    def groups(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        a, b, ids = x["a"], x["b"], x["id"]
        new_a, new_b = np.ones(len(a), bool), np.ones(len(a), bool)
        new_a[1:] = a[1:] != a[:-1]
        new_b[1:] = new_a[1:] | (b[1:] != b[:-1])
        heads, outer = np.flatnonzero(new_b), np.flatnonzero(new_a)
        group, group_a = np.cumsum(new_b) - 1, np.cumsum(new_a) - 1
        times = np.bincount(group, weights=x["times"]).astype(np.int64)
        several = (
            np.minimum.reduceat(ids, outer) != np.maximum.reduceat(ids, outer)
            if rule == EARLIER
            else np.bincount(group_a, weights=x["times"]) > 1
        )
        pick = lambda at, kind, times=1: _rows(
            kind=kind, id=ids[at], key=x["key"][at], first=x["first"][at], n=x["n"][at], times=times
        )
        if level == RANKS:
            at = np.flatnonzero(several[group_a] & (x["kind"] == OPEN))
            if len(at):
                yield pick(at, UNCLEAR, x["times"][at])
            return
        covered = ids > ids[heads][group] if rule == EARLIER else times[group] > 1
        if covered.any():
            yield pick(np.flatnonzero(covered), COVER)
        if level == RUNS:
            differing = (np.bincount(group_a[heads]) > 1) & several
            at = np.flatnonzero(~covered & differing[group_a]) if rule == EARLIER else heads[differing[group_a[heads]]]
            if len(at):
                yield pick(at, UNCLEAR, np.minimum(times[group[at]], 2))

    def run(batches):
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            x = _columns(batch)
            done = (x["kind"] == COVER) | (x["kind"] == UNCLEAR)
            if done.any():
                yield _rows(**{k: v[done] for k, v in x.items() if k not in ("a", "b")})
                x = {k: v[~done] for k, v in x.items()}
            if not len(x["a"]):
                continue
            # The last group may go on in the next batch; a group has a row per piece at most.
            cut = int(np.searchsorted(x["a"], x["a"][-1], "left"))
            if cut and held:
                held.append({k: v[:cut] for k, v in x.items()})
                yield from groups({k: np.concatenate([h[k] for h in held]) for k in x})
                held = [{k: v[cut:] for k, v in x.items()}]
            elif held and held[0]["a"][0] == x["a"][0]:
                held.append(x)
            else:
                if held:
                    yield from groups({k: np.concatenate([h[k] for h in held]) for k in x})
                if cut:
                    yield from groups({k: v[:cut] for k, v in x.items()})
                held = [{k: v[cut:] for k, v in x.items()}]
        if held:
            yield from groups({k: np.concatenate([h[k] for h in held]) for k in held[0]})

    return run


def resolved(rows: DataFrame, rule: str, level: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "a").sortWithinPartitions("a", "b", "id", "at")
    return _readable(dealt.mapInArrow(_resolve(rule, level), ROW_DDL))


def runs(docs: DataFrame, unit: Unit) -> DataFrame:
    return identified(docs).mapInArrow(_extract(unit), ROW_DDL)


def packed(docs: DataFrame) -> DataFrame:
    """id, key and the text as a compressed blob: what has to be shuffled with its marks."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for piece in pieces(batches):
            data, offsets = text_bytes(piece.column("text"))
            raw = data.tobytes()
            blobs = [pack.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.record_batch(
                [piece.column("id"), piece.column("key"), pa.array(blobs, pa.binary())], names=["id", "key", "blob"]
            )

    return identified(docs).mapInArrow(run, "id long, key long, blob binary")


def marked_texts(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """id, key, blob and the marks of the document as two arrays (NULL if none)."""
    lists = marks.groupBy(F.col("id").alias("mark_id"), F.col("key").alias("mark_key")).agg(
        F.collect_list(F.struct("first", "n", "times")).alias("marks")
    )
    texts = packed(docs)
    joined = texts.join(lists, (texts["id"] == lists["mark_id"]) & (texts["key"] == lists["mark_key"]), how)
    return joined.select(
        "id", "key", "blob", *[F.col(f"marks.{c}").alias(c) for c in ("first", "n", "times")]
    )


def unpack(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = [zstandard.ZstdDecompressor().decompress(b) for b in blobs.to_pylist()]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def _marks(piece: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Text number, first window, windows and times of all marks of a piece."""
    first = piece.column("first")
    text = np.repeat(np.arange(piece.num_rows), np.asarray(pc.list_value_length(first)))
    flat = [np.asarray(piece.column(c).flatten()).astype(np.int64) for c in ("first", "n", "times")]
    return text, *flat


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of ranges, and the range each belongs to."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(owner)), owner


def _halves(unit: Unit):
    """The windows of a run that lie left of its gram, and the others, each named by the
    part of the text that all of them share: the gram and half of what else a window has.

    A run that has its gram several times goes on whole. A window of it may hold the gram
    once and be in a run of another document that has it once, so each place of the gram
    gives names too: WITNESS rows, one per name and run.
    """
    left = (unit.window - unit.gram + 1) // 2
    right = unit.window - unit.gram - left + 1

    def run(batches):
        for piece in pieces(batches, "blob", 256 << 10):
            data, offsets = unpack(piece.column("blob"))
            symbols, bounds = symbols_of(data, offsets, unit.words)
            text, first, n, times = _marks(piece)
            if not len(text):
                continue
            sums = Stretches(symbols)
            grams = mixed(sums.fixed(unit.gram), 1)
            ids, keys = np.asarray(piece.column("id"))[text], np.asarray(piece.column("key"))[text]
            start = first + bounds[text]
            sizes = n + unit.window - unit.gram
            at, owner = _spread(start, sizes)
            edges = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(grams[at], edges)
            is_least = grams[at] == least[owner]
            several = np.add.reduceat(is_least.astype(np.int64), edges) > 1
            if several.any():
                yield _rows(
                    kind=UNCLEAR, id=ids[several], key=keys[several], first=first[several], n=n[several],
                    times=times[several],
                )
            anchor, owner = at[is_least], owner[is_least]
            # Windows that hold the gram at this place; those up to the border hold ``left``
            # symbols before the gram, later ones ``right`` behind it.
            low = np.maximum(start[owner], anchor - unit.window + unit.gram)
            high = np.minimum(start[owner] + n[owner], anchor + 1)
            border = np.clip(anchor - left + 1, low, high)
            for seed, begin, size, a, b in (
                (31, low, border - low, anchor - left, anchor + unit.gram),
                (32, border, high - border, anchor, anchor + unit.gram + right),
            ):
                some = np.flatnonzero(size > 0)
                name = signed(mixed(sums.of(a[some], b[some]), seed))
                again = several[owner[some]]
                once = np.flatnonzero(~again)
                again = np.flatnonzero(again)
                if len(again):
                    order = again[np.lexsort((name[again], owner[some[again]]))]
                    new = np.ones(len(order), bool)
                    new[1:] = (name[order[1:]] != name[order[:-1]]) | (owner[some[order[1:]]] != owner[some[order[:-1]]])
                    again = order[new]
                for kind, rows in ((OPEN, once), (WITNESS, again)):
                    if len(rows):
                        place, run = some[rows], owner[some[rows]]
                        yield _rows(
                            kind=kind, a=name[rows], id=ids[run], key=keys[run],
                            first=begin[place] - bounds[text[run]], n=size[place], times=times[run],
                        )

    return run


def _windows(unit: Unit):
    """The windows of marked runs: named by the ranks of their halves."""

    def run(batches):
        half = unit.window // 2
        for piece in pieces(batches, "blob", 256 << 10):
            data, offsets = unpack(piece.column("blob"))
            symbols, bounds = symbols_of(data, offsets, unit.words)
            text, first, n, times = _marks(piece)
            if not len(text):
                continue
            sums = Stretches(symbols)
            at, owner = _spread(first, n)
            text = text[owner]
            place = at + bounds[text]
            a = mixed(sums.of(place, place + half), 4)
            b = mixed(sums.of(place + half, place + unit.window), 5)
            yield _rows(
                kind=OPEN, a=signed(a), b=signed(b), id=np.asarray(piece.column("id"))[text],
                key=np.asarray(piece.column("key"))[text], first=at, n=1, times=times[owner],
            )

    return run


def _unclear(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("kind") == UNCLEAR)
        .groupBy("id", "key", "first", "n")
        .agg(F.max("times").alias("times"))
    )


def repeated_stretches(docs: DataFrame, unit: Unit) -> DataFrame:
    """id, key, first and n: windows first to first + n - 1 of the document are repeated.

    Each step is stored, and the shuffle files of the one before are released.
    """
    level_one = released(stored(resolved(runs(docs, unit), unit.rule, RUNS), "repeats-runs"))
    halves = marked_texts(docs, _unclear(level_one), "inner").mapInArrow(_halves(unit), ROW_DDL)
    level_two = released(stored(resolved(halves, unit.rule, RANKS), "repeats-ranks"))
    windows = marked_texts(docs, _unclear(level_two), "inner").mapInArrow(_windows(unit), ROW_DDL)
    level_three = released(stored(resolved(windows, unit.rule, WINDOWS), "repeats-windows"))
    covers = level_one.where(F.col("kind") == COVER).unionByName(level_three)
    return covers.select("id", "key", "first", "n", "times")
