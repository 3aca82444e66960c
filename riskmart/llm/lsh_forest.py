"""Near-duplicate detection with an LSH forest over MinHash signatures.

1. Documents with equal shingle sets form one class; only its first document goes on.
2. Every class has ``TREES`` labels of ``DEPTH`` minhashes. Each tree is one order of all
   labels, sorted by Spark. Labels that share ``MIN_DEPTH`` values form a region. In a
   small region all documents are compared; in a crowded one every document first only
   with its nearest pivot, a document nearest to what most of the region has. Sketches of
   the signatures, not texts, decide which comparisons become candidates.
3. Candidates are confirmed on the full shingle sets: first the best candidate of every
   document, then every other one whose documents are not yet connected. So a group of
   thousands of copies costs a confirmation per document and not one per pair.
4. Crowded regions that are not one component by then get all their pairs compared, block by
   block. Where few pairs across components have sketches that agree enough, these are
   candidates. Where there are many, the full sets of the documents meet in smaller
   blocks, all intersections of a block are counted at once, and only links that
   connect its documents leave the task. Rows grow with the blocks of a region, not with
   its pairs.
5. Components of the confirmed links give each group its smallest doc_id.

Defined cases: NULL text, or text without words: empty set, linked with nothing, kept. A
text with fewer words than a shingle is one shingle. Rows that agree in doc_id and text
are one document and get one result. NULL doc_ids count as the largest. Other columns
pass through ``near_duplicates`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.arrays import (
    U64, Stretches, lowered, mixed, pieces, signed, text_bytes, word_bounds, word_hashes,
)
from riskmart.llm.common import stored, text_key
from riskmart.llm.components import components
from riskmart.llm.repeats import NO_ID, identified, packed, unpack

WORDS, PERCENT = 5, 80
TREES, DEPTH, MIN_DEPTH = 20, 6, 4
#: Every second minhash gives four bits of the sketch.
SKETCH = TREES * DEPTH // 2
#: Share of equal sketch parts that makes a candidate, and that ends the search for a pivot.
CANDIDATE, SETTLED = 0.62, 0.85
NEIGHBOURS, PIVOTS = 8, 32
#: Rows of a region that are looked at together.
REGION_ROWS = 8192
#: Rows of a block of sketches, and rows and shingles of a block of full sets. Two blocks meet in a task.
SKETCH_ROWS, SET_ROWS, SET_SHINGLES = 4096, 1024, 1 << 20
#: Candidates per row of two blocks of sketches; with more, full sets are compared there.
PAIRS_PER_ROW = 2
#: A shingle of more documents of two blocks is counted by a matrix product.
FREQUENT = 32

SET_DDL = "id long, key long, n_shingles long, h1 long, h2 long, labels binary, sketch binary"
NODE = pa.struct([("id", pa.int64()), ("key", pa.int64())])
LINK_DDL = "a struct<id: long, key: long>, b struct<id: long, key: long>"
#: A pair, or, without ``b``, a document of a crowded region.
PAIR_DDL = f"{LINK_DDL}, score int, region long, sketch binary"
PAIR_SCHEMA = pa.schema(
    [("a", NODE), ("b", NODE), ("score", pa.int32()), ("region", pa.int64()), ("sketch", pa.binary())]
)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts, and per text the number before it."""
    data = lowered(data)
    starts, ends, bounds = word_bounds(data, offsets)
    sums = Stretches(word_hashes(data, starts, ends))
    sizes = np.diff(bounds)
    counts = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(sizes)), counts)
    first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][text]
    length = np.minimum(sizes, words)[text]
    h = mixed(mixed(sums.of(first, first + length), 6) + length.astype(U64), 7)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(sizes) + 1))


def _multipliers() -> np.ndarray:
    return mixed(np.arange(TREES * DEPTH, dtype=U64), 11) | U64(1)


def _signatures(words: int):
    def run(batches):
        multipliers = _multipliers()
        for piece in pieces(batches):
            data, offsets = text_bytes(piece.column("text"))
            h, bounds = shingle_sets(data, offsets, words)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            n = len(sizes)
            sums = np.zeros((2, n), U64)
            labels = np.zeros((n, TREES * DEPTH), "<u2")
            if len(full):
                at = bounds[:-1][full]
                for k in range(2):
                    sums[k, full] = np.add.reduceat(mixed(h, 8 + k), at)
                for k, m in enumerate(multipliers):
                    labels[full, k] = (mixed(np.minimum.reduceat(h * m, at), 12) & U64(0xFFFF)).astype("<u2")
            nibbles = (labels[:, ::2] & 15).astype(np.uint8)
            sketch = nibbles[:, ::2] << 4 | nibbles[:, 1::2]
            yield pa.record_batch(
                [
                    piece.column("id"), piece.column("key"), pa.array(sizes.astype(np.int64)),
                    pa.array(signed(sums[0])), pa.array(signed(sums[1])),
                    pa.array([x.tobytes() for x in labels], pa.binary()),
                    pa.array([x.tobytes() for x in sketch], pa.binary()),
                ],
                names=["id", "key", "n_shingles", "h1", "h2", "labels", "sketch"],
            )

    return run


def _forest_rows(batches):
    """One row per tree: region (tree and first values, hashed), label and sketch."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        labels = np.frombuffer(b"".join(batch.column("labels").to_pylist()), "<u2").reshape(n, TREES, DEPTH)
        where = np.repeat(np.arange(n), TREES)
        tree = np.tile(np.arange(TREES), n)
        rows = labels.reshape(n * TREES, DEPTH)
        region = tree.astype(U64)
        for k in range(MIN_DEPTH):
            region = mixed(region ^ (rows[:, k].astype(U64) << U64(16)), 13)
        rest = rows[:, MIN_DEPTH:].astype(np.int64)
        label = rest[:, 0]
        for k in range(1, DEPTH - MIN_DEPTH):
            label = label << 16 | rest[:, k]
        yield pa.record_batch(
            [pa.array(signed(region)), pa.array(label), *[batch.column(c).take(pa.array(where)) for c in ("sketch", "id", "key")]],
            names=["region", "label", "sketch", "id", "key"],
        )


def _pivot_pairs(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a crowded region and the pivot nearest to each."""
    open_ = np.ones(len(s), bool)
    nearest, best = np.full(len(s), -1), np.full(len(s), -1.0)
    for _ in range(PIVOTS):
        rows = np.flatnonzero(open_)
        if len(rows) < 2:
            break
        some = s[rows]
        counts = np.zeros((16, s.shape[1]), np.int64)
        for value in range(16):
            counts[value] = (some == value).sum(axis=0)
        pivot = rows[np.argmax((some == counts.argmax(axis=0).astype(np.uint8)).sum(axis=1))]
        share = (s == s[pivot]).mean(axis=1)
        open_[share >= SETTLED] = False
        open_[pivot] = False
        share[pivot] = -1.0
        nearer = (share >= CANDIDATE) & (share > best)
        nearest[nearer], best[nearer] = pivot, share[nearer]
    found = np.flatnonzero(nearest >= 0)
    return nearest[found], found


def _nodes(ids: np.ndarray, keys: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(ids), pa.array(keys)], fields=list(NODE))


def _unpacked(sketches: pa.Array) -> np.ndarray:
    packed_ = np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(len(sketches), -1)
    s = np.empty((len(sketches), SKETCH), np.uint8)
    s[:, ::2], s[:, 1::2] = packed_ >> 4, packed_ & 15
    return s


def _pair_rows(s: np.ndarray, ids: np.ndarray, keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Pairs of different rows, the smaller document first."""
    swap = (ids[a] > ids[b]) | ((ids[a] == ids[b]) & (keys[a] > keys[b]))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    differ = (ids[a] != ids[b]) | (keys[a] != keys[b])
    a, b = a[differ], b[differ]
    score = np.zeros(len(a), np.int32)
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        score[part] = (s[a[part]] == s[b[part]]).sum(axis=1)
    none = len(a)
    return pa.record_batch(
        [
            _nodes(ids[a], keys[a]), _nodes(ids[b], keys[b]), pa.array(score),
            pa.nulls(none, pa.int64()), pa.nulls(none, pa.binary()),
        ],
        schema=PAIR_SCHEMA,
    )


def _crowd_rows(nodes: pa.Array, regions: pa.Array, sketches: pa.Array) -> pa.RecordBatch:
    n = len(nodes)
    return pa.record_batch(
        [nodes, pa.nulls(n, NODE), pa.nulls(n, pa.int32()), regions, sketches], schema=PAIR_SCHEMA
    )


def _candidates(batches):
    """Over rows sorted by region and label: all pairs of small regions whose sketches agree
    enough; of a crowded region every row with its pivot, and its rows."""
    held, cut_through = None, None

    def found(region, s, ids, keys, sketches):
        n = len(region)
        edge = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        sizes = np.diff(np.append(edge, n))
        crowds = (sizes > NEIGHBOURS + 1) | (region[edge] == cut_through if cut_through is not None else False)
        crowded = np.repeat(crowds, sizes)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(1, min(NEIGHBOURS, n - 1) + 1):
            at = np.flatnonzero((region[k:] == region[:-k]) & ~crowded[:-k])
            if not len(at):
                break
            at = at[(s[at] == s[at + k]).mean(axis=1) >= CANDIDATE]
            left.append(at)
            right.append(at + k)
        for begin, size in zip(edge[crowds].tolist(), sizes[crowds].tolist()):
            a, b = _pivot_pairs(s[begin : begin + size])
            left.append(a + begin)
            right.append(b + begin)
        yield _pair_rows(s, ids, keys, np.concatenate(left), np.concatenate(right))
        at = np.flatnonzero(crowded)
        yield _crowd_rows(_nodes(ids[at], keys[at]), pa.array(region[at]), sketches.take(pa.array(at)))

    for batch in batches:
        if not batch.num_rows:
            continue
        sketches = batch.column("sketch")
        x = [np.asarray(batch.column(c)) for c in ("region", "id", "key")]
        x = [x[0], _unpacked(sketches), *x[1:]]
        if held is not None:
            x = [np.concatenate([h, v]) for h, v in zip(held, x)]
            sketches = pa.concat_arrays([held[-1], sketches])
        # A region that goes on is looked at with the next batch; a crowded one block by block.
        cut = int(np.searchsorted(x[0], x[0][-1], "left"))
        through = len(x[0]) - cut > REGION_ROWS
        keep = len(x[0]) if through else cut
        if keep:
            last = x[0][-1]
            yield from found(*[v[:keep] for v in x], sketches[:keep])
            cut_through = last if through else cut_through
        held = [*[v[keep:] for v in x], sketches[keep:]]
    if held is not None and len(held[0]):
        yield from found(*held)


def _groups(batches, names: tuple[str, ...]):
    """The rows of each group of a sorted input."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = batch if held is None else pa.concat_batches([held, batch])
        new = np.zeros(held.num_rows - 1, bool)
        for name in names:
            x = np.asarray(held.column(name))
            new |= x[1:] != x[:-1]
        edges = [0, *(np.flatnonzero(new) + 1).tolist()]
        for begin, end in zip(edges, edges[1:]):
            yield held.slice(begin, end - begin)
        held = held.slice(edges[-1])
    if held is not None:
        yield held


def _codes(*columns: np.ndarray) -> np.ndarray:
    """Equal rows get equal numbers from 0 on."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), np.int64)
    for x in columns:
        x = x[order]
        new[1:] |= x[1:] != x[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _across(batches):
    """Over two blocks of a region at a time: pairs of different components whose sketches agree
    enough; where they are many, the rows that have such a pair."""
    for group in _groups(batches, ("region", "i", "j")):
        node, root = group.column("node"), group.column("root")
        ids, keys, *roots = [np.asarray(x.field(c)) for x in (node, root) for c in ("id", "key")]
        root = _codes(*roots)
        s, n = _unpacked(group.column("sketch")), group.num_rows
        # Pairs within the largest component need no look: its rows only stand on the right.
        large = root == np.bincount(root).argmax()
        rank = np.where(large, n, np.arange(n))
        own = np.flatnonzero(~large)
        left, right, n_pairs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        paired = np.zeros(n, bool)
        step = max(1, (1 << 25) // (n * SKETCH))
        for at in range(0, len(own), step):
            rows = own[at : at + step]
            near = (s[rows][:, None, :] == s[None, :, :]).mean(axis=2) >= CANDIDATE
            near &= (root[rows][:, None] != root) & (rank > rows[:, None])
            a, b = np.nonzero(near)
            a = rows[a]
            paired[a] = paired[b] = True
            n_pairs += len(a)
            if n_pairs <= PAIRS_PER_ROW * n:
                left.append(a)
                right.append(b)
        if n_pairs <= PAIRS_PER_ROW * n:
            yield _pair_rows(s, ids, keys, np.concatenate(left), np.concatenate(right))
            continue
        place = [np.asarray(group.column(c)).astype(np.int64).view(U64) for c in ("region", "i", "j")]
        crowd = signed(mixed(mixed(mixed(place[0], 14) + place[1], 15) + place[2], 16))
        keep = pa.array(np.flatnonzero(paired))
        yield _crowd_rows(node.take(keep), pa.array(crowd).take(keep), group.column("sketch").take(keep))


def common_counts(h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sizes of the intersections of all pairs of ``n`` sets, given as elements and their sets."""
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    edge = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(edge, len(h)))
    common = np.zeros((n, n), np.float32)
    frequent = np.flatnonzero(sizes > FREQUENT)
    for at in range(0, len(frequent), 2048):
        some = frequent[at : at + 2048]
        count = sizes[some]
        column = np.repeat(np.arange(len(some)), count)
        rows = np.repeat(edge[some] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        holds = np.zeros((n, len(some)), np.float32)
        holds[owner[rows], column] = 1
        common += holds @ holds.T
    rare = np.repeat(sizes <= FREQUENT, sizes)
    h, owner = h[rare], owner[rare]
    for k in range(1, FREQUENT):
        at = np.flatnonzero(h[k:] == h[:-k]) if len(h) > k else []
        if not len(at):
            break
        x = np.bincount(owner[at] * n + owner[at + k], minlength=n * n).reshape(n, n)
        common += x + x.T
    return common


def _spanning(linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that connect what all links connect."""
    left, right = [], []
    new = np.ones(len(linked), bool)
    for start in range(len(linked)):
        if not new[start]:
            continue
        new[start] = False
        waiting = [start]
        while waiting:
            row = waiting.pop()
            more = np.flatnonzero(linked[row] & new).tolist()
            new[more] = False
            left += [row] * len(more)
            right += more
            waiting += more
    return left, right


def _dense(words: int, percent: int):
    """Over two blocks of full texts at a time: links that connect what their links connect."""

    def run(batches):
        for group in _groups(batches, ("region", "i", "j")):
            found, sizes = [], []
            for piece in pieces([group], "blob", 256 << 10):
                h, bounds = shingle_sets(*unpack(piece.column("blob")), words)
                found.append(h)
                sizes.append(np.diff(bounds))
            sizes, n = np.concatenate(sizes), group.num_rows
            common = common_counts(np.concatenate(found), np.repeat(np.arange(n), sizes), n).astype(np.int64)
            linked = 100 * common >= percent * (sizes[:, None] + sizes - common)
            np.fill_diagonal(linked, False)
            a, b = _spanning(linked)
            node = group.column("node")
            yield pa.record_batch([node.take(pa.array(x, pa.int64())) for x in (a, b)], names=["a", "b"])

    return run


def _in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """``rows`` dealt so that any two of a region meet: each of its ``blocks`` with each other one, as
    region, i, j."""
    own = F.pmod(F.xxhash64("node"), F.col("_blocks"))
    dealt = (
        rows.withColumn("_blocks", blocks.cast("long"))
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .where((F.col("_other") != F.col("_own")) | (F.col("_blocks") == 1))
        .withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other")})
        .drop("_blocks", "_own", "_other")
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "region", "i", "j").sortWithinPartitions("region", "i", "j", "node")


def _confirm(words: int, percent: int):
    def run(batches):
        for piece in pieces(batches, "blob_a", 256 << 10):
            left, right = (
                shingle_sets(*unpack(piece.column(c)), words) for c in ("blob_a", "blob_b")
            )
            good = []
            for i in range(piece.num_rows):
                a = left[0][left[1][i] : left[1][i + 1]]
                b = right[0][right[1][i] : right[1][i + 1]]
                common = len(np.intersect1d(a, b, assume_unique=True))
                good.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.record_batch(
                [piece.column("a"), piece.column("b")], names=["a", "b"]
            ).filter(pa.array(good))

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough. ``texts`` has node and blob."""
    side = lambda c: texts.select(F.col("node").alias(c), F.col("blob").alias(f"blob_{c}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "blob_a", "blob_b").mapInArrow(_confirm(words, percent), LINK_DDL)


def crowd_links(
    crowds: DataFrame, roots: DataFrame, texts: DataFrame, n_shingles: DataFrame, words: int, percent: int
) -> DataFrame | None:
    """Links across the components ``roots`` (node, root) in crowded regions (node, region, sketch), so many
    that all that are linked there are connected. None where each region is one component."""
    rooted = stored(
        crowds.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "crowds"
    )
    several = (
        rooted.groupBy("region")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
        .where(F.col("low") < F.col("high"))
        .select("region", "n")
    )
    rows = rooted.join(several, "region")
    across = stored(
        _in_blocks(rows, F.ceil(F.col("n") / SKETCH_ROWS)).select("region", "i", "j", "node", "root", "sketch")
        .mapInArrow(_across, PAIR_DDL),
        "across",
    )
    if across.isEmpty():
        return None
    links = confirmed(across.where(F.col("b").isNotNull()).select("a", "b").distinct(), texts, words, percent)
    dense = across.where(F.col("b").isNull()).select("region", F.col("a").alias("node"))
    if dense.isEmpty():
        return links
    sized = (
        dense.join(n_shingles, "node").groupBy("region").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    )
    blocks = F.ceil(F.greatest(F.col("n") / SET_ROWS, F.col("size") / SET_SHINGLES))
    rows = dense.join(sized, "region").join(texts, "node").select("region", "n", "size", "node", "blob")
    met = _in_blocks(rows, blocks).select("region", "i", "j", "node", "blob")
    return links.unionByName(met.mapInArrow(_dense(words, percent), LINK_DDL))


def duplicate_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: id, key, n_shingles and root (the first document of its group)."""
    sets = stored(identified(docs).mapInArrow(_signatures(words), SET_DDL), "signatures")
    node = F.struct("id", "key")
    classes = stored(
        sets.where(F.col("n_shingles") > 0)
        .groupBy("h1", "h2")
        .agg(
            F.min(node).alias("node"),
            *[F.first(c).alias(c) for c in ("labels", "sketch", "n_shingles")],
        ),
        "classes",
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forest = classes.select("node.id", "node.key", "labels", "sketch").mapInArrow(
        _forest_rows, "region long, label long, sketch binary, id long, key long"
    )
    found = stored(
        forest.repartition(parts, "region")
        .sortWithinPartitions("region", "label", "id", "key")
        .mapInArrow(_candidates, PAIR_DDL),
        "regions",
    )
    pairs = stored(
        found.where(F.col("b").isNotNull()).groupBy("a", "b").agg(F.max("score").alias("score")), "candidates"
    )
    crowds = found.where(F.col("b").isNull()).select(F.col("a").alias("node"), "region", "sketch")
    ends = (
        pairs.select(F.col("a").alias("node"))
        .unionByName(pairs.select(F.col("b").alias("node")))
        .unionByName(crowds.select("node"))
        .distinct()
    )
    texts = packed(docs).select(node.alias("node"), "blob")
    texts = stored(texts.join(ends, "node", "left_semi").dropDuplicates(["node"]), "candidate-texts")

    # The best candidate of every document first, on the side of the smaller one at ties.
    both = pairs.select("a", "b", "score", F.col("a").alias("node")).unionByName(
        pairs.select("a", "b", "score", F.col("b").alias("node"))
    )
    best = (
        both.groupBy("node")
        .agg(F.max_by(F.struct("a", "b"), F.struct("score", F.struct(-F.col("a.id"), -F.col("b.id")))).alias("pair"))
        .select("pair.a", "pair.b")
        .distinct()
    )
    links = stored(confirmed(best, texts, words, percent), "links-one")
    roots = stored(components(links), "roots-one")
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    apart = (
        pairs.join(of("a"), "a", "left")
        .join(of("b"), "b", "left")
        .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
        .select("a", "b")
        .join(best, ["a", "b"], "left_anti")
    )
    links = stored(links.unionByName(confirmed(apart, texts, words, percent)), "links-two")
    if not crowds.isEmpty():
        roots = stored(components(links), "roots-two")
        more = crowd_links(crowds, roots, texts, classes.select("node", "n_shingles"), words, percent)
        if more is not None:
            links = links.unionByName(more)
    roots = components(links)
    rooted = classes.select("h1", "h2", "node").join(roots, "node", "left").select(
        "h1", "h2", F.coalesce("root", "node").alias("root")
    )
    return sets.select("id", "key", "n_shingles", "h1", "h2").join(rooted, ["h1", "h2"], "left").select(
        "id",
        "key",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(node).alias("root"),
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    given = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return duplicate_classes(docs, words, percent).select(
        given("id").alias("doc_id"),
        "n_shingles",
        given("root.id").alias("component_id"),
        (F.col("id") == F.col("root.id")).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The first document of every group, once, with all its columns.

    Of rows that agree in doc_id and text one stays, if the text has shingles.
    """
    firsts = (
        duplicate_classes(docs, words, percent)
        .where(F.col("root") == F.struct("id", "key"))
        .groupBy(F.struct("id", "key").alias("_kept_document"))
        # Texts whose hashes agree may be one with shingles and one without.
        .agg(((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("_again"))
    )
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.struct(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
            text_key(F.col("text")).alias("key"),
        ).alias("_kept_document"),
    )
    found = stored(own.join(firsts, "_kept_document"), "near-firsts")
    # Only rows that come again are grouped; each task sends one row per document.
    once = (
        found.where("_again")
        .groupBy("_kept_document", F.md5(F.col("_row.text")).alias("_text"))
        .agg(F.first("_row").alias("_row"))
    )
    rows = found.where(~F.col("_again")).select("_row").unionByName(once.select("_row"))
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
