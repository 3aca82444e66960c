"""Prefix trie of rebuilt conversations, rolled up by centroid decomposition.

Conversations are rebuilt: the first h turns of a donor conversation take the place of a
conversation's own first h turns. Every distinct beginning of the rebuilt ones is a node of the
trie, named by its smallest member and its depth. 128 bits stand for a beginning: the exclusive
or of the hashes of its turns with their places, so beginnings are found by running sums over
slices of a conversation and never by strings.

Sums over subtrees follow the decomposition of the parent edges: in each component the centroid,
the deepest node below which half of the weight lies, is cut out; the total of its subtree is
added to all nodes on the way from it to the component's top; the parts that remain are
components again, each with half the weight at most. The weight of a node is the number of
conversations that pass it, so weights of subtrees are known from one grouping and follow the
cuts by the same additions. Large components are cut with joins; a component of ``PART_NODES``
or less goes to one task, which does the same in memory. A chain as long as the longest
conversation takes a logarithm of rounds, not one per turn.

No step gathers a conversation, the members of a node or a node's children: places within a
conversation come from a global sort, lists of members are written piece by piece.

Defined cases: turns go by turn (NULL first) and, where equal, by the MD5 of role and text, so
repeated rows are turns of their own; NULL role or text counts as empty; rows without conv_id
are left out; the donor of a negative id is rounded towards 0; other columns are not looked at;
an empty table gives no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import stored, words

#: Conversations that share a donor; a donor lends fewer than ``LENT`` turns.
DONOR_SPAN, LENT = 20, 4
#: Turns of a conversation whose hashes are summed in one window.
SLICE_TURNS = 4096
#: Nodes of a component that one task takes.
PART_NODES = 20_000
#: Members that are written as one piece of text.
PIECE_MEMBERS = 1 << 16

NODE = ["depth", "p1", "p2"]
TOTALS_DDL = "conv_id long, depth long, n_leaves long, saved_tokens long"
PIECE_DDL = "depth long, p1 long, p2 long, part long, piece long, members string"
HASH_DDL = "depth long, p1 long, p2 long, ends_sha256 string"


def _lane(digits: Column, at: int) -> Column:
    return F.conv(F.substring(digits, at, 16), 16, -10).cast("long")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), a, b (hash of role and text) and words of every turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digits = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = (
        conversations.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn", digits.alias("digits"),
            F.size(words(text)).cast("long").alias("words"),
        )
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_first("turn"), F.asc("digits")]
    rows = rows.repartitionByRange(parts, F.asc("conv_id"), *order).withColumn("part", F.spark_partition_id())
    rows = stored(rows, "turns")
    # A conversation that began in an earlier part is the first of its part: a row per part at most.
    sizes = rows.groupBy("conv_id", "part").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "part", F.sum("size").over(earlier).alias("before")).where("before > 0")
    place = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    return (
        rows.withColumn("place", place.cast("long") - 1)
        .join(F.broadcast(offsets), ["conv_id", "part"], "left")
        .select(
            "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"),
            _lane(F.col("digits"), 1).alias("a"), _lane(F.col("digits"), 17).alias("b"), "words",
        )
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, length), and their turns by depth from 1."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    given = sizes.select(F.col("conv_id").alias("donor"), F.col("size").alias("donor_size"))
    convs = (
        sizes.withColumn("donor", F.col("conv_id") - F.col("conv_id") % DONOR_SPAN)
        .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT)
        .join(given, "donor", "left")
        .withColumn("taken", F.least("h", F.coalesce("donor_size", F.lit(0))))
        .withColumn("length", F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0)))
        .select("conv_id", "donor", "h", "taken", "length")
    )
    convs = stored(convs, "rebuilt")
    heads = turns.where((F.col("conv_id") % DONOR_SPAN == 0) & (F.col("place") < LENT - 1))
    heads = heads.select(F.col("conv_id").alias("donor"), "place", "a", "b", "words")
    columns = ["conv_id", "length", "depth", "a", "b", "words"]
    lent = convs.join(heads, "donor").where("place < taken").withColumn("depth", F.col("place") + 1)
    own = turns.join(convs, "conv_id").where("place >= h").withColumn("depth", F.expr("taken + place - h + 1"))
    return convs.select("conv_id", "length"), lent.select(columns).unionByName(own.select(columns))


def beginnings(rows: DataFrame) -> DataFrame:
    """Rows with the hash of the beginning that ends there (p1, p2) and of the one before (q1, q2)."""
    rows = rows.withColumns(
        {
            "g1": F.xxhash64("depth", "a", "b"),
            "g2": F.xxhash64("b", "a", "depth"),
            "slice": F.floor((F.col("depth") - 1) / SLICE_TURNS),
        }
    )
    sums = [F.bit_xor(F.col(g)).alias(g) for g in ("g1", "g2")]
    slices = rows.groupBy("conv_id", "slice").agg(*sums)
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.select(
        "conv_id", "slice", *[F.bit_xor(F.col(g)).over(earlier).alias(f"before_{g}") for g in ("g1", "g2")]
    ).where("slice > 0")
    so_far = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    within = rows.withColumns({f"in_{g}": F.bit_xor(F.col(g)).over(so_far) for g in ("g1", "g2")})
    joined = within.join(before, ["conv_id", "slice"], "left")
    full = {
        f"p{k}": F.col(f"in_g{k}").bitwiseXOR(F.coalesce(f"before_g{k}", F.lit(0).cast("long"))) for k in (1, 2)
    }
    return (
        joined.withColumns(full)
        .withColumns({f"q{k}": F.col(f"p{k}").bitwiseXOR(F.col(f"g{k}")) for k in (1, 2)})
        .select("conv_id", "length", "depth", "p1", "p2", "q1", "q2", "words")
    )


def trie_nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """A row per node; the weight is the number of turns of members from the node on."""
    zero = F.lit(0).cast("long")
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
    )
    root = convs.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("length") + 1).alias("weight")
    ).where("n_convs > 0")
    root = root.withColumns({c: zero for c in (*NODE, "words")} | {c: F.lit(None).cast("long") for c in ("q1", "q2")})
    nodes = stored(nodes.unionByName(root), "nodes")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    nodes = stored(nodes.join(parents, ["depth", "q1", "q2"], "left"), "edges")
    children = nodes.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    return stored(
        nodes.join(children, ["conv_id", "depth"], "left").select(
            "conv_id", *NODE, "parent_conv_id", "n_convs", "weight", F.coalesce("n_children", zero).alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        ),
        "trie",
    )


def subtree_totals(parents: list[int], weights: list[int], values: list[tuple[int, int]]) -> list[list[int]]:
    """Sums over the subtrees of one tree; parents come first, the top has the parent -1.

    ``weights`` are those of subtrees, at least 1 for each node of it.
    """
    totals, weight = [list(v) for v in values], list(weights)
    stack = [list(range(len(parents)))] if parents else []
    while stack:
        part = stack.pop()
        top = part[0]
        # Nodes with half the weight lie on one path, so the last of them is the deepest.
        at = max(k for k, u in enumerate(part) if 2 * weight[u] >= weight[top])
        centre, home, below, rest = part[at], {}, {}, part[:at]
        total = list(values[centre])
        for u in part[at + 1 :]:
            own = u if parents[u] == centre else home.get(parents[u])
            if own is None:
                rest.append(u)
                continue
            home[u] = own
            below.setdefault(own, []).append(u)
            total[0] += values[u][0]
            total[1] += values[u][1]
        for place in (0, 1):
            totals[centre][place] += total[place] - values[centre][place]
        u = centre
        while u != top:
            u = parents[u]
            totals[u][0] += total[0]
            totals[u][1] += total[1]
            weight[u] -= weight[centre]
        stack += [p for p in (rest, *below.values()) if p]
    return totals


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of whole components, whose rows come one after the other, tops first."""

    def finished(rows: list[tuple]) -> pa.RecordBatch:
        place = {(r[0], r[1]): k for k, r in enumerate(rows)}
        parents = [-1, *(place[r[2], r[1] - 1] for r in rows[1:])]
        found = subtree_totals(parents, [r[5] for r in rows], [(r[6], r[7]) for r in rows])
        columns = [[r[0] for r in rows], [r[1] for r in rows]]
        columns += [[t[k] + r[8 + k] for t, r in zip(found, rows)] for k in (0, 1)]
        names = ["conv_id", "depth", "n_leaves", "saved_tokens"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][3:5] != row[3:5]:
                yield finished(held)
                held = []
            held.append(row)
    if held:
        yield finished(held)


def rolled_up(nodes: DataFrame, paths: DataFrame, part_nodes: int = PART_NODES) -> DataFrame:
    """conv_id, depth, n_leaves and saved_tokens of every node.

    ``paths`` has for every node's conv_id the nodes it passes: conv_id, depth, rep, parent.
    """
    zero = F.lit(0).cast("long")
    state = nodes.select(
        "conv_id", "depth", F.col("parent_conv_id").alias("parent"), zero.alias("top_conv"), zero.alias("top_depth"), "weight",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), "saved",
        zero.alias("more_leaves"), zero.alias("more_saved"),
    )
    columns = state.columns
    top = ["top_conv", "top_depth"]
    small, cut = [], []
    while True:
        comps = state.groupBy(*top).agg(F.count("*").alias("n"), F.max("weight").alias("total"))
        sized = stored(state.join(comps, top), "components")
        small.append(sized.where(F.col("n") <= part_nodes).select(columns))
        large = sized.where(F.col("n") > part_nodes)
        if large.isEmpty():
            break
        centres = large.where("2 * weight >= total").groupBy(*top).agg(
            F.max_by(F.struct("conv_id", "weight"), "depth").alias("c"), F.max("depth").alias("x_depth")
        )
        centres = centres.select(*top, "x_depth", F.col("c.conv_id").alias("x_conv"), F.col("c.weight").alias("x_weight"))
        deeper = F.col("depth") > F.col("x_depth")
        asked = large.select(columns).join(centres, top).withColumns(
            {
                "ask_conv": F.when(deeper, F.col("conv_id")).otherwise(F.col("x_conv")),
                "ask_depth": F.when(deeper, F.col("x_depth") + 1).otherwise(F.col("depth")),
            }
        )
        known = paths.select(
            F.col("conv_id").alias("ask_conv"), F.col("depth").alias("ask_depth"), "rep", F.col("parent").alias("rep_parent")
        )
        place = (
            F.when(deeper & (F.col("rep_parent") == F.col("x_conv")), "below")
            .when((F.col("depth") == F.col("x_depth")) & (F.col("conv_id") == F.col("x_conv")), "centre")
            .when((F.col("depth") < F.col("x_depth")) & ((F.col("depth") == 0) | (F.col("rep") == F.col("conv_id"))), "above")
            .otherwise("beside")
        )
        placed = asked.join(known, ["ask_conv", "ask_depth"], "left").withColumn("place", place)
        placed = stored(placed, "centroids")
        sums = placed.where(F.col("place").isin("below", "centre")).groupBy(*top).agg(
            F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved")
        )
        added = placed.join(sums, top)
        cut.append(
            added.where("place = 'centre'").select(
                "conv_id", "depth", F.expr("more_leaves + t_leaves").alias("n_leaves"),
                F.expr("more_saved + t_saved").alias("saved_tokens"),
            )
        )
        above, below = F.col("place") == "above", F.col("place") == "below"
        state = added.where("place <> 'centre'").withColumns(
            {
                "top_conv": F.when(below, F.col("rep")).otherwise(F.col("top_conv")),
                "top_depth": F.when(below, F.col("ask_depth")).otherwise(F.col("top_depth")),
                "weight": F.when(above, F.col("weight") - F.col("x_weight")).otherwise(F.col("weight")),
                "more_leaves": F.col("more_leaves") + F.when(above, F.col("t_leaves")).otherwise(0),
                "more_saved": F.col("more_saved") + F.when(above, F.col("t_saved")).otherwise(0),
            }
        ).select(columns)
    found = small[0]
    for part in small[1:]:
        found = found.unionByName(part)
    found = found.repartition(*top).sortWithinPartitions(*top, "depth", "conv_id").mapInArrow(_totals, TOTALS_DDL)
    for part in cut:
        found = found.unionByName(part)
    return found


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each node as comma-joined texts of a bounded length; rows come in order."""
    part, piece = TaskContext.get().partitionId(), 0
    node, held = None, []

    def written() -> pa.RecordBatch:
        columns = [[x] for x in (*node, part, piece, ",".join(held))]
        kinds = [pa.int64()] * 5 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "part", "piece", "members"]
        )

    for batch in batches:
        for *own, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (own != node or len(held) >= PIECE_MEMBERS):
                yield written()
                piece, held = piece + 1, []
            node = own
            held.append(str(conv))
    if held:
        yield written()


def _hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order; nothing but the state is kept."""
    node, state = None, None
    for batch in batches:
        nodes, digests = [], []
        for *own, members in zip(*(batch.column(c).to_pylist() for c in (*NODE, "members"))):
            if own == node:
                state.update(b",")
            else:
                if state:
                    nodes.append(node)
                    digests.append(state.hexdigest())
                node, state = own, hashlib.sha256()
            state.update(members.encode())
        yield _digests(nodes, digests)
    if state:
        yield _digests([node], [state.hexdigest()])


def _digests(nodes: list, digests: list[str]) -> pa.RecordBatch:
    columns = [pa.array([n[k] for n in nodes], pa.int64()) for k in range(3)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], [*NODE, "ends_sha256"])


def member_hashes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Per node where conversations end, the hash of their ids."""
    zero = F.lit(0).cast("long")
    ends = rows.where("depth = length").select(*NODE, "conv_id")
    ends = ends.unionByName(convs.where("length = 0").select(*[zero.alias(c) for c in NODE], "conv_id"))
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*NODE, "conv_id"]
    members = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_pieces, PIECE_DDL)
    members = members.repartition(*NODE).sortWithinPartitions(*NODE, "part", "piece")
    return members.mapInArrow(_hashes, HASH_DDL)


def conversation_trie(conversations: DataFrame, part_nodes: int = PART_NODES) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = stored(numbered_turns(conversations), "numbered-turns")
    convs, rows = rebuilt_turns(turns)
    rows = stored(beginnings(rows), "beginnings")
    nodes = trie_nodes(convs, rows)
    named = nodes.select("conv_id").distinct()
    paths = rows.select("conv_id", *NODE).join(named, "conv_id", "semi").join(
        nodes.select(*NODE, F.col("conv_id").alias("rep"), F.col("parent_conv_id").alias("parent")), NODE
    )
    paths = stored(paths.select("conv_id", "depth", "rep", "parent"), "paths")
    totals = rolled_up(nodes, paths, part_nodes)
    empty = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(totals, ["conv_id", "depth"])
        .join(member_hashes(convs, rows), NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )
