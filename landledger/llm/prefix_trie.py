"""The trie of turn prefixes of conversations, built by adaptive radix trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.llm.arrow_tasks import map_arrow
from landledger.llm.radix_tree import build
from landledger.llm.text_tables import shuffle_partitions
from landledger.llm.word_hashes import mix
from landledger.storage import materialise

TURN_BYTES = 16  # of a turn id: the first half of its SHA-256, big-endian
SEGMENT_TURNS = 64  # turns of a key; longer conversations have several keys
BLOCK_SEGMENTS = 256
CHUNK_KEYS = 20_000  # keys of one tree
DIGEST_BYTES = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
_NODES = (
    "f1 long, f2 long, p1 long, p2 long, depth long, turn_id binary, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, edge boolean, parent_edge boolean, leaf boolean, "
    "inner_root boolean, path array<long>"
)


def place_turns(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """conv_id, pos, turn_id, words of every turn; pos counts a conversation's turns from 0, ``words`` those of its text.

    Turns are ordered by turn (nulls first), role and turn id; a null role or text counts as empty; repeated rows are
    separate turns; a null conv_id names no conversation and is left out. Other columns are not read.
    A turn id is the first 16 bytes of the SHA-256 of role and text: equal turns have equal ids, and others
    do not but with a chance of 2**-128 a pair.

    Rows are range-partitioned by the whole order, so a conversation with a third of all turns is spread evenly; only
    ids and word counts are shuffled. A range adds one offset at most, that of the conversation it begins in.
    """
    spark = turns.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    rows = (
        turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role").alias("role"), text("text").alias("text"))
        .filter("conv_id IS NOT NULL")
        .select(
            "conv_id", "turn", "role",
            F.substring(F.unhex(F.sha2(named, 256)), 1, TURN_BYTES).alias("turn_id"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        )
    )
    order = ["conv_id", "turn", "role", "turn_id"]
    ordered = rows.repartitionByRange(partitions or shuffle_partitions(spark), *order).sortWithinPartitions(*order)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            convs = batch.column("conv_id").to_numpy()
            if not len(convs):
                continue
            first = np.flatnonzero(np.concatenate([[True], convs[1:] != convs[:-1]]))
            local = np.arange(len(convs)) - np.repeat(first, np.diff(np.append(first, len(convs))))
            if convs[0] == conv:
                local[: first[1] if len(first) > 1 else len(convs)] += seen
            conv, seen = convs[-1], int(local[-1]) + 1
            columns = [batch.column("conv_id"), pa.array(np.full(len(convs), part), pa.int32()), pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("turn_id"), batch.column("words")], names=["conv_id", "part", "local", "turn_id", "words"]
            )

    # written: offsets and rows must see the same ranges, also after a lost executor
    stored = materialise(map_arrow(ordered, numbered, "conv_id long, part int, local long, turn_id binary, words long"), "trie-turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
        .select("conv_id", "part", F.sum("n").over(earlier).alias("before")).filter("before IS NOT NULL")
    )
    # the hint is safe: only the first conversation of a range has turns before it
    return stored.join(F.broadcast(offsets), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "turn_id", "words"
    )


def share_openings(placed: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as one of ``every`` does: rows like ``placed``, and the conv_ids, turnless ones too.

    Conversation c gets the first h = crc32(c) % ``most`` turns of conversation c - c % ``every`` (all if it has fewer, none
    if it is absent) in place of its own first h turns.
    """
    convs = placed.select("conv_id").distinct().select(
        "conv_id",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
    )
    heads = (
        placed.filter((F.col("conv_id") % every == 0) & (F.col("pos") < most - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.collect_list(F.struct("pos", "turn_id", "words")).alias("head"))
    )
    opened = materialise(
        convs.join(heads, "base", "left").select(
            "conv_id", "h", F.filter(F.coalesce("head", F.array()), lambda t: t["pos"] < F.col("h")).alias("head")
        ),
        "trie-openings",
    )
    own = placed.join(opened.select("conv_id", "h", F.size("head").alias("taken")), "conv_id").filter("pos >= h")
    return (
        opened.select("conv_id", F.inline("head")).union(
            own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_id", "words")
        ),
        opened.select("conv_id"),
    )


def prefix_trie(
    placed: DataFrame,
    conversations: DataFrame,
    partitions: int | None = None,
    segment_turns: int = SEGMENT_TURNS,
    chunk_keys: int = CHUNK_KEYS,
) -> DataFrame:
    """Nodes of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, turn_id.

    ``placed`` has the turns as ``place_turns`` gives them, ``conversations`` the distinct conv_ids, also those without
    turns. A node is a distinct sequence of first turns, its members the conversations that begin with it; conv_id is
    the smallest member and, with depth, names the node; turn_id is that of its last turn. See ``op11_prefix_trie``
    for the other columns. An empty table has no node, else there is a root of depth 0.

    A key holds the turn ids of up to ``segment_turns`` turns; a longer conversation has a key for every segment, in the tree of
    what stands before it, told by a fingerprint of 128 bits. Equal keys become one row with partial
    aggregation, so a very common conversation is one row. Keys are range-partitioned and sorted; every task builds adaptive
    radix trees over ``chunk_keys`` keys and gives the nodes at turn-aligned depths.
    A node that two trees share lies on the first or last path of both: these few are merged, with
    corrections for what both counted. What later segments hold is added along the path of the conversation that owns them.
    So no task needs a whole conversation, nor a whole trie.
    """
    spark = placed.sparkSession
    partitions = partitions or shuffle_partitions(spark)
    keys = materialise(_segments(placed, conversations, segment_turns), "trie-segments")
    grouped = keys.groupBy("c1", "c2", "segment", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"),
        F.max(F.col("segment") < F.col("last_segment")).alias("more"), F.first("words").alias("words"),
    )
    ordered = grouped.repartitionByRange(partitions, "c1", "c2", "key").sortWithinPartitions("c1", "c2", "key")
    found = materialise(map_arrow(ordered, partial(_trees, segment_turns, chunk_keys), _NODES), "trie-nodes")
    # the root of a later segment's tree has the fingerprint of the node that ends the segment before it
    found = found.withColumn("parent_is_root", F.expr(f"NOT inner_root AND depth > {segment_turns} AND (depth - 1) % {segment_turns} = 0"))
    merged = materialise(_merge_edges(found.filter("edge")), "trie-edges")
    above = merged.select(
        F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("inner_root").alias("parent_is_root"), F.col("conv_id").alias("above")
    )
    parent = ["p1", "p2", "parent_is_root"]
    inner = (
        found.filter("NOT edge")
        .join(above, parent, "left")
        .withColumn("parent_conv_id", F.when(F.col("parent_edge"), F.col("above")).otherwise(F.col("parent_conv_id")))
    )
    columns = [
        "f1", "f2", "p1", "p2", "parent_is_root", "depth", "turn_id", "conv_id", "parent_conv_id",
        "n_convs", "n_children", "n_leaves", "saved_tokens", "inner_root",
    ]
    # whatever lies above an edge node is an edge node; the depth tells those without a parent
    edges = merged.join(above, parent, "left").withColumn("parent_conv_id", F.col("above"))
    nodes = inner.select(*columns).union(edges.select(*columns))
    # the parent of a later segment's first nodes may have members that end with it and are not in that segment
    parents = nodes.filter(f"depth > 0 AND depth % {segment_turns} = 0 AND NOT inner_root").select(
        F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("above")
    )
    firsts = nodes.filter("parent_is_root").join(parents, ["p1", "p2"]).withColumn("parent_conv_id", F.col("above"))
    nodes = nodes.filter("NOT parent_is_root").union(firsts.select(*columns))
    later = _from_later_segments(keys, nodes.filter("inner_root"), segment_turns)
    ends = _end_digests(
        keys.filter("segment = last_segment").select(
            "conv_id", F.col("c1").bitwiseXOR(F.col("x1")).alias("f1"), F.col("c2").bitwiseXOR(F.col("x2")).alias("f2")
        ),
        partitions,
    )
    plus = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
    return (
        nodes.filter("NOT inner_root")
        .join(later, ["f1", "f2"], "left")
        .join(ends, ["f1", "f2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", plus("n_children"), plus("n_leaves"), plus("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "turn_id",
        )
    )


def _segments(placed: DataFrame, conversations: DataFrame, segment_turns: int) -> DataFrame:
    """conv_id, segment, last_segment, key, words, fingerprint of the segment (x1, x2) and of all before it (c1, c2)."""
    marks = conversations.select("conv_id", *[F.lit(None).cast(t).alias(c) for c, t in (("pos", "long"), ("turn_id", "binary"), ("words", "long"))])
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "turn_id", "words"))
    rows = (
        placed.select("conv_id", "pos", "turn_id", "words").union(marks)
        .groupBy("conv_id", F.expr(f"coalesce(pos div {segment_turns}, 0)").alias("segment"))
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    )
    own = map_arrow(rows, partial(_fingerprints, segment_turns), "conv_id long, segment long, key binary, words array<long>, x1 long, x2 long")
    own = own.withColumn("block", F.expr(f"segment div {BLOCK_SEGMENTS}"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda c, over: F.coalesce(F.bit_xor(c).over(over), F.lit(0).cast("long"))
    blocks = (
        own.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.max("segment").alias("last"))
        .select(
            "conv_id", "block", F.max("last").over(whole).alias("last_segment"),
            xor("b1", before).alias("b1"), xor("b2", before).alias("b2"),
        )
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return own.join(blocks, ["conv_id", "block"]).select(
        "conv_id", "segment", "last_segment", "key", "words", "x1", "x2",
        F.col("b1").bitwiseXOR(xor("x1", inside)).alias("c1"), F.col("b2").bitwiseXOR(xor("x2", inside)).alias("c2"),
    )


def _turn_prints(ids: bytes, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two random 64-bit numbers for each turn id and position; a prefix's fingerprint is the XOR of those of its turns."""
    halves = np.frombuffer(ids, ">u8").astype(np.uint64).reshape(-1, 2)
    at = positions.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    high, low = halves[:, 0], halves[:, 1]
    return mix(high ^ mix(at + low)), mix(low ^ mix(at ^ mix(high + np.uint64(0x632BE59BD9B4E019))))


def _prefix_prints(keys: list[bytes], first_turn: np.ndarray, contexts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets of the keys' turns, and the two fingerprints of every prefix of every key, its context included."""
    sizes = np.array([len(key) // TURN_BYTES for key in keys], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    positions = np.arange(offsets[-1]) + np.repeat(first_turn - offsets[:-1], sizes)
    out = []
    for prints, context in zip(_turn_prints(b"".join(keys), positions), contexts):
        run = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(prints)]) if len(prints) else np.zeros(1, np.uint64)
        out.append(run[1:] ^ np.repeat(run[offsets[:-1]] ^ context, sizes))
    return offsets, out


def _fingerprints(segment_turns: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = batch.column("turns").to_pylist()
        keys = [b"".join(t["turn_id"] for t in own) for own in turns]
        first = batch.column("segment").to_numpy() * segment_turns
        none = np.zeros(len(keys), np.uint64)
        offsets, prints = _prefix_prints(keys, first, [none, none])
        last = np.maximum(offsets[1:] - 1, 0)
        some = offsets[1:] > offsets[:-1]
        totals = [np.where(some, p[last], 0).astype(np.uint64) if len(p) else none for p in prints]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"), batch.column("segment"), pa.array(keys, pa.binary()),
                pa.array([[t["words"] for t in own] for own in turns], pa.list_(pa.int64())),
                *[pa.array(t.view(np.int64)) for t in totals],
            ],
            names=["conv_id", "segment", "key", "words", "x1", "x2"],
        )


def _trees(segment_turns: int, chunk_keys: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the sorted keys of a task, a tree for each context and ``chunk_keys`` keys of it."""
    waiting, context = [], None
    open_left = True  # keys of this context may lie before those that wait, in another tree
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("c1", "c2", "segment", "key", "n", "conv_id", "more", "words"))
        for c1, c2, *row in zip(*columns):
            if (c1, c2) != context or len(waiting) == chunk_keys:
                same = (c1, c2) == context
                if waiting:
                    yield _tree_nodes(context, waiting, segment_turns, open_left, same)
                    open_left = same
                waiting, context = [], (c1, c2)
            waiting.append(row)
    if waiting:
        yield _tree_nodes(context, waiting, segment_turns, open_left, True)


def _tree_nodes(
    context: tuple[int, int], rows: list[list], segment_turns: int, open_left: bool, open_right: bool
) -> pa.RecordBatch:
    """The trie nodes of one tree; those on its first or last path are edges where the context goes on outside of it."""
    segments, keys, counts, convs, more, words = zip(*rows)
    first_turn = segments[0] * segment_turns
    base = np.array(context, np.int64).view(np.uint64)
    starts = np.full(len(keys), first_turn)
    offsets, prints = _prefix_prints(list(keys), starts, [np.full(len(keys), b) for b in base])
    prints = [p.view(np.int64).tolist() for p in prints]
    last = len(keys) - 1

    def fingerprint(row: int, depth: int) -> tuple[int, int]:
        if not depth:
            return context
        at = int(offsets[row]) + depth - 1
        return prints[0][at], prints[1][at]

    out: list[list] = []
    # children are done before their parent: (members, smallest, leaves, saved, low row, high row, topmost trie nodes)
    done: list[tuple] = []
    stack = [(build(list(keys)), 0, False)]
    while stack:
        node, entry, ready = stack.pop()
        end = entry + len(node.prefix)
        below = node.children()
        if not ready:
            stack.append((node, entry, True))
            stack.extend((child, end + 1, False) for child in reversed(below))
            continue
        n, smallest, leaves, saved, low, high, tops = 0, None, 0, 0, None, None, []
        if below:
            for part in done[-len(below) :]:
                n, leaves, saved = n + part[0], leaves + part[2], saved + part[3]
                smallest = part[1] if smallest is None else min(smallest, part[1])
                low = part[4] if low is None else low
                high = part[5]
                tops += part[6]
            del done[-len(below) :]
        leaf = False
        if node.value is not None:
            row = node.value
            n += counts[row]
            smallest = convs[row] if smallest is None else min(smallest, convs[row])
            low = row
            high = row if high is None else high
            leaf = not below and not more[row]
            leaves += leaf
        # turn-aligned depths within the compressed path, the deepest first
        for depth in range(end // TURN_BYTES, (entry - 1) // TURN_BYTES, -1):
            own_words = words[low][depth - 1] if depth else 0
            saved += (n - 1) * own_words
            edge = open_left and low == 0 or open_right and high == last
            for child in tops:
                child[7], child[14] = smallest, edge
            path = [f for d in range(depth + 1) for f in fingerprint(low, d)] if edge else None
            turn_id = keys[low][(depth - 1) * TURN_BYTES : depth * TURN_BYTES] if depth else None
            out.append([
                *fingerprint(low, depth), *(fingerprint(low, depth - 1) if depth else (None, None)), first_turn + depth, turn_id,
                smallest, None, n, len(tops), leaves, saved, own_words, edge, False, leaf, depth == 0 and first_turn > 0, path,
            ])
            tops, leaf = [out[-1]], False
        done.append((n, smallest, leaves, saved, low, high, tops))
    kinds = [
        *[pa.int64()] * 5, pa.binary(), *[pa.int64()] * 7, *[pa.bool_()] * 4, pa.list_(pa.int64()),
    ]
    names = [field.split(" ")[0] for field in _NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _merge_edges(edges: DataFrame) -> DataFrame:
    """One row for each node that several trees may have, put right for what they all counted.

    A node in m trees has its own words saved m - 1 times too little, and so have all nodes above it; its parent
    counts it m times; where one tree ends in it and another goes on, it was counted as a leaf.
    """
    node = ["f1", "f2", "inner_root"]
    summed = edges.groupBy(*node).agg(
        *[F.first(c).alias(c) for c in ("p1", "p2", "parent_is_root", "depth", "turn_id", "words", "path")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.count(F.lit(1)).alias("trees"), F.count_if("leaf").alias("ends"),
    )
    summed = materialise(summed, "trie-edge-sums")
    shared = summed.filter("trees > 1")
    wrong_leaves = F.when(F.col("n_children") > 0, F.col("ends")).otherwise(0)
    up = shared.select(
        ((F.col("trees") - 1) * F.col("words")).alias("add_saved"), wrong_leaves.alias("less_leaves"),
        F.explode(F.expr(
            "transform(sequence(0, size(path) - 2, 2), i -> struct(path[i] AS f1, path[i + 1] AS f2, "
            "i = 0 AND depth + 1 > size(path) div 2 AS inner_root))"
        )).alias("f"),
    ).groupBy("f.f1", "f.f2", "f.inner_root").agg(F.sum("add_saved").alias("add_saved"), F.sum("less_leaves").alias("less_leaves"))
    twice = (
        shared.filter("p1 IS NOT NULL")
        .groupBy(F.col("p1").alias("f1"), F.col("p2").alias("f2"), F.col("parent_is_root").alias("inner_root"))
        .agg(F.sum(F.col("trees") - 1).alias("less_children"))
    )
    fixed = lambda c, by: (F.col(c) + F.coalesce(by, F.lit(0))).alias(c)
    return summed.join(up, node, "left").join(twice, node, "left").select(
        *node, "p1", "p2", "parent_is_root", "depth", "turn_id", "conv_id", "n_convs",
        fixed("n_children", -F.col("less_children")), fixed("n_leaves", -F.col("less_leaves")), fixed("saved_tokens", F.col("add_saved")),
    )


def _from_later_segments(keys: DataFrame, roots: DataFrame, segment_turns: int) -> DataFrame:
    """f1, f2 and what a node has in segments after its own: more_n_children, more_n_leaves, more_saved_tokens.

    A tree of a later segment belongs to the smallest of its conversations. All nodes on that one's way to it get
    its leaves and savings, the last of them its children too.
    """
    owned = roots.select(
        "conv_id", F.expr(f"depth div {segment_turns}").alias("segment"), F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s")
    ).withColumn("block", F.expr(f"segment div {BLOCK_SEGMENTS}"))
    # sums over the later segments of a conversation: those of its later blocks, and those of its own block
    whole = Window.partitionBy("conv_id")
    blocks = owned.groupBy("conv_id", "block").agg(F.sum("l").alias("l"), F.sum("s").alias("s")).select(
        "conv_id", F.col("block").alias("top"), "l", "s"
    )
    total = lambda c, over: F.coalesce(F.sum(c).over(over), F.lit(0))
    after = whole.orderBy("top").rowsBetween(1, Window.unboundedFollowing)
    far = blocks.select("conv_id", "top", total("l", after).alias("far_l"), total("s", after).alias("far_s"), "l", "s")
    owners = far.groupBy("conv_id").agg(F.sum("l").alias("all_l"), F.sum("s").alias("all_s"))
    own_keys = keys.select("conv_id", "segment", "key", "c1", "c2").withColumn("block", F.expr(f"segment div {BLOCK_SEGMENTS}")).join(
        owners, "conv_id"
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("segment").rowsBetween(1, Window.unboundedFollowing)
    near = (
        own_keys.join(owned.select("conv_id", "segment", "l", "s"), ["conv_id", "segment"], "left")
        .withColumn("near_l", total("l", inside)).withColumn("near_s", total("s", inside)).drop("l", "s")
    )
    # blocks without a tree of their own lie before the first block that has one: all is after them
    summed = near.join(far.select("conv_id", F.col("top").alias("block"), "far_l", "far_s"), ["conv_id", "block"], "left").select(
        "segment", "key", "c1", "c2",
        (F.col("near_l") + F.coalesce("far_l", "all_l")).alias("l"), (F.col("near_s") + F.coalesce("far_s", "all_s")).alias("s"),
    ).filter("l > 0 OR s > 0")

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("key").to_pylist()
            segments = batch.column("segment").to_numpy()
            base = [batch.column(c).to_numpy().view(np.uint64) for c in ("c1", "c2")]
            offsets, prints = _prefix_prints(rows, segments * segment_turns, base)
            sizes = np.diff(offsets)
            start = segments == 0  # the root lies on every way
            out = [np.concatenate([p, b[start]]).view(np.int64) for p, b in zip(prints, base)]
            out += [np.concatenate([np.repeat(a, sizes), a[start]]) for a in (batch.column(c).to_numpy() for c in ("l", "s"))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["f1", "f2", "l", "s"])

    zero = F.lit(0).cast("long").alias("n")
    ways = map_arrow(summed, along, "f1 long, f2 long, l long, s long").select("f1", "f2", "l", "s", zero)
    tops = roots.select("f1", "f2", F.lit(0).cast("long"), F.lit(0).cast("long"), "n_children")
    return ways.union(tops).groupBy("f1", "f2").agg(
        F.sum("l").alias("more_n_leaves"), F.sum("s").alias("more_saved_tokens"), F.sum("n").alias("more_n_children")
    )


def _end_digests(ends: DataFrame, partitions: int) -> DataFrame:
    """f1, f2, ends_sha256: digest of the sorted, comma-joined decimal conv_ids that end in a node.

    Ids are sorted across the cluster and joined to strings of up to ``DIGEST_BYTES`` where they lie; a digest takes its
    bytes in order, so the strings of a node pass through one task, one at a time.
    """
    order = ["f1", "f2", "conv_id"]
    ordered = ends.repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids, size, out = None, [], 0, []
        for batch in batches:
            for f1, f2, conv in zip(*(batch.column(c).to_pylist() for c in order)):
                if own != (f1, f2) or size >= DIGEST_BYTES:
                    if ids:
                        out.append((*own, ids[0], ",".join(map(str, ids))))
                    own, ids, size = (f1, f2), [], 0
                ids.append(conv)
                size += 12
            if out:
                yield _strings(out)
                out = []
        if ids:
            yield _strings([(*own, ids[0], ",".join(map(str, ids)))])

    strings = map_arrow(ordered, joined, "f1 long, f2 long, first long, ids string")
    by_node = strings.repartition("f1", "f2").sortWithinPartitions("f1", "f2", "first")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, out = None, None, []
        for batch in batches:
            for f1, f2, ids in zip(*(batch.column(c).to_pylist() for c in ("f1", "f2", "ids"))):
                if own == (f1, f2):
                    state.update(b",")
                else:
                    if state:
                        out.append((*own, state.hexdigest()))
                    own, state = (f1, f2), hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield _digests(out)
                out = []
        if state:
            yield _digests([(*own, state.hexdigest())])

    return map_arrow(by_node, digested, "f1 long, f2 long, ends_sha256 string")


def _strings(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["f1", "f2", "first", "ids"])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["f1", "f2", "ends_sha256"])
