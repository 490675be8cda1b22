"""Resharding with the fewest moved bytes."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.llm.running import running_before
from landledger.storage import materialise

SHARDS, ROW_BYTES, ROUNDS = 24, 8, 3
OLD_SHARDS = 20
UNREACHED = 2**62


def transfers(
    sizes: Sequence[int], capacities: Sequence[int], cost: Callable[[int, int], int] | None = None
) -> list[tuple[int, int, int]]:
    """Cheapest flow (old shard, new shard, bytes) from old sizes to new capacities.

    ``cost`` gives what a byte costs from an old to a new shard, not below 0; by default staying costs nothing and every
    move 1, so the flow moves the fewest bytes. Old shards beyond the new count have no capacity, a closed shard has
    capacity 0, and new ones start empty. Sizes and capacities must have equal sums.

    Solved by successive shortest paths: bytes go along the cheapest path from a shard that has some left to
    one with free capacity, and a path may lead back over arcs that carry flow. The flow is the cheapest for
    what it carries after every step, and so at the end. Time grows with the shards, never with rows.
    """
    count = max(len(sizes), len(capacities))
    left = np.array([*sizes, *[0] * (count - len(sizes))], dtype=np.int64)
    free = np.array([*capacities, *[0] * (count - len(capacities))], dtype=np.int64)
    if left.sum() != free.sum():
        raise ValueError("sizes and capacities differ in sum")
    price = np.array([[cost(i, j) if cost else int(i != j) for j in range(count)] for i in range(count)], dtype=np.int64)
    if count and price.min() < 0:
        raise ValueError("costs must not be negative")
    flow = np.zeros((count, count), dtype=np.int64)
    while left.any():
        path, end = _cheapest_path(price, flow, left, free)
        start = path[0][0]
        amount = min([left[start], free[end], *(flow[old, new] for old, new, forward in path if not forward)])
        for old, new, forward in path:
            flow[old, new] += amount if forward else -amount
        left[start] -= amount
        free[end] -= amount
    return [(int(i), int(j), int(flow[i, j])) for i, j in zip(*np.nonzero(flow))]


def _cheapest_path(
    price: np.ndarray, flow: np.ndarray, left: np.ndarray, free: np.ndarray
) -> tuple[list[tuple[int, int, bool]], int]:
    """Arcs (old, new, forward) of a cheapest path to a shard with free capacity, and that shard."""
    count = len(left)
    at_old = np.where(left > 0, 0, UNREACHED)
    at_new = np.full(count, UNREACHED)
    came_new, came_old = np.full(count, -1), np.full(count, -1)
    everyone = np.arange(count)
    while True:
        over = np.where(at_old[:, None] < UNREACHED, at_old[:, None] + price, UNREACHED)
        best = over.argmin(axis=0)
        nearer = over[best, everyone] < at_new
        at_new, came_new = np.where(nearer, over[best, everyone], at_new), np.where(nearer, best, came_new)
        back = np.where((flow > 0) & (at_new < UNREACHED), at_new - price, UNREACHED)
        best = back.argmin(axis=1)
        nearer = back[everyone, best] < at_old
        if not nearer.any():
            break
        at_old, came_old = np.where(nearer, back[everyone, best], at_old), np.where(nearer, best, came_old)
    end = int(np.where(free > 0, at_new, UNREACHED).argmin())
    path, new = [], end
    while True:
        old = int(came_new[new])
        path.append((old, new, True))
        if came_old[old] < 0:
            return path[::-1], end
        new = int(came_old[old])
        path.append((old, new, False))


def _cuts(spark: SparkSession, flow: list[tuple[int, int, int]]) -> DataFrame:
    """The flow as byte intervals of the old shards: what stays first, then each transfer."""
    at: dict[int, int] = {}
    rows = []
    for old, new, amount in flow:
        low = at.get(old, 0)
        at[old] = low + amount
        rows.append((old, low, low + amount, new))
    return spark.createDataFrame(rows, "old int, low long, high long, target int")


def reshard(
    docs: DataFrame,
    old_shard: Column | None = None,
    shards: int = SHARDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
    cost: Callable[[int, int], int] | None = None,
    closed: Collection[int] = (),
) -> DataFrame:
    """Per document: doc_id, size, text_crc32, old_shard, shard, slot.

    size is the UTF-8 bytes of the text (0 for null) plus 8. ``old_shard`` says
    where a document lies now, by default in one of 20 shards by source. New shards
    get equal capacities in bytes, a byte apart at most; those in ``closed`` are emptied. ``transfers`` finds the block
    transfers that move the fewest bytes, or cost the least by ``cost``, from one row per shard. In an old shard the
    largest documents come first and stay, so that cuts fall between small ones; a document
    goes where its middle byte lies. As documents are not cut, shards miss their capacities
    by a part of a document; the next rounds do the same with what is left, a few small documents each.

    Positions come from running sums over digest buckets within size classes, so an old shard with
    a third of all rows is spread evenly. slot numbers the rows of a shard from 0 without gaps, in the
    order of a digest of id and text. Repeated rows are separate rows; a null id is allowed, and a null
    old shard counts as 0. With no rows the result is empty.
    """
    spark = docs.sparkSession
    opened = [i for i in range(shards) if i not in closed]
    if not opened:
        raise ValueError("every shard is closed")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    place = F.pmod(F.crc32(F.coalesce(F.col("source").cast("string"), F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
    size = F.octet_length(text).cast("long") + ROW_BYTES
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        size.alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce((place if old_shard is None else old_shard).cast("int"), F.lit(0)).alias("old_shard"),
    ).withColumn("shard", F.col("old_shard"))
    # the text is part of it: rows that share an id, or have none, are spread as others are
    rows = rows.withColumn("digest", F.md5(F.concat_ws("|", F.coalesce("doc_id", F.lit(-1)), "text_crc32", "size").cast("binary")))
    # size classes, the largest first: 16 for each doubling, then a part of the digest
    largest_first = F.lpad((1000 - F.floor(F.log2("size") * 16)).cast("string"), 4, "0")
    rows = rows.withColumn("bucket", F.concat(largest_first, F.substring("digest", 1, 2)))
    rows = materialise(rows, "reshard-rows")
    for _ in range(rounds):
        sizes = dict(rows.groupBy("shard").agg(F.sum("size")).collect())  # one row a shard
        total = sum(sizes.values())
        if not total:
            break
        capacities = [0] * shards
        for place, i in enumerate(opened):
            capacities[i] = total // len(opened) + (place < total % len(opened))
        flow = transfers([sizes.get(i, 0) for i in range(max([shards - 1, *sizes]) + 1)], capacities, cost)
        cuts = _cuts(spark, flow)
        placed = running_before(rows, ["shard"], "bucket", ["digest", "size", "text_crc32"], "size", "before")
        middle = F.col("before") + F.expr("size div 2")
        # the hint is safe: cuts has fewer rows than old and new shards together
        moved = placed.join(
            F.broadcast(cuts), (F.col("shard") == F.col("old")) & (middle >= F.col("low")) & (middle < F.col("high"))
        )
        rows = materialise(moved.select(*[c for c in rows.columns if c != "shard"], F.col("target").alias("shard")), "reshard-rows")
    numbered = running_before(
        rows.withColumn("one", F.lit(1).cast("long")).withColumn("part", F.substring("digest", 1, 3)),
        ["shard"], "part", ["digest", "size", "text_crc32"], "one", "slot",
    )
    return numbered.select("doc_id", "size", "text_crc32", "old_shard", "shard", "slot")


def rewrite_shards(docs: DataFrame, plan: DataFrame, folder: str, id_column: str = "doc_id") -> list[int]:
    """Write the shards whose rows change to ``folder``/shard=N and return their numbers.

    ``plan`` comes from ``reshard``; repeated or null ids raise, as rows are told by them. A shard that keeps exactly its rows is not
    read or written: its old files stay valid.
    """
    unclear = plan.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").head()
    if unclear is not None:
        raise ValueError(f"id {unclear['doc_id']} does not tell one row")
    moves = plan.filter("old_shard <> shard")
    changed = moves.select("shard").union(moves.select("old_shard")).distinct()
    numbers = sorted(r[0] for r in changed.collect())  # one row a shard
    wanted = plan.filter(F.col("shard").isin(numbers)).select(F.col("doc_id").alias("_id"), "shard", "slot")
    (
        docs.join(wanted, docs[id_column] == F.col("_id")).drop("_id")
        .repartition(F.col("shard"), F.expr("slot div 100000"))
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite").partitionBy("shard").parquet(folder)
    )
    return numbers
