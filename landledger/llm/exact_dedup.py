"""Exact duplicates by sorting contents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.llm.arrow_tasks import map_arrow
from landledger.llm.text_tables import ids_and_texts, shuffle_partitions
from landledger.storage import materialise

HEAD_BYTES = 64
RUNS = "doc_id long, digest binary, keep long, size long, first boolean, edge int, part int, edge_body binary"
FIRST, LAST = 1, 2


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    partitions: int | None = None,
) -> DataFrame:
    """One row per document with its group of equal texts.

    Result: doc_id, keep_id (largest doc_id of the group), group_size, kept,
    text_sha256 (of the normalised text in UTF-8).

    The contents are sorted across the cluster: sampled splitters cut them into
    ranges, each range is sorted externally, and neighbouring texts are compared
    in full. The order is that of the first 64 bytes, then of the digest of all
    bytes, then of the bytes themselves: it puts equal texts side by side and
    keeps a splitter at about a hundred bytes however long the texts are. The
    doc_id ends the range key, so a text with a third of all rows spreads over a
    third of the ranges. Runs that touch the edge of a range are stitched from two rows a range.

    A null text counts as empty. Equal texts and ids: exactly one row is kept. A
    null doc_id counts as the smallest. An empty table gives no rows; columns
    other than the two are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    body = F.encode(normalise(F.col("text")), "utf-8")
    keyed = ids_and_texts(docs, id_column, text_column).select("doc_id", body.alias("body")).select(
        "doc_id",
        "body",
        F.substring("body", 1, HEAD_BYTES).alias("head"),
        F.unhex(F.sha2("body", 256)).alias("digest"),
    )
    last_id_first = F.col("doc_id").desc_nulls_last()
    ordered = (
        keyed.repartitionByRange(partitions or shuffle_partitions(spark), "head", "digest", last_id_first)
        .sortWithinPartitions("head", "digest", "body", last_id_first)
        .select("doc_id", "digest", "body")
    )
    # written: both uses below must see the same ranges, also after a lost executor
    runs = materialise(map_arrow(ordered, _runs, RUNS), "exact-runs")
    group = Window.partitionBy("digest", "edge_body")
    stitched = (
        runs.filter("edge > 0 AND first")
        .select(
            "part",
            "digest",
            F.sum("size").over(group).alias("total"),
            F.max("keep").over(group).alias("top"),
            F.min("part").over(group).alias("lead"),
            F.count(F.lit(1)).over(group).alias("pieces"),
        )
        .filter("pieces > 1")
        .drop("pieces")
    )
    # the hint is safe: stitched has two rows a range at most
    return runs.join(F.broadcast(stitched), ["part", "digest"], "left").select(
        "doc_id",
        F.coalesce("top", "keep").alias("keep_id"),
        F.coalesce("total", "size").alias("group_size"),
        (F.col("first") & F.coalesce(F.col("lead") == F.col("part"), F.lit(True))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal texts of one sorted range; the last run of a batch stays open until the next."""
    part = TaskContext.get().partitionId()
    ids: list[pa.Array] = []
    digest = body = None
    edge = FIRST
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        own_ids, digests, bodies = (batch.column(c) for c in ("doc_id", "digest", "body"))
        new = np.ones(n, dtype=bool)
        new[1:] = ~pc.equal(bodies.slice(1), bodies.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = body is None or bodies[0].as_py() != body
        starts = np.flatnonzero(new)
        before = int(starts[0]) if len(starts) else n
        if before:
            ids.append(own_ids.slice(0, before))
        if not len(starts):
            continue
        if ids:
            yield _one_run(ids, digest, body, edge, part)
            edge = 0
        if edge and len(starts) > 1:  # the first run of the range begins and ends in this batch
            yield _one_run([own_ids.slice(0, int(starts[1]))], digests[0].as_py(), bodies[0].as_py(), edge, part)
            starts, edge = starts[1:], 0
        last = int(starts[-1])
        if last > starts[0]:
            yield _inner_runs(own_ids, digests, starts, part)
        ids, digest, body = [own_ids.slice(last)], digests[last].as_py(), bodies[last].as_py()
    if ids:
        yield _one_run(ids, digest, body, edge | LAST, part)


def _batch(ids, digests, keep, size, first, edge, part, bodies) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [
            ids, digests, keep, pa.array(size, pa.int64()), pa.array(first, pa.bool_()),
            pa.array(np.full(n, edge), pa.int32()), pa.array(np.full(n, part), pa.int32()), bodies,
        ],
        names=["doc_id", "digest", "keep", "size", "first", "edge", "part", "edge_body"],
    )


def _one_run(ids, digest, body, edge, part) -> pa.RecordBatch:
    ids = pa.concat_arrays(ids)
    n = len(ids)
    first = np.zeros(n, dtype=bool)
    first[0] = True
    bodies = pa.concat_arrays([pa.array([body if edge else None], pa.binary()), pa.nulls(n - 1, pa.binary())])
    keep = ids.take(pa.array(np.zeros(n, np.int64)))
    return _batch(ids, pa.array([digest] * n, pa.binary()), keep, np.full(n, n), first, edge, part, bodies)


def _inner_runs(ids, digests, starts, part) -> pa.RecordBatch:
    begin, end = int(starts[0]), int(starts[-1])
    sizes = np.diff(starts)
    heads = np.repeat(starts[:-1], sizes)
    first = np.zeros(end - begin, dtype=bool)
    first[starts[:-1] - begin] = True
    return _batch(
        ids.slice(begin, end - begin), digests.slice(begin, end - begin), ids.take(pa.array(heads)),
        np.repeat(sizes, sizes), first, 0, part, pa.nulls(end - begin, pa.binary()),
    )
