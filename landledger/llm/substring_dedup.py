"""Passages repeated across documents by content-defined chunking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.llm.arrow_tasks import map_arrow
from landledger.llm.text_tables import ids_and_texts
from landledger.llm.word_hashes import BLOCK, NOT_SPACE, buffers, byte_sums, span_hashes
from landledger.storage import materialise

GEAR_WINDOW = 8  # bytes that decide about a cut
CUT_ONE_IN = 12  # share of places that may be cuts
LEAST_BYTES, MOST_BYTES = 8, 4096
RUN_WORDS = 24
RUN_BYTES = 150  # what 24 words take
_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)
_CUT_BELOW = np.uint32(2**32 // CUT_ONE_IN)
_CONTEXT = GEAR_WINDOW + LEAST_BYTES + 1


def cuts(data: np.ndarray, row_starts: np.ndarray) -> np.ndarray:
    """Ends of chunks in some bytes, besides the ends of rows.

    The gear hash of a place sums the table values of the last 8 bytes, each
    shifted by its distance; a place is a candidate where the sum is small, and a
    cut if no other candidate lies in the 8 bytes before. Both depend on a few
    bytes before the place only, so equal passages are cut alike wherever they stand.
    """
    sums = _GEAR[data]
    step = 1
    while step < GEAR_WINDOW:
        shifted = np.zeros_like(sums)
        shifted[step:] = sums[:-step] << np.uint32(step)
        sums = sums + shifted
        step *= 2
    found = np.flatnonzero(sums < _CUT_BELOW) + 1
    begin = row_starts[np.searchsorted(row_starts, found - 1, "right") - 1]
    found = found[found - begin >= GEAR_WINDOW]  # the window lies in one row
    begin = row_starts[np.searchsorted(row_starts, found - 1, "right") - 1]
    before = np.empty_like(found)
    before[:1] = -_CONTEXT
    before[1:] = found[:-1]
    return found[(found - np.maximum(before, begin - LEAST_BYTES) > LEAST_BYTES)]


def _edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted chunk edges of some rows of bytes: row offsets, cuts and, in chunks without one, forced cuts."""
    found = []
    for begin in range(0, max(len(data), 1), BLOCK):
        low = max(0, begin - _CONTEXT)
        at = cuts(data[low : begin + BLOCK], np.unique(np.append(0, offsets[(offsets > low)] - low))) + low
        found.append(at[(at > begin) & (at < len(data))])
    edges = np.unique(np.concatenate([offsets, *found]))
    gaps = np.diff(edges)
    if len(gaps) and gaps.max() > MOST_BYTES:
        forced = [np.arange(a + MOST_BYTES, b, MOST_BYTES) for a, b in zip(edges, edges[1:]) if b - a > MOST_BYTES]
        edges = np.unique(np.concatenate([edges, *forced]))
    return edges


def _hashes(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """64-bit digests of the chunks between the edges, a block of chunks at a time."""
    parts, at = [np.empty(0, np.uint64)], 0
    while at < len(edges) - 1:
        stop = max(at + 1, int(np.searchsorted(edges, edges[at] + BLOCK, "right")) - 1)
        low = edges[at]
        own = edges[at : stop + 1] - low
        parts.append(span_hashes(byte_sums(data[low : edges[stop]]), own[:-1], own[1:]))
        at = stop
    return np.concatenate(parts)


def _words_before(data: np.ndarray, row_starts: np.ndarray) -> np.ndarray:
    """Number of words that begin before each byte."""
    inside = NOT_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = row_starts[row_starts < len(data)]
    first[at] = inside[at]
    return np.append(0, np.cumsum(first))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row the ends, digests and word counts of its chunks."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
            low = int(offsets[row])
            own, at = data[low : int(offsets[stop])], offsets[row : stop + 1] - low
            edges = _edges(own, at)
            words = np.diff(_words_before(own, at)[edges])
            lists = np.searchsorted(edges, at)  # chunk number at which each row begins
            rows = np.repeat(at[:-1], np.diff(lists))
            to_list = lambda values, kind: pa.ListArray.from_arrays(
                pa.array(lists, pa.int32()), pa.array(values, kind)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, stop - row),
                    to_list(edges[1:] - rows, pa.int32()),
                    to_list(_hashes(own, edges).view(np.int64), pa.int64()),
                    to_list(words, pa.int32()),
                ],
                names=["doc_id", "ends", "digests", "words"],
            )
            row = stop


def repeated_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    run_words: int = RUN_WORDS,
    run_bytes: int = RUN_BYTES,
) -> DataFrame:
    """Passages that stand in two documents or more.

    Result, one row per passage and document: doc_id, start and end (bytes of the
    UTF-8 text), n_words, n_chunks, first_doc_id (smallest document that holds a part of
    it) and kept (every part has its first document here; elsewhere the passage is a repeat).
    A run of which some chunks have their first document here and some elsewhere gives a passage
    for each such piece, however short.

    Texts are cut where a rolling hash of their last 8 bytes says so, into chunks
    of about 24 bytes; chunks are compared by digest. Consecutive chunks that each stand
    in another document too form a passage if they hold ``run_words`` words or ``run_bytes`` bytes,
    which counts where a script or data has no spaces. The first and last words of a repeated passage lie in chunks that reach beyond it, so a
    repeat of fifty words shows as a run of about forty: the default finds those and
    leaves repeated single lines alone.

    Digests are counted by partial aggregation and the repeated ones joined back, a join
    that adaptive execution splits where a passage stands in a large share of the rows.
    Repeats inside one document do not count. A null or empty text has no chunks; rows that share a
    doc_id are one document, so their copies of each other do not count. A row without a doc_id
    is left out. An empty table gives no rows.
    """
    schema = "doc_id long, ends array<int>, digests array<long>, words array<int>"
    # cut anew for each use: cheaper than to store a row for every chunk
    cut = map_arrow(ids_and_texts(docs, id_column, text_column).filter("doc_id IS NOT NULL"), chunks, schema)
    counted = cut.select("doc_id", F.explode("digests").alias("digest")).groupBy("digest").agg(
        F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last")
    )
    # stored, so that the join below reads both sides through exchanges and can split hot digests
    repeated = materialise(counted.filter("first_doc_id < last").select("digest", "first_doc_id"), "repeated-chunks")
    starts = F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.size("ends") - 1))
    chunk = F.arrays_zip(
        starts.alias("start"), F.col("ends").alias("end"), F.col("digests").alias("digest"), F.col("words").alias("n_words")
    )
    places = (
        cut.filter(F.size("ends") > 0)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", F.inline(chunk))
        .join(repeated, "digest")
        .drop("digest")
    )
    along = Window.partitionBy("row").orderBy("start")
    own = F.col("first_doc_id") == F.col("doc_id")
    apart = F.coalesce(F.lag("end").over(along) != F.col("start"), F.lit(True))
    pieces = (
        places.withColumn("own", own)
        .withColumn("new", apart.cast("int"))
        .withColumn("turns", (apart | (F.lag("own").over(along) != F.col("own"))).cast("int"))
        .withColumn("run", F.sum("new").over(along))
        .withColumn("piece", F.sum("turns").over(along))
        .groupBy("row", "run", "piece")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("start").cast("long").alias("start"),
            F.max("end").cast("long").alias("end"),
            F.sum("n_words").alias("n_words"),
            F.count(F.lit(1)).alias("n_chunks"),
            F.min("first_doc_id").alias("first_doc_id"),
            F.first("own").alias("kept"),
        )
    )
    # the whole run is judged, so that its pieces are not lost for being short
    whole = Window.partitionBy("row", "run")
    return (
        pieces.withColumn("run_words", F.sum("n_words").over(whole))
        .withColumn("run_bytes", F.sum(F.col("end") - F.col("start")).over(whole))
        .filter((F.col("run_words") >= run_words) | (F.col("run_bytes") >= run_bytes))
        .select("doc_id", "start", "end", "n_words", "n_chunks", "first_doc_id", "kept")
    )
