"""Toxicity scores: FTRL-proximal logistic regression over hashed word features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.llm.arrow_tasks import map_arrow
from landledger.llm.text_tables import ids_and_texts
from landledger.llm.word_hashes import ALNUM, document_words, ngrams

BITS = 20  # log2 of the number of weights
STEM_BYTES = 4
TRAIN_ROWS = 12_000
_RANKS = 10**9
EPOCHS = 8
# FTRL-proximal: per-coordinate rate ALPHA / (BETA + sqrt(sum of squared gradients)), L1 and L2 strength
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.0
_SALTS = [np.uint64(0x9E3779B97F4A7C15 * k % (1 << 64)) for k in (1, 3, 5, 7)]


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that lend no label: crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _slots(words: np.ndarray, stems: np.ndarray) -> np.ndarray:
    """Weight numbers of words, stems, word pairs and pairs with one word between them."""
    shift = np.uint64(64 - BITS)
    kinds = (words, stems, ngrams(words, 2), ngrams(words, 2, gap=2))
    return np.concatenate([((k * (s | np.uint64(1))) >> shift).astype(np.int32) for k, s in zip(kinds, _SALTS)])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            np.unique(_slots(words[a:b], stems[a:b])).tobytes()
            for _, offsets, words, stems in document_words(batch.column("text"), ALNUM, STEM_BYTES)
            for a, b in zip(offsets, offsets[1:])
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("rank"), batch.column("label"), pa.array(found, pa.binary())],
            names=["rank", "label", "slots"],
        )


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One FTRL model over the rows of the task, several passes in the order of ``rank``."""
    rows = [
        (rank, label, np.frombuffer(slots, np.int32))
        for batch in batches
        for rank, label, slots in zip(*(batch.column(c).to_pylist() for c in ("rank", "label", "slots")))
    ]
    if not rows:
        return
    rows.sort(key=lambda row: row[:2])
    z = np.zeros((1 << BITS) + 1)  # the last weight is the intercept
    n = np.zeros_like(z)
    size = 1 << BITS

    def weights(at):
        own = z[at]
        shrunk = np.sign(own) * np.maximum(np.abs(own) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for _, label, slots in rows:
            at = np.append(slots, size)
            w = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35.0, 35.0))) - label
            squares = n[at]
            z[at] += gradient - (np.sqrt(squares + gradient * gradient) - np.sqrt(squares)) / ALPHA * w
            n[at] = squares + gradient * gradient
    final = weights(np.arange(size + 1))
    kept = np.flatnonzero(final)
    kept = np.union1d(kept, [size])
    yield pa.RecordBatch.from_arrays(
        [pa.array(kept, pa.int32()), pa.array(final[kept], pa.float64())], names=["slot", "weight"]
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    train_rows: int = TRAIN_ROWS,
) -> tuple[np.ndarray, np.ndarray]:
    """Sparse weights (slot numbers, values) learnt from at most ``train_rows`` labelled rows.

    The rows are those with the smallest hashes of their ids among the distinct labelled
    rows outside the held-out quarter, each with one text: of documents that share an id the one
    with the smallest digest. FTRL is an online method, so the bounded
    sample is one task's work; L1 leaves a few hundred weights, which are small
    enough to broadcast. Rows with a null label or id lend nothing. Without any
    labelled row the weights are empty.
    """
    key = F.col(id_column).cast("long")
    eligible = (
        labels.select(key.alias("doc_id"), F.col(label_column).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
        .withColumn("rank", F.pmod(F.xxhash64("doc_id"), F.lit(_RANKS)))
    )
    # few more than needed are sorted, however many labels there are
    ids = eligible.agg(F.approx_count_distinct("doc_id", 0.02)).first()[0]
    near = min(1.0, 1.2 * train_rows / max(ids, 1)) * _RANKS
    chosen = eligible.filter(F.col("rank") < int(near)).distinct().orderBy("rank", "doc_id", "label").limit(train_rows)
    # the hint is safe: train_rows bounds this side
    rows = (
        ids_and_texts(docs, id_column, text_column)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "rank", "label")
        .agg(F.min_by("text", F.sha2(F.col("text").cast("binary"), 256)).alias("text"))
    )
    slots = map_arrow(rows.select("rank", "label", "text"), _features, "rank long, label int, slots binary")
    model = map_arrow(slots.repartition(1), _fit, "slot int, weight double").toPandas()
    return model["slot"].to_numpy(np.int32), model["weight"].to_numpy(np.float64)


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, np.ndarray],
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from ``threshold`` on) of every whole text.

    An empty or null text scores as the model's base rate. Every distinct feature
    of a text counts once. With an empty model every score is 0.0.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    size = 1 << BITS

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size + 1, np.float32)
        table[shared.value[0]] = shared.value[1]
        known = len(shared.value[0]) > 0
        for batch in batches:
            logits = np.full(batch.num_rows, float(table[size]))
            for row, offsets, words, stems in document_words(batch.column("text"), ALNUM, STEM_BYTES):
                logits[row : row + len(offsets) - 1] += _sums(words, stems, offsets, table)
            scores = 1.0 / (1.0 + np.exp(-np.clip(logits, -35.0, 35.0))) if known else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                    pa.array((scores >= threshold).astype(np.int32), pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = ids_and_texts(docs, id_column, text_column).select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return map_arrow(rows, scored, "doc_id long, held_out boolean, score double, predicted int")


def _sums(words: np.ndarray, stems: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the weights of the distinct features of each row of a slice."""
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    slots = _slots(words, stems)
    sizes = [len(words), len(words), max(0, len(words) - 1), max(0, len(words) - 2)]
    rows = np.concatenate([row_of[:k] for k in sizes])
    ends = np.concatenate([row_of[len(row_of) - k :] if k else row_of[:0] for k in sizes])
    hit = np.flatnonzero((table[slots] != 0) & (rows == ends))  # pairs across two texts do not count
    pairs = np.unique(rows[hit].astype(np.int64) << BITS | slots[hit])
    return np.bincount(pairs >> BITS, weights=table[pairs & (len(table) - 2)], minlength=len(offsets) - 1)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **columns: str) -> DataFrame:
    """Fit on the labelled rows outside the held-out quarter, then score every document."""
    own = {k: v for k, v in columns.items() if k in ("id_column", "text_column")}
    return score(docs, fit(docs, labels, **columns), threshold=threshold, **own)
