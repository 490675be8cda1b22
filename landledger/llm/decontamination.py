"""Benchmark passages in documents: a broadcast set of word windows, in built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.llm.text_tables import alnum_words, with_row_key
from landledger.llm.word_windows import matches, window_hash, window_text, word_codes
from landledger.storage import materialise

WINDOW_WORDS = 10
MOST_BROADCAST = 500_000  # windows with their items, about 100 bytes each


def benchmark_windows(
    benchmark: DataFrame, words: int = WINDOW_WORDS, id_column: str = "item_id", text_column: str = "text"
) -> DataFrame:
    """Distinct windows of the items: hash, window, n, items (sorted ids as text).

    An item of fewer words, but not none, is one window. A null id marks words
    but is not listed; a null text has no words.
    """
    items = benchmark.select(
        F.col(id_column).cast("string").alias("item"),
        F.explode(F.array(alnum_words(F.col(text_column).cast("string")))).alias("words"),
    ).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (words - 1), F.lit(1)))
    rolled = items.select("item", "words", F.explode(starts).alias("i")).select(
        "item", F.slice("words", F.col("i"), words).alias("words")
    )
    return rolled.groupBy(window_hash(word_codes(F.col("words")), words).alias("hash"), window_text(F.col("words")).alias("window")).agg(
        F.first(F.size("words")).alias("n"), F.array_sort(F.collect_set("item")).alias("items")
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = WINDOW_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
    A document word inside any occurrence of a benchmark window is hit; hit_spans
    lists the hit words as (start, end) of merged spans, words from 0.

    The set of windows is counted first. Up to ``most_broadcast`` it is broadcast
    and the documents are read once; a larger set is cut by hash into parts of
    that size and the documents are read once for each part, so no part of the
    benchmark is left out and no text is shuffled. Only hits and one row a
    document are, grouped by row, so repeated rows and ids stay separate rows.
    A null or empty text has no words and is clean. Without benchmark rows every document is clean.
    """
    windows = materialise(benchmark_windows(benchmark, words), "benchmark-windows")
    size = windows.agg(F.coalesce(F.sum(F.greatest(F.size("items"), F.lit(1))), F.lit(0))).first()[0]
    lengths = [r[0] for r in windows.select("n").distinct().collect()]  # as many as a window has words
    parts = max(1, -(-size // most_broadcast))
    found = reduce(
        DataFrame.union,
        [
            matches(docs, windows.filter(F.pmod("hash", F.lit(parts)) == part), lengths, id_column, text_column)
            for part in range(parts)
        ],
    )
    # hits in their order within a row: a span begins where no earlier hit reaches to, so spans are merged
    # before anything is collected, and all steps below lie by row after one shuffle
    so_far = Window.partitionBy("row").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("row").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    hits = found.withColumns({"low": F.when(F.col("n") > 0, F.col("start")), "high": F.when(F.col("n") > 0, F.col("start") + F.col("n"))})
    begins = F.coalesce(F.max("high").over(earlier) < F.col("low"), F.col("low").isNotNull())
    spans = (
        hits.withColumn("begins", begins.cast("int"))
        .withColumn("span", F.sum("begins").over(so_far))
        .groupBy("row", "span")
        .agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.min("low").alias("start"), F.max("high").alias("end"), F.flatten(F.collect_set("items")).alias("items"),
        )
    )
    per_row = spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).cast("long").alias("n_hit"),
        F.array_sort(F.collect_list(F.when(F.col("end").isNotNull(), F.struct("start", "end")))).alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return per_row.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "hit_spans",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose own text holds no benchmark passage, whatever their ids are.

    Rows are judged by a number of their own, see ``with_row_key``. Their order may change.
    """
    rows = with_row_key(docs, "decontamination-rows", "_row_key", id_column)
    hit = contamination(rows, benchmark, id_column="_row_key", **options).filter("contaminated")
    return rows.join(hit.select(F.col("doc_id").alias("_row_key")), "_row_key", "left_anti").select(*docs.columns)


def remove_spans(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, clean_text: the lower-cased words outside the hit spans, with single blanks; ids must be unique."""
    words = docs.select(F.col(id_column).alias("doc_id"), alnum_words(F.col(text_column)).alias("words"))
    outside = F.filter(
        "words",
        lambda w, i: ~F.exists("hit_spans", lambda s: (i >= s["start"]) & (i < s["end"])),
    )
    return words.join(found.select("doc_id", "hit_spans"), "doc_id").select(
        "doc_id", F.array_join(outside, " ").alias("clean_text")
    )
