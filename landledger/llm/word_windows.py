"""Rolling windows of words matched against a broadcast table of windows, in built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.llm.text_tables import alnum_words

BLOCK_WORDS = 2_000
NO_WINDOW = 0  # hash of the empty window that keeps every document in the result


def word_codes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def window_hash(codes: Column, n: int, at: Column | int = 0) -> Column:
    """Hash of the ``n`` word codes from ``at``, of fewer where the array ends."""
    at = F.lit(at) if isinstance(at, int) else at
    return F.xxhash64(*[F.get(codes, at + i if i else at) for i in range(n)])


def window_text(words: Column) -> Column:
    """The words of a window; they hold no blanks, so equal texts are equal windows."""
    return F.array_join(words, " ")


def empty_window(windows: DataFrame) -> DataFrame:
    """One row like those of ``windows`` for the empty window; other columns are null."""
    own = {"hash": F.lit(NO_WINDOW).cast("long"), "window": F.lit(""), "n": F.lit(0)}
    return windows.sparkSession.range(1).select(
        *[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in windows.schema]
    )


def matches(docs: DataFrame, windows: DataFrame, lengths: Sequence[int], id_column: str, text_column: str) -> DataFrame:
    """Every place where a window stands in a text, and one row a block with the empty window.

    ``windows`` has hash, window, n (words) and further columns, and is small
    enough to broadcast: the caller checks that. Result: row (a number for each
    row of ``docs``), doc_id, n_words, start (words from 0) and the columns of
    ``windows``. Texts are worked in blocks of ``BLOCK_WORDS`` starts. The hash of
    each rolling window probes the broadcast table; the words behind a hit are
    then compared, so equal hashes of different words yield nothing.
    """
    lengths = sorted(set(lengths)) or [1]
    longest = lengths[-1]
    # explode keeps the optimizer from putting an array's expression in place of its name, where a
    # lambda would work it out again for every element
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    texts = numbered.select(
        "row", "doc_id", F.explode(F.array(alnum_words(F.col("text").cast("string")))).alias("words")
    ).withColumn("n_words", F.size("words").cast("long"))
    last = F.floor(F.greatest(F.size("words") - 1, F.lit(0)) / BLOCK_WORDS).cast("int")
    blocks = texts.select(
        "row", "doc_id", "n_words",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda b: F.slice("words", b * BLOCK_WORDS + 1, BLOCK_WORDS + longest - 1),
            )
        ).alias("block", "words"),
    ).select("*", (F.col("block") * BLOCK_WORDS).alias("first"), F.explode(F.array(word_codes(F.col("words")))).alias("codes"))
    starts = F.least(F.size("words"), F.lit(BLOCK_WORDS))

    def rolled(n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), starts - 1), lambda i: window_hash(F.col("codes"), n, i))

    empty = F.array(F.lit(NO_WINDOW).cast("long"))
    hashes = F.when(F.size("words") > 0, F.concat(empty, *[rolled(n) for n in lengths])).otherwise(empty)
    probes = blocks.withColumn("hashes", hashes).select(
        "row", "doc_id", "n_words", "first", "words", F.posexplode("hashes").alias("probe", "hash")
    )
    # the probes of a block are the empty window, then all starts for each length
    within = F.when(F.col("probe") > 0, F.pmod(F.col("probe") - 1, starts)).otherwise(0)
    sizes = F.array(*[F.lit(n) for n in lengths])
    # near the end of a text a longer window is cut short and must not count as the shorter one
    probed = F.when(F.col("probe") > 0, F.get(sizes, ((F.col("probe") - 1) / starts).cast("int"))).otherwise(0)
    return (
        probes.join(F.broadcast(windows.union(empty_window(windows))), "hash")
        .filter(F.col("n") == probed)
        .filter(window_text(F.slice("words", within + 1, F.col("n"))) == F.col("window"))
        .select(
            "row", "doc_id", "n_words", (F.col("first") + within).cast("long").alias("start"),
            *[c for c in windows.columns if c != "hash"],
        )
    )
