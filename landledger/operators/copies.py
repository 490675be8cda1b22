"""Exact copies of rows, told in two phases so that rows without a copy are never shuffled.

First only digests of 64 bits travel: those that more than one row has are marked in a bitmap of fixed size. Then
rows whose mark is not set have no copy and stay where they are; the others are shuffled whole and compared in
full. Rows of different content with one digest or one mark cost time, never a row. The bitmap is the only thing
broadcast and does not grow with the data: the more digests repeat, the more rows are shuffled, at worst all of them.
The table is read three times (digests, rows with and without a mark), so this pays where reading costs less than
shuffling, as with stored columns. A table may come in another order in each reading, but must hold the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.storage import materialise

MARKS = 1 << 26  # bits of the bitmap, kept as at most a million words of 64 bits


def row_digest(df: DataFrame) -> Column:
    """64 bits of a row's content; equal rows have equal digests."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def split_repeated(df: DataFrame, digest: Column | None = None, marks: int = MARKS) -> tuple[DataFrame, DataFrame]:
    """(single, suspect): rows that have no copy, and all others; all copies of a row are in ``suspect``.

    ``digest`` is a whole number that equal rows share, by default ``row_digest``. Rows are not changed, nulls are
    values like others, and an empty table gives two empty ones. The bitmap is stored before the two are returned.
    """
    digest = row_digest(df) if digest is None else digest
    slot = F.pmod(digest, F.lit(marks))
    repeated = df.select(digest.alias("_digest")).groupBy("_digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # a whole bitmap in one value would be copied for each row that tests a bit of it, a word is not
    word, bit = (lambda at: F.shiftright(at, 6)), (lambda at: (at % 64).cast("int"))
    at = F.pmod("_digest", F.lit(marks))
    marked = repeated.select(word(at).alias("_copy_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit(at)).alias("b"))
    bitmap = materialise(marked.groupBy("_copy_word").agg(F.bit_or("b").alias("_copy_bits")), "copy-marks")
    columns = [F.col(f"`{c}`") for c in df.columns]
    placed = df.withColumns({"_copy_word": word(slot), "_copy_bit": bit(slot)})
    tested = placed.join(F.broadcast(bitmap), "_copy_word", "left").withColumn(
        "_copy_set", F.coalesce(F.call_function("shiftright", F.col("_copy_bits"), F.col("_copy_bit")) % 2 != 0, F.lit(False))
    )
    return tested.filter("NOT _copy_set").select(*columns), tested.filter("_copy_set").select(*columns)


def drop_copies(df: DataFrame, digest: Column | None = None, marks: int = MARKS) -> DataFrame:
    """Each different row once, as ``dropDuplicates``, but only rows whose mark is set are shuffled."""
    single, suspect = split_repeated(df, digest, marks)
    return single.unionAll(suspect.dropDuplicates())


def drop_copies_stored(df: DataFrame) -> DataFrame:
    """``drop_copies`` of a table whose reading costs much, as a view of joins or text files does: its rows are stored first."""
    return drop_copies(materialise(df, "delivered", "zstd"))


def copy_count(df: DataFrame, digest: Column | None = None, marks: int = MARKS) -> DataFrame:
    """One row: row_count, unique_rows and duplicate_rows, counted without shuffling rows that have no copy."""
    single, suspect = split_repeated(df, digest, marks)
    copies = suspect.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n")).select("n")
    # one row a partition stands for the rows without a copy
    alone = single.agg(F.count(F.lit(1)).alias("n"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    counted = copies.agg(total("n", "n"), F.count(F.lit(1)).alias("u")).unionAll(alone.select("n", F.col("n").alias("u")))
    return counted.agg(
        total("n", "row_count"), total("u", "unique_rows"), total(F.col("n") - F.col("u"), "duplicate_rows")
    )
