"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.storage import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def narrow(df: DataFrame) -> DataFrame:
    """An aggregate of short rows in an eighth of the shuffle's partitions, without a further shuffle.

    Such tables hold a few numbers where the texts behind them hold thousands of bytes.
    """
    return df.coalesce(max(1, shuffle_partitions(df.sparkSession) // 8))


def with_row_key(docs: DataFrame, label: str, key: str = "row_key", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with a number for every row in column ``key``, so that each row can get its own decision.

    Ids that differ and are never null are such numbers already; that is looked up first, from the ids alone.
    Otherwise the rows are numbered and stored once, so that the numbers stay the same however often they are read.
    """
    own = F.col(id_column).cast("long")
    shared = docs.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR id IS NULL")
    if shared.isEmpty():
        return docs.withColumn(key, own)
    return materialise(docs.withColumn(key, F.monotonically_increasing_id()), label)


def ids_and_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns as (doc_id long, text string, never null)."""
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(text, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """Words of letters, digits and all that is not ASCII, A-Z lower-cased; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAPS), lambda w: w != "")
