"""From raw documents to shards of training text, one stage after another.

Every stage works on all rows its predecessor kept and returns the columns of
``documents``; the last returns the placed rows. Decisions are made per row, by a number of its own:
the id where all rows have different ones, else a number that the stage stores with its rows. ``run`` writes each stage to the
shared folder and reads it back, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.llm.decontamination import drop_contaminated
from landledger.llm.mixing import mix
from landledger.llm.near_dedup import near_duplicates
from landledger.llm.resharding import reshard
from landledger.llm.text_tables import table, with_row_key
from landledger.llm.toxicity import fit, score
from landledger.storage import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = "row_key"


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows whose number is not the ``doc_id`` of a row of ``dropped``, the result of an operator over these numbers."""
    return rows.join(dropped.select(F.col("doc_id").alias(KEY)), KEY, "left_anti").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model, learnt from the labels of their ids, does not reject."""
    rows = with_row_key(docs, "pipeline-rows", KEY)
    return _without(rows, score(rows, fit(rows, table(spark, sf_dir, "labels")), id_column=KEY).filter("predicted = 1"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by shingles of five words, similarity 0.8 or more: that with the smallest id.

    Of equal ids, and where none has one, the row that is stored first stays.
    """
    rows = with_row_key(docs, "pipeline-rows", KEY)
    groups = near_duplicates(rows, id_column=KEY).select(F.col("doc_id").alias(KEY), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", KEY))
    kept = groups.join(rows.select(KEY, "doc_id"), KEY).groupBy("component_id").agg(first.alias("first"))
    return rows.join(kept.select(F.col(f"first.{KEY}").alias(KEY)), KEY, "left_semi").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any benchmark passage."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the target weights take: four fifths of all tokens, each row once."""
    rows = with_row_key(docs, "pipeline-rows", KEY)
    return _without(rows, mix(rows, share=(4, 5), max_epochs=1, id_column=KEY, seed_column="doc_id").filter("NOT kept"))


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there; a row for each row of ``docs``."""
    return reshard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

# fitted weights cannot be written in SQL; tests hold the stages against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
