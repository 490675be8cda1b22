"""Licence phrases and notices in documents by diagonal voting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.llm.license_texts import NOTICES, PHRASES
from landledger.llm.word_windows import matches, window_hash, window_text, word_codes

PHRASE_GRAM, NOTICE_GRAM = 2, 4
SLACK = 3  # neighbouring diagonals this far apart belong to one place: words were put in or left out
COVERAGE = 0.6  # share of a notice's grams that a place must hold


def template_grams(
    spark: SparkSession,
    phrases: Mapping[str, str] = PHRASES,
    notices: Sequence[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """Rolling grams of all templates: hash, window, n, template, label, phrase, grams, at (position).

    A phrase is cut into grams of two words, a notice into grams of four.
    """
    rows = []
    sources = [(text, label, True) for text, label in phrases.items()]
    sources += [(text, label, False) for label, text in notices]
    for template, (text, label, phrase) in enumerate(sources):
        words, k = text.split(), PHRASE_GRAM if phrase else NOTICE_GRAM
        grams = len(words) - k + 1
        rows += [(words[i : i + k], k, template, label, phrase, grams, i) for i in range(grams)]
    schema = "words array<string>, n int, template int, label string, phrase boolean, grams long, at long"
    return spark.createDataFrame(rows, schema).select(
        window_hash(word_codes(F.col("words")), NOTICE_GRAM).alias("hash"), window_text(F.col("words")).alias("window"),
        "n", "template", "label", "phrase", "grams", "at",
    )


def license_scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    notices: Sequence[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    All rolling word grams of a text are joined to the positions of the templates,
    a fixed list. A hit votes for its diagonal, the place where the template would
    begin. A phrase stands where a diagonal has all its votes. The votes of a notice
    are merged over diagonals at most ``SLACK`` apart; the place counts if it holds
    ``COVERAGE`` of the notice's grams and is no longer than twice the notice. The
    words behind each vote are compared, not just their hashes. score is the
    largest share of a template's grams found at one place, 1.0 for whole ones.

    Votes are counted before they are shuffled, and they meet by document only.
    A null or empty text has no words, empty labels and score 0.0. Repeated rows stay separate rows.
    """
    grams = template_grams(docs.sparkSession, phrases, notices)
    votes = (
        matches(docs, grams, [PHRASE_GRAM, NOTICE_GRAM], id_column, text_column)
        .withColumn("diagonal", F.col("start") - F.col("at"))
        .groupBy("row", "template", "diagonal")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "phrase", "grams")],
            F.count(F.lit(1)).alias("votes"),
            F.min("start").alias("first"),
            F.max(F.col("start") + F.col("n")).alias("last"),
        )
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("phrase"), 0).otherwise(SLACK)
    places = (
        votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("place", F.sum("new").over(along))
        .groupBy("row", "template", "place")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "phrase", "grams")],
            F.sum("votes").alias("votes"),
            F.min("diagonal").alias("start"),
            (F.max("last") - F.min("first")).alias("length"),
        )
        .withColumn("share", F.least(F.col("votes"), F.col("grams")) / F.col("grams"))
    )
    whole = F.col("phrase") & (F.col("votes") == F.col("grams"))
    close = ~F.col("phrase") & (F.col("share") >= COVERAGE) & (F.col("length") <= 2 * (F.col("grams") + NOTICE_GRAM - 1))
    labels = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    return places.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("start"))).alias("first_word"),
        F.max(F.when(whole, F.col("start"))).alias("last_word"),
        labels(whole).alias("base_labels"),
        labels(whole | close).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    ).drop("row")
