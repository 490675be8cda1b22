"""URL verdicts: rules first, then gradient-boosted trees on lexical features, in built-in functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.storage import materialise

# The rules of the contract as (host/path, verdict).
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
TRAIN_ROWS = 20_000
HASHES = 2**62
COUNT_ERROR = 0.02  # of the number of distinct labelled urls, a tenth of the margin of the threshold
TREES, DEPTH = 20, 4
PRIOR_ROWS = 10  # weight of the overall rate in a word's rate
FOLDS = 5  # a host's rates come from the hosts of the other folds
HELD_OUT = 4  # one host of so many is held out of an evaluation
FEATURES = [
    "url_chars", "host_chars", "path_chars", "query_chars", "depth", "labels", "parameters", "digit_ratio",
    "hyphens", "entropy", "secure", "segment_rate", "label_rate",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path after the first ``://``; both empty without one or for null."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null if none; rules of equal length in alphabetical order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0]), reverse=True):
        own_host, slash, own_path = text.partition("/")
        fits = ((host == own_host) | F.endswith(host, F.lit(f".{own_host}"))) & F.startswith(path, F.lit(slash + own_path))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _occurrences(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))).cast("double")


def _lexical(pages: DataFrame) -> DataFrame:
    """Features of the url's characters alone; needs url, host, path."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    length = F.length(url).cast("double")
    letters = F.filter(F.split(url, ""), lambda c: c != "")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / F.length(c) / length
    entropy = F.aggregate(
        F.array_distinct(letters), F.lit(0.0), lambda total, c: total - share(c) * F.log2(share(c))
    )
    return (
        pages.withColumn("url_chars", length)
        .withColumn("host_chars", F.length(host).cast("double"))
        .withColumn("path_chars", F.length(path).cast("double"))
        .withColumn("query_chars", F.length(F.regexp_extract(url, r"\?([^#]*)", 1)).cast("double"))
        .withColumn("depth", _occurrences(path, "/"))
        .withColumn("labels", _occurrences(host, "."))
        .withColumn("parameters", _occurrences(F.regexp_extract(url, r"\?([^#]*)", 1), "="))
        .withColumn("digit_ratio", F.coalesce(F.try_divide(F.regexp_count(url, F.lit("[0-9]")).cast("double"), length), F.lit(0.0)))
        .withColumn("hyphens", _occurrences(host, "-"))
        .withColumn("entropy", F.coalesce(entropy, F.lit(0.0)))
        .withColumn("secure", F.startswith(url, F.lit("https")).cast("double"))
        .withColumn("segment", F.xxhash64(F.substring_index(F.substr(path, F.lit(2)), "/", 1)))
        .withColumn("label", F.xxhash64(F.substring_index(host, ".", 1)))
    )


def _fold(host: Column, folds: int) -> Column:
    return F.pmod(F.crc32(host.cast("binary")), F.lit(folds)).cast("int")


def _rates(train: DataFrame, base: float) -> DataFrame:
    """Block rates (kind, word, fold, rate) of the first path segment and the first host label, without the hosts of their
    own fold. Both stand on hosts of all kinds, so what labelled hosts show of a word holds for hosts without a rule, too;
    the last labels would not do, as those of a labelled host always lie at or below the host of a rule.
    """
    counted = (
        train.select("blocked", _fold(F.col("host"), FOLDS).alias("own"), F.explode(
            F.create_map(F.lit("segment"), "segment", F.lit("label"), "label")).alias("kind", "word"))
        .groupBy("kind", "word", "own").agg(F.sum("blocked").alias("blocked"), F.count(F.lit(1)).alias("n"))
    )
    others = counted.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1)))).filter("fold <> own")
    return others.groupBy("kind", "word", "fold").agg(
        ((F.sum("blocked") + PRIOR_ROWS * base) / (F.sum("n") + PRIOR_ROWS)).alias("rate")
    )


def _with_rates(pages: DataFrame, rates: DataFrame, base: float) -> DataFrame:
    """The rates of a url's words as the hosts of other folds have them; the overall rate where there are none."""
    pages = pages.withColumn("fold", _fold(F.col("host"), FOLDS))
    for kind in ("segment", "label"):
        own = rates.filter(F.col("kind") == kind).select("fold", F.col("word").alias(kind), F.col("rate").alias(f"{kind}_rate"))
        # the hint is safe: FOLDS rows for a word, told by its hash, and no more words than training rows
        pages = pages.join(F.broadcast(own), [kind, "fold"], "left").fillna(base, [f"{kind}_rate"])
    return pages.drop("fold")


def _with_rules(pages: DataFrame, rules: Sequence[tuple[str, str]], id_column: str, url_column: str) -> DataFrame:
    found = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    found = found.withColumn("host", host).withColumn("path", path)
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    return found.withColumn("rule", rule).withColumn("says", says)


def _fit(labelled: DataFrame, train_rows: int) -> Callable[[DataFrame], DataFrame]:
    """Trees from labelled urls, as a function that adds ``probability`` (that a url is to be blocked) to its rows."""
    # a threshold on the hash leaves few more urls than needed to be folded and sorted, however often each is repeated
    distinct = labelled.agg(F.approx_count_distinct("url", COUNT_ERROR)).first()[0]
    order = F.pmod(F.xxhash64("url"), F.lit(HASHES))
    near = order < int(min(1.0, 1.2 * train_rows / max(distinct, 1)) * HASHES)
    chosen = labelled.filter(near).select("url", "host", "path", "says").distinct().orderBy(order, "url")
    train = materialise(
        _lexical(chosen.limit(train_rows).withColumn("blocked", (F.col("says") == "block").cast("double"))), "url-train"
    )
    rows, blocked = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    if not rows or blocked in (0.0, float(rows)):
        return lambda urls: urls.withColumn("probability", F.lit(1.0 if rows and blocked else 0.0))
    base = blocked / rows
    rates = materialise(_rates(train, base), "url-rates")
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    trees = GBTClassifier(labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(vector.transform(_with_rates(train, rates, base)))
    return lambda urls: trees.transform(vector.transform(_with_rates(_lexical(urls), rates, base))).withColumn(
        "probability", vector_to_array("probability")[1]
    )


def url_filter(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, score (0 to 1, higher: block likelier; null where a rule decides).

    A rule fits its host and all subdomains if the path starts with the rule's; the longest decides.
    Where none fits, gradient-boosted trees do: they learn from at most ``train_rows`` distinct urls that rules
    label, those with the smallest hashes, on length, depth, digit ratio, entropy, parameter counts and the
    block rates of the first path segment and the first host label, taken from other hosts. If the rules
    label one side only, that is the verdict of all; without any labelled url the verdict is allow.

    A null url or one without ``://`` has an empty host and path. Urls are judged whole, however long. Repeated rows
    are separate rows. The table is never shuffled: the rates are bounded by the training rows and broadcast.
    """
    found = _with_rules(pages, rules, id_column, url_column)
    judged = _fit(found.filter("rule IS NOT NULL"), train_rows)(found)
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("says", F.when(F.col("probability") > 0.5, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("probability")).alias("score"),
    )


def held_out_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """What the trees say of urls that rules label, on hosts they have not seen: page_id, host, says, verdict, score.

    One host of ``HELD_OUT`` is kept out of the training; ``says`` is the rule's verdict, ``verdict`` the trees'.
    """
    labelled = _with_rules(pages, rules, id_column, url_column).filter("rule IS NOT NULL")
    out = _fold(F.col("host"), HELD_OUT) == 0
    return _fit(labelled.filter(~out), train_rows)(labelled.filter(out)).select(
        "page_id", "host", "says",
        F.when(F.col("probability") > 0.5, "block").otherwise("allow").alias("verdict"), F.col("probability").alias("score"),
    )
