"""Mixing sources to target weights by hierarchical budgets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.llm.running import running_before
from landledger.storage import materialise

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
# target weights of the registered query and of the pipeline; a name that is not listed weighs 1
WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 3, "domain3": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
}
DOMAINS = 4


def domain_of(source: Column) -> Column:
    """Domain of a source: its number modulo ``DOMAINS``; sources without a number share one domain."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})", 1)
    return F.when(number == "", F.lit("other")).otherwise(
        F.concat(F.lit("domain"), (number.try_cast("long") % DOMAINS).cast("string"))
    )


def _budgets(children: DataFrame, parents: DataFrame, path: Sequence[str]) -> DataFrame:
    """Share each parent's budget among its children: ``children`` (path, capacity, weight), ``parents`` (path, budget).

    Children in the order of capacity per weight are filled up while the capacity is
    within their part of what is left; the rest divide the remainder by weight. That is
    how a shortage goes to the siblings, and to them alone.
    """
    name = path[-1]
    above = list(path[:-1])
    wide = lambda c: F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")
    order = [F.col("capacity").cast("double") / F.col("weight").cast("double"), F.col(name)]
    along = Window.partitionBy(*above).orderBy(*order) if above else Window.partitionBy(F.lit(0)).orderBy(*order)
    whole = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    onward = along.rowsBetween(0, Window.unboundedFollowing)
    joined = children.join(parents, above) if above else children.crossJoin(parents)
    ranked = joined.select(
        *path, "capacity", "weight",
        F.least("budget", F.sum("capacity").over(whole)).alias("budget"),
        F.coalesce(F.sum("capacity").over(before), F.lit(0)).alias("filled"),
        F.sum("weight").over(onward).alias("weights"),
    ).withColumn(
        "full", wide("capacity") * F.col("weights") <= wide(F.col("budget") - F.col("filled")) * F.col("weight")
    )
    shared = ranked.select(
        *path, "capacity", "full",
        (F.col("budget") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(whole)).alias("rest"),
        F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(whole).alias("weights"),
        F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(
            along.rowsBetween(Window.unboundedPreceding, 0)
        ).alias("upto"),
        F.when(~F.col("full"), F.col("weight")).otherwise(0).alias("own"),
    )
    part = "(cast(rest AS decimal(38,0)) * {}) div greatest(weights, 1)"
    return shared.select(
        *path,
        F.when(F.col("full"), F.col("capacity"))
        .otherwise(F.expr(part.format("upto")) - F.expr(part.format("(upto - own)")))
        .alias("budget"),
    )


def budgets(
    tokens: DataFrame, total: Column, weights: Mapping[str, Mapping[str, int]], max_epochs: int, levels: Sequence[str] = LEVELS
) -> DataFrame:
    """Token budget of every leaf: (levels, tokens, budget); ``tokens`` has the levels and tokens of the leaves.

    ``total`` is an expression over the sum of all tokens, named ``tokens``. Whole
    numbers throughout, and the budgets add up to the total exactly, or to what
    ``max_epochs`` passes over everything hold if that is less.
    """
    budget = tokens.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).select(
        F.least(total, F.col("tokens") * max_epochs).cast("long").alias("budget")
    )
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        own = weights.get(path[-1], {})
        weight = F.lit(1).cast("long")
        for name, value in own.items():
            if value < 1:
                raise ValueError(f"weight of {name!r} must be 1 at least")
            weight = F.when(F.col(path[-1]) == name, F.lit(value).cast("long")).otherwise(weight)
        children = tokens.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("capacity")).withColumn("weight", weight)
        budget = _budgets(children, budget, path)
    return tokens.join(budget, list(levels))


def mix(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    share: tuple[int, int] = (3, 5),
    max_epochs: int = 2,
    seed: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
    domain: Column | None = None,
    seed_column: str | None = None,
) -> DataFrame:
    """Per document: doc_id, domain, lang, source, tokens, copies, tokens_taken, kept.

    Tokens are words between ASCII white space. The total budget is ``share`` (a
    fraction) of all tokens. It goes down the tree domain - language - source by the
    weights. A node that cannot use its part, even with ``max_epochs`` passes over
    its documents, leaves the rest to its siblings; only what a whole family cannot use
    goes to the siblings of its parent. A leaf takes whole epochs of its documents, then
    the token prefix of one more in an order seeded by seed, epoch, id (or ``seed_column``) and text: copies counts the
    times a document is taken, the last of which may be a prefix, and tokens_taken their tokens.

    Leaf sums are partial aggregates; positions within a leaf come from running sums over
    4,096 digest buckets, so a source with a third of all rows is spread evenly. A null
    language or source is a name of its own, "none"; a null text has no tokens, and a
    document without tokens is taken when its place lies within the prefix. Repeated rows are
    separate rows. An empty table gives no rows.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (domain_of(F.col("source")) if domain is None else domain).alias("domain"),
        name("lang").alias("lang"),
        name("source").alias("source"),
        F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD)).cast("long").alias("tokens"),
        F.coalesce(F.col(seed_column or id_column).cast("long"), F.lit(-1)).alias("own"),
        F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary")).alias("text_md5"),
    )
    rows = materialise(rows, "mix-rows")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    part = F.floor(F.col("tokens") * share[0] / share[1]) if share[1] == 1 else F.expr(f"(tokens * {share[0]}) div {share[1]}")
    plan = materialise(budgets(leaves, part, weights, max_epochs), "mix-budgets").select(
        *LEVELS,
        F.expr("if(tokens > 0, budget div tokens, 0)").alias("full"),
        F.expr("if(tokens > 0, budget % tokens, 0)").alias("rest"),
    )
    # the text is part of it: rows that share an id, or have none, are spread as others are
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("full") + 1, "own", "text_md5").cast("binary"))
    placed = rows.join(plan, list(LEVELS)).withColumn("key", key).withColumn("bucket", F.substring("key", 1, 3))
    taken = running_before(placed, LEVELS, "bucket", ["key", "tokens"], "tokens", "before")
    copies = F.col("full") + (F.col("before") < F.col("rest")).cast("long")
    prefix = F.least("tokens", F.greatest(F.col("rest") - F.col("before"), F.lit(0)))
    return taken.select(
        "doc_id", *LEVELS, "tokens",
        copies.alias("copies"),
        (F.col("full") * F.col("tokens") + prefix).alias("tokens_taken"),
        (copies > 0).alias("kept"),
    )
