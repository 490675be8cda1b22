"""Growth, shares, first/last and correlation on aggregated series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.functions.numbers import round_even
from landledger.operators.profile import guarded
from landledger.storage import materialise


def growth_pct(
    df: DataFrame, columns: Mapping[str, str], order: Sequence[str], digits: int | None = None
) -> DataFrame:
    """Change from the previous row in %, ``columns`` maps source to result.

    Positional: gaps in the periods are not filled. The input is an aggregate by
    period, one row each, so the ordered window holds a few hundred rows.
    """
    by_period = Window.orderBy(*order)
    out = {}
    for source, target in columns.items():
        now = F.col(source).cast("double")
        change = (F.try_divide(now, F.lag(now).over(by_period)) - F.lit(1.0)) * F.lit(100.0)
        out[target] = change if digits is None else round_even(change, digits)
    return df.withColumns(out)


def share_of_total(df: DataFrame, column: str, target: str, digits: int | None = None) -> DataFrame:
    """Share of the column's own total in %, on an aggregate (null groups included).

    The total is one row joined back, so groups that are many, like free texts, stay where they are. The
    aggregate is stored first: groups and total come from one evaluation.
    """
    df = materialise(df, "shares")
    total = df.agg(F.sum(column).alias("_total"))
    share = F.try_divide(F.col(column).cast("double"), F.col("_total").cast("double")) * F.lit(100.0)
    out = df.crossJoin(F.broadcast(total)).withColumn(target, share if digits is None else round_even(share, digits))
    return out.drop("_total")


def first_and_last(
    df: DataFrame, group: str, order: str, columns: Sequence[str]
) -> DataFrame:
    """Per group the first and latest period with its columns."""
    row = F.struct(order, *columns)
    ends = df.groupBy(group).agg(
        F.min_by(row, order).alias("first"), F.max_by(row, order).alias("latest")
    )
    out = [F.col(group)]
    for end in ("first", "latest"):
        out.append(F.col(f"{end}.{order}").alias(f"{end}_{order}"))
        out += [F.col(f"{end}.{c}").alias(f"{end}_{c}") for c in columns]
    return ends.select(*out)


def pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete r; null for a constant column instead of an error."""
    both = a.isNotNull() & b.isNotNull()
    spread = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    return F.try_divide(F.covar_pop(a, b), spread)


def correlation_table(
    df: DataFrame,
    left: Sequence[str],
    right: Sequence[str],
    month: str,
    digits: int = 4,
    least_pairs: int = 3,
    rules: Mapping[str, Column] | None = None,
) -> DataFrame:
    """All left x right pairs: r, number of complete pairs, period covered.

    ``rules`` are aggregates that must be false; one that is true raises.
    """
    aggregates = [F.min(month).alias("period_start"), F.max(month).alias("period_end")]
    pairs = []
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            x, y = F.col(a).cast("double"), F.col(b).cast("double")
            aggregates.append(pearson(x, y).alias(f"_r{i}_{j}"))
            aggregates.append(F.count_if(x.isNotNull() & y.isNotNull()).alias(f"_n{i}_{j}"))
            r, n = F.col(f"_r{i}_{j}"), F.col(f"_n{i}_{j}")
            pairs.append(
                F.struct(
                    F.lit(a).alias("market_metric"),
                    F.lit(b).alias("planning_metric"),
                    round_even(F.when(n >= least_pairs, r), digits).alias("pearson_correlation"),
                    n.alias("observations"),
                )
            )
    broken = {f"_b{i}": (message, bad) for i, (message, bad) in enumerate((rules or {}).items())}
    figures = df.agg(*aggregates, *[bad.alias(name) for name, (_, bad) in broken.items()])
    figures = guarded(figures, {message: F.col(name) for name, (message, _) in broken.items()})
    return figures.select(F.inline(F.array(*pairs)), "period_start", "period_end")


def latest(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows of an ordered series, in order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def top_rows(df: DataFrame, columns: Sequence[str], by: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    return (
        df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n).select(*columns)
    )


def set_coverage(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values of one side only, as (side, value); each side is read once."""
    both = left.select(column, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(column, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    sides = (
        both.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    )
    return sides.filter(F.col("_l") != F.col("_r")).select(
        F.when(F.col("_r") == 0, "missing").otherwise("extra").alias("side"), column
    )
