"""Counts, totals and exact quantiles per group without a hot task.

``percentile`` keeps every distinct value of a group in one task's memory. Here
the rows first collapse to (group, value, count), where partial aggregation
folds repeated values before the shuffle. A rank is then found in two steps:
running counts over coarse value buckets give the bucket that holds it, and
running counts over the values of that bucket give the value. Buckets follow the
square root of the value, so both steps are bounded by the size of the values and
not by the table: with amounts below 100 million in cents, a group has at most
25,000 buckets and a bucket at most 800,000 values, whatever share of the table
the group holds.

Expressions are SQL text: one call per projection instead of one per operator.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger.functions.dates import quantile_label
from landledger.functions.numbers import exact_mean, float_mean
from landledger.storage import materialise

# Rows without a value sort below every real bucket.
_NO_VALUE_BUCKET = -(1 << 62)


def _bucket(scale: int) -> str:
    # monotone in the value, through a float too; finer units do not make finer buckets
    root = f"sqrt(abs(CAST(_c AS DOUBLE)) / {10 ** max(scale - 2, 0)}D)"
    return f"coalesce(floor(sign(_c) * {root} / 4), {_NO_VALUE_BUCKET}L)"


def _scale(df: DataFrame, value: str) -> int:
    dtype = df.schema[value].dataType
    if not isinstance(dtype, T.DecimalType) or dtype.precision > 18:
        raise TypeError(f"{value} must be a decimal of at most 18 digits, not {dtype}")
    return dtype.scale


def minor_units(df: DataFrame, value: str, of: str | None = None) -> str:
    """SQL of a decimal column's value as a whole number of its smallest units, exact; ``of`` is its name where it is used."""
    scale, name = _scale(df, value), of or f"`{value}`"
    if df.schema[value].dataType.precision <= 15:  # the way through a float is exact, and faster
        return f"CAST(rint(CAST({name} AS DOUBLE) * {10**scale}) AS BIGINT)"
    return f"CAST({name} * CAST({10**scale} AS DECIMAL(19,0)) AS BIGINT)"


def value_tallies(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    tallies: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per (group ``_g``, value ``_c`` in minor units): rows, conditional counts.

    Without keys there is no ``_g``.
    """
    minor = f"{minor_units(df, value, '_value')} AS _c"
    # a struct compares null fields as equal, so null groups join like others
    group = [F.struct(*keys).alias("_g")] if keys else []
    flags = {f"_t_{name}": flag for name, flag in (tallies or {}).items()}
    counts = ["count(1) AS _rows", *[f"count_if(`{t}`) AS `{t}`" for t in flags]]
    return (
        df.select(*group, F.col(value).alias("_value"), *[c.alias(t) for t, c in flags.items()])
        .groupBy(*(["_g"] if keys else []), "_value")
        .agg(*[F.expr(c) for c in counts])
        .selectExpr(*(["_g"] if keys else []), minor, "_rows", *[f"`{t}`" for t in flags])
    )


def ranked(
    tallied: DataFrame,
    keys: Sequence[str],
    scale: int,
    quantiles: Mapping[str, float],
    tallies: Sequence[str] = (),
    weights: Sequence[str] = ("_rows",),
    reread: bool = False,
) -> DataFrame:
    """Group statistics and quantiles from value tallies.

    ``weights`` are counts of a tallied row in SQL, the count of all rows first.
    Every weight gets its own ``rows_i``, ``value_rows_i``, ``total_i`` and
    quantiles, from the same pass.

    With ``reread`` the tallies, which must come from a stored table, are read twice and never shuffled: partial
    sums give the buckets, then only rows of the located buckets are taken. Values may repeat.
    """
    every = range(len(weights))
    group = ["_g"] if keys else []
    whole, upto = ("PARTITION BY _g " if keys else ""), "ROWS UNBOUNDED PRECEDING"
    # One array per value: both uses below then need the same column, so the
    # optimizer prunes neither and they share one scan and shuffle.
    cells = ["_c", *weights, *[f"`_t_{t}`" for t in tallies]]
    values = tallied.selectExpr(*group, f"{_bucket(scale)} AS _b", f"array({', '.join(cells)}) AS _v")
    if not reread:
        values = values.repartition(*group, "_b")
    known = [f"IF(_v[0] IS NULL, 0L, _v[{i + 1}])" for i in every]
    sums = {f"_t_{t}": f"_v[{len(weights) + 1 + k}]" for k, t in enumerate(tallies)}
    for i in every:
        sums[f"_r{i}"] = f"_v[{i + 1}]"
        sums[f"_n{i}"] = known[i]
        sums[f"_s{i}"] = f"CAST(_v[0] AS DECIMAL(18,0)) * CAST({known[i]} AS DECIMAL(18,0))"
    buckets = values.groupBy(*group, "_b").agg(
        *[F.expr(f"sum({e}) AS `{name}`") for name, e in sums.items()]
    )

    def position(i: int, q: float) -> str:
        return f"(_all_n{i} - 1) * CAST({float(q)!r} AS DOUBLE)"

    def ranks(i: int) -> str:
        out = []
        for j, q in enumerate(quantiles.values()):
            out.append(f"struct({2 * j} AS slot, floor({position(i, q)}) AS rank)")
            out.append(f"struct({2 * j + 1} AS slot, ceil({position(i, q)}) AS rank)")
        return f"array({', '.join(out)})"

    def hits(i: int, candidates: str) -> str:
        inside = f"t.rank >= _stop{i} - _n{i} AND t.rank < _stop{i}"
        return f"filter({candidates}, t -> {inside}) AS _hits{i}"

    carried = [f"_all{name}" for name in sums]
    quoted = [f"`{c}`" for c in carried]
    found = " OR ".join([f"size(_hits{i}) > 0" for i in every] + ["_all_n0 = 0"])
    located = (
        buckets.selectExpr(
            *group, "_b", *[f"_n{i}" for i in every],
            *[f"sum(_n{i}) OVER ({whole}ORDER BY _b {upto}) AS _stop{i}" for i in every],
            *[f"sum(`{name}`) OVER ({whole}) AS `_all{name}`" for name in sums],
        )
        .selectExpr(*group, "_b", *[f"_stop{i} - _n{i} AS _start{i}" for i in every], *[hits(i, ranks(i)) for i in every], *quoted)
        .filter(found)
    )
    counted = values.selectExpr(*group, "_b", "_v[0] AS _c", *[f"{n} AS _n{i}" for i, n in enumerate(known)])
    if reread:
        # stored, so that the join knows its size; a few rows a group
        located = materialise(located, "located-ranks")
        counted = counted.join(located.select(*group, "_b"), [*group, "_b"], "left_semi").groupBy(*group, "_b", "_c").agg(
            *[F.sum(f"_n{i}").alias(f"_n{i}") for i in every]
        )
    else:
        # values already lie by (_g, _b); only the few located buckets move to them
        located = located.hint("shuffle_hash")
    at_rank = (
        counted.join(located, [*group, "_b"])
        .selectExpr(
            "*",
            *[
                f"_start{i} + sum(_n{i}) OVER (PARTITION BY {', '.join([*group, '_b'])} ORDER BY _c {upto}) AS _stop{i}"
                for i in every
            ],
        )
        .selectExpr(*group, "_c", *[hits(i, f"_hits{i}") for i in every], *quoted)
        .filter(found)
    )
    slots = range(2 * len(quantiles))
    per_group = at_rank.groupBy(*group).agg(
        *[F.expr(f"any_value({c}) AS {c}") for c in quoted],
        *[
            F.expr(f"max(IF(exists(_hits{i}, t -> t.slot = {s}), _c, NULL)) AS _v{i}_{s}")
            for i in every
            for s in slots
        ],
    )
    out = [f"_g.`{k}` AS `{k}`" for k in keys] + [
        f"coalesce(`_all_t_{t}`, 0L) AS `{t}`" for t in tallies
    ]
    for i in every:
        out += [
            f"coalesce(_all_r{i}, 0L) AS rows_{i}",
            f"coalesce(_all_n{i}, 0L) AS value_rows_{i}",
            f"CAST(CAST(_all_s{i} AS DECIMAL(36,0)) / {10**scale} AS DECIMAL(36,{scale})) AS total_{i}",
        ]
        for j, (name, q) in enumerate(quantiles.items()):
            low, high, at = f"_v{i}_{2 * j}", f"_v{i}_{2 * j + 1}", position(i, q)
            out.append(f"{low} + ({high} - {low}) * ({at} - floor({at})) AS `{name}_{i}`")
    return per_group.selectExpr(*out)


def grouped_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float] | None = None,
    tallies: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Keys, ``rows``, ``value_rows``, ``total``, tallies and exact quantiles.

    Null keys form a group. ``total`` is null when a group has no value. Each
    quantile is the linear interpolation between its neighbouring ranks, as a
    float in minor units (cents): exact for the median. See ``money`` and
    ``as_float`` for the two roundings used downstream.
    """
    scale = _scale(df, value)
    if quantiles:
        tallied = value_tallies(df, keys, value, tallies)
        single = ranked(tallied, keys, scale, quantiles, list(tallies or {}))
        plain = ["rows", "value_rows", "total", *quantiles]
        return single.withColumnsRenamed({f"{c}_0": c for c in plain})
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("value_rows"),
        F.sum(F.col(value).cast(T.DecimalType(28, scale))).cast(T.DecimalType(36, scale)).alias("total"),
        *[F.count_if(c).alias(n) for n, c in (tallies or {}).items()],
    )


MEDIAN = {"median": 0.5}


def money(minor: str) -> Column:
    """Quantile in cents as decimal(14,2), halves away from zero."""
    return F.expr(f"CAST(CAST(round(`{minor}`) AS DECIMAL(16,0)) / 100 AS DECIMAL(14,2))")


def as_float(minor: str, scale: int = 2) -> Column:
    return F.expr(f"`{minor}` / {10**scale}D")


def _total_type(scale: int) -> str:
    return f"DECIMAL({26 + scale},{scale})"


def money_stats(df: DataFrame, keys: Sequence[str], value: str, tallies=None) -> DataFrame:
    """Mart columns: transactions, total_value, mean_price, median_price, tallies."""
    stats = grouped_stats(df, keys, value, MEDIAN, tallies)
    return stats.select(
        *keys,
        F.col("rows").alias("transactions"),
        F.col("total").cast("decimal(28,2)").alias("total_value"),
        exact_mean(F.col("total"), F.col("value_rows")).alias("mean_price"),
        money("median").alias("median_price"),
        *list(tallies or {}),
    )


def float_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Report columns: counts, total (0 for no values), unrounded mean and median."""
    return as_float_stats(grouped_stats(df, keys, value, MEDIAN), keys, _scale(df, value))


def as_float_stats(stats: DataFrame, keys: Sequence[str], scale: int) -> DataFrame:
    """``float_stats`` from the result of ``grouped_stats`` with a median."""
    return stats.select(
        *keys,
        F.col("rows").alias("transactions"),
        F.expr(f"CAST(coalesce(total, 0) AS {_total_type(scale)}) AS total_value"),
        float_mean(F.col("total"), F.col("value_rows")).alias("mean_price"),
        as_float("median", scale).alias("median_price"),
    )


def _mask_rows(tallied: DataFrame, masks: Sequence[tuple[str, str]], label: str, scale: int) -> DataFrame:
    """Statistics per mask from tallies; a mask is its label and its count in SQL.

    The masks are further weights of one pass, laid out as rows at the end. The
    counts of a mask without rows are 0, its mean and median null.
    """
    stats = ranked(tallied, [], scale, MEDIAN, weights=["_rows", *[count for _, count in masks]])
    rows = []
    for i in range(1, len(masks) + 1):
        rows.append(
            f"struct({i} AS position, rows_{i} AS transactions, "
            f"coalesce(try_divide(CAST(rows_{i} AS DOUBLE), CAST(rows_0 AS DOUBLE)) * 100D, 0D) AS transaction_share_pct, "
            f"try_divide(CAST(total_{i} AS DOUBLE), CAST(value_rows_{i} AS DOUBLE)) AS mean_price, "
            f"median_{i} / {10**scale}D AS median_price, "
            f"CAST(coalesce(total_{i}, 0) AS {_total_type(scale)}) AS total_value)"
        )
    names = F.array(*[F.lit(name) for name, _ in masks])
    return (
        stats.selectExpr(f"inline(array({', '.join(rows)}))")
        .select(
            F.element_at(names, F.col("position")).alias(label),
            "transactions", "transaction_share_pct", "mean_price", "median_price", "total_value",
            "position",
        )
        .orderBy("position")
        .drop("position")
    )


def masked_stats(
    df: DataFrame, value: str, masks: Sequence[tuple[str, Column]], label: str
) -> DataFrame:
    """Statistics per mask of rows; masks may overlap, empty masks keep a row."""
    scale = _scale(df, value)
    tallied = value_tallies(df, [], value, {str(i): mask for i, (_, mask) in enumerate(masks)})
    return _mask_rows(tallied, [(n, f"`_t_{i}`") for i, (n, _) in enumerate(masks)], label, scale)


# counts of all rows, of those below a limit, and of those at or above it
SPLIT_COUNTS = ("_rows", "IF(_c < _limit, _rows, 0L)", "IF(_c >= _limit, _rows, 0L)")


def split_at_quantile(
    df: DataFrame, value: str, quantile: float, names: tuple[str, str, str], label: str
) -> DataFrame:
    """All rows, rows below the quantile, rows at or above it, from one aggregation."""
    scale = _scale(df, value)
    tallied = value_tallies(df, [], value)
    limit = ranked(tallied, [], scale, {"limit": quantile}).selectExpr("limit_0 AS _limit")
    return _mask_rows(tallied.join(F.broadcast(limit)), list(zip(names, SPLIT_COUNTS)), label, scale)


def quantile_rows(
    df: DataFrame, value: str, quantiles: Sequence[float], with_range: bool = False
) -> DataFrame:
    """(percentile, value) rows for the whole table, optionally with min and max."""
    wanted = {quantile_label(q): q for q in quantiles}
    if with_range:
        wanted = {"min": 0.0, **wanted, "max": 1.0}
    columns = {f"q{i}": q for i, q in enumerate(wanted.values())}
    found = grouped_stats(df, [], value, columns)
    return quantile_table(found, dict(zip(wanted, columns)), value, _scale(df, value))


def quantile_table(found: DataFrame, columns: Mapping[str, str], value: str, scale: int) -> DataFrame:
    """One row of quantiles laid out as (percentile, value) rows; ``columns`` maps labels to its columns."""
    pairs = [
        f"struct({i} AS position, '{label}' AS percentile, `{column}` / {10**scale}D AS `{value}`)"
        for i, (label, column) in enumerate(columns.items())
    ]
    return found.selectExpr(f"inline(array({', '.join(pairs)}))").orderBy("position").drop("position")


def histogram(df: DataFrame, value: str, bins: int = 50, upto_quantile: float = 0.99) -> DataFrame:
    """Equal-width bins over the values up to a quantile; the top edge is closed.

    Limit, edges and bins each need the tallies, with other columns and filters,
    so the tallies are written once instead of scanning the table three times.
    """
    scale = _scale(df, value)
    tallied = materialise(value_tallies(df, [], value), "value-tallies")
    limit = ranked(tallied, [], scale, {"limit": upto_quantile}).selectExpr("limit_0 AS _limit")
    return histogram_rows(tallied, limit, bins, scale)


def histogram_rows(tallied: DataFrame, limit: DataFrame, bins: int, scale: int) -> DataFrame:
    """Bins of the tallied values up to the one row of ``limit`` (_limit, in smallest units)."""
    kept = tallied.join(F.broadcast(limit)).filter("_c <= _limit").select("_c", "_rows")
    edges = kept.selectExpr("min(_c) AS _lo", f"(max(_c) - min(_c)) / {bins}D AS _width").filter(
        "_lo IS NOT NULL"
    )
    slot = f"least(coalesce(floor(try_divide(CAST(_c - _lo AS DOUBLE), _width)), 0L), {bins - 1}L)"
    counted = (
        kept.join(F.broadcast(edges))
        .groupBy(F.expr(f"{slot} AS id"))
        .agg(F.sum("_rows").alias("transactions"))
    )
    return (
        tallied.sparkSession.range(bins)
        .join(F.broadcast(edges))
        .join(counted, "id", "left")
        .selectExpr(
            "CAST(id + 1 AS INT) AS bin",
            f"(_lo + id * _width) / {10**scale}D AS bin_start",
            f"(_lo + (id + 1) * _width) / {10**scale}D AS bin_end",
            "coalesce(transactions, 0L) AS transactions",
        )
        .orderBy("bin")
    )
