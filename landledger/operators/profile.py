"""Ingest validation and profiling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions.dates import parse_sale_date
from landledger.functions.numbers import holds_price, ratio_pct


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("dataset contains no rows")
    return df


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _null_counts(df: DataFrame) -> DataFrame:
    """(column, missing_count, row_count) rows, from one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(_quoted(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("missing_count"))
        for i, c in enumerate(df.columns)
    ]
    return counted.select("row_count", F.inline(F.array(*pairs)))


def missing_counts(df: DataFrame) -> DataFrame:
    return _null_counts(df).select("column", "missing_count")


def missing_summary(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Null count and percentage per column, most missing first."""
    return _as_missing(_null_counts(df), digits)


def missing_rows(counted: DataFrame, columns: Mapping[str, str], rows: str, digits: int | None = None) -> DataFrame:
    """``missing_summary`` from one row of counts; ``columns`` maps columns to their counts, ``rows`` is the count of rows."""
    pairs = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(n), F.lit(0)).alias("missing_count")) for c, n in columns.items()]
    return _as_missing(counted.select(F.col(rows).alias("row_count"), F.inline(F.array(*pairs))), digits)


def _as_missing(counted: DataFrame, digits: int | None) -> DataFrame:
    return counted.select(
        "column",
        "missing_count",
        ratio_pct("missing_count", "row_count", digits).alias("missing_percentage"),
    ).orderBy(F.desc("missing_count"), "column")


def _copies(df: DataFrame) -> DataFrame:
    # partial aggregation folds copies before the shuffle, so no group of copies is hot
    return df.groupBy(*[_quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows before, distinct rows and surplus copies."""
    return _copies(df).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("unique_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_rows(df: DataFrame, limit: int = 10) -> DataFrame:
    """First ``limit`` members of the groups of equal rows, in column order.

    Members of a group are equal, so each is repeated from the counted row.
    """
    repeated = F.sequence(F.lit(1), F.least(F.col("_copies"), F.lit(limit)).cast("int"))
    return (
        _copies(df)
        .filter(F.col("_copies") > 1)
        .orderBy(*[_quoted(c).asc_nulls_last() for c in df.columns])
        .limit(limit)
        .withColumn("_member", F.explode(repeated))
        .orderBy(*[_quoted(c).asc_nulls_last() for c in df.columns])
        .limit(limit)
        .select(*[_quoted(c) for c in df.columns])
    )


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def invalid_dates(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(parse_sale_date(_quoted(column)).isNull()).alias("invalid_dates"))


def invalid_prices(df: DataFrame, column: str) -> DataFrame:
    """Cells without a readable price; a number too large to be held counts as one."""
    return df.agg(F.count_if(~holds_price(_quoted(column))).alias("invalid_prices"))


def value_counts(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    if not keep_null:
        df = df.filter(_quoted(column).isNotNull())
    return (
        df.groupBy(_quoted(column))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), _quoted(column).asc_nulls_last())
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("minimum"), F.max(column).alias("maximum"))


def classification_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    a, b = F.coalesce(F.col(first), F.lit(False)), F.coalesce(F.col(second), F.lit(False))
    return df.agg(
        F.count_if(a).alias("new_properties"),
        F.count_if(b).alias("second_hand_properties"),
        F.count_if(~a & ~b).alias("neither"),
        F.count_if(a & b).alias("both"),
    )


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) rows; ``rows`` counts the table itself."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in rules.items()],
    )
    names = ["rows", *rules]
    return counted.select(
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names])
        )
    )


def guard(df: DataFrame, rules: Mapping[str, Column], allow_empty: bool = False) -> DataFrame:
    """Raise when a row breaks a rule or the table is empty; one small result on the driver."""
    if not df.columns:
        raise ValueError("dataset contains no columns")
    found = {r["rule"]: r["violations"] for r in violation_counts(df, rules).collect()}
    if not allow_empty and found.pop("rows") == 0:
        raise ValueError("dataset is empty")
    broken = {rule: n for rule, n in found.items() if n and rule != "rows"}
    if broken:
        raise ValueError(f"dataset breaks rules: {broken}")
    return df


def guarded(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The same rows of an aggregate; a row that breaks a rule raises.

    The rules are part of the plan, so nothing is evaluated twice. They sit in a
    filter, which column pruning keeps.
    """
    sound = F.lit(True)
    for rule, bad in rules.items():
        message = F.lit(f"dataset breaks rule: {rule}")
        sound = sound & F.when(F.coalesce(bad, F.lit(False)), F.raise_error(message).cast("boolean")).otherwise(True)
    return df.filter(sound)


def checked(c: Column | str, rules: Mapping[str, Column]) -> Column:
    """The column's value; a row that breaks a rule raises when the column is read.

    A part of the projection, not a filter: the optimizer would move a filter below the
    projections that parse the column and put their expressions in its place.
    """
    value = F.col(c) if isinstance(c, str) else c
    for rule, bad in rules.items():
        message = F.lit(f"dataset breaks rule: {rule}")
        value = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(message)).otherwise(value)
    return value


def index_profile(df: DataFrame, month: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
    )
