"""Typed tables to the four marts, and the combined cleaned-file table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.functions.dates import month_start, year_month
from landledger.functions.numbers import as_price
from landledger.functions.text import contains_any
from landledger.operators.grouped_stats import float_stats, money_stats
from landledger.operators.profile import checked

# The published national series.
NATIONAL_SERIES = "National - all residential properties"
NATIONAL_UNIT = "Base 2015=100"


def national_index(
    ix: DataFrame, series: str = NATIONAL_SERIES, unit: str = NATIONAL_UNIT
) -> DataFrame:
    return ix.filter((F.col("property_series") == series) & (F.col("unit") == unit)).select(
        "year_month", F.col("rppi_value").alias("national_rppi")
    )


def monthly_market(
    tx: DataFrame, ix: DataFrame, series: str = NATIONAL_SERIES, unit: str = NATIONAL_UNIT
) -> DataFrame:
    """Monthly counts, totals, mean and median with the national index.

    The index side has one row per month; adaptive execution broadcasts it from
    its measured size.
    """
    by_month = money_stats(
        tx.select(
            F.col("sale_year_month").alias("year_month"),
            month_start("sale_date").alias("month_start"),
            "price_eur",
        ),
        ["year_month", "month_start"],
        "price_eur",
    )
    return by_month.join(national_index(ix, series, unit), "year_month", "left").select(
        "year_month",
        "month_start",
        "transactions",
        "total_value",
        "mean_price",
        "median_price",
        F.col("national_rppi").cast("decimal(10,2)").alias("national_rppi"),
    )


def county_market(tx: DataFrame) -> DataFrame:
    return money_stats(
        tx,
        ["county", "sale_year"],
        "price_eur",
        {
            "new_property_transactions": F.col("is_new_property"),
            "second_hand_property_transactions": F.col("is_second_hand_property"),
        },
    )


def planning_activity(pl: DataFrame) -> DataFrame:
    """Monthly planning counts per authority; an application may count in both outcomes."""
    granted = contains_any("decision", "grant", "conditional")
    return (
        pl.filter(F.col("received_date").isNotNull())
        .groupBy(
            "planning_authority",
            year_month("received_date").alias("year_month"),
            month_start("received_date").alias("month_start"),
        )
        .agg(
            F.count(F.lit(1)).alias("applications"),
            F.count_if(granted).alias("granted_applications"),
            F.count_if(contains_any("decision", "refus")).alias("refused_applications"),
            F.sum(F.col("num_residential_units").cast("decimal(28,10)"))
            .cast("decimal(14,2)")
            .alias("residential_units"),
        )
    )


def _metrics(df: DataFrame, rows: Sequence[tuple[str, object, object]]) -> DataFrame:
    """One (metric_name, metric_value, metric_text) row per entry of a one-row table."""
    pairs = [
        F.struct(
            F.lit(name).alias("metric_name"),
            (F.lit(None) if value is None else value).cast("decimal(28,2)").alias("metric_value"),
            (F.lit(None) if text is None else text).cast("string").alias("metric_text"),
        )
        for name, value, text in rows
    ]
    return df.select(F.inline(F.array(*pairs)))


def property_market_summary(tx: DataFrame, ix: DataFrame, pl: DataFrame) -> DataFrame:
    """Six headline metrics; each table is scanned once."""
    sold = tx.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("price_eur").cast("decimal(28,2)")).alias("total"),
        F.min("sale_date").alias("first"),
        F.max("sale_date").alias("last"),
    )
    rows = _metrics(
        sold,
        [
            ("ppr_transactions", F.col("n"), None),
            ("ppr_total_value_eur", F.col("total"), None),
            ("ppr_start_date", None, F.col("first")),
            ("ppr_end_date", None, F.col("last")),
        ],
    )
    count = F.count(F.lit(1)).alias("n")
    rows = rows.unionByName(_metrics(ix.agg(count), [("rppi_rows", F.col("n"), None)]))
    return rows.unionByName(_metrics(pl.agg(count), [("planning_applications", F.col("n"), None)]))


def combined_tx_index(
    tx: DataFrame, ix: DataFrame, series: str = NATIONAL_SERIES, unit: str = NATIONAL_UNIT
) -> DataFrame:
    """Monthly statistics from the cleaned tables as floats, with the index.

    Prices enter unrounded, with up to six decimals; one with more raises. A row without a sale date raises: its month is not known.
    """
    dated = checked("sale_date", {"invalid sale dates": F.col("sale_date").isNull()})
    by_month = float_stats(
        tx.select(year_month(dated).alias("year_month"), as_price("price_eur").alias("price_eur")),
        ["year_month"],
        "price_eur",
    )
    index = national_index(ix, series, unit).withColumn(
        "national_rppi", F.col("national_rppi").cast("double")
    )
    return by_month.join(index, "year_month", "left").orderBy("year_month")


def combined_summary(combined: DataFrame) -> DataFrame:
    return combined.agg(
        F.count(F.lit(1)).alias("monthly_observations"),
        F.min("year_month").alias("first_month"),
        F.max("year_month").alias("last_month"),
        F.count_if(F.col("national_rppi").isNull()).alias("missing_index_months"),
    )
