"""Report analyses over the marts.

Years are parameters: months of ``partial_year`` are reported apart, and the
latest completed year is taken from the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landledger.functions.dates import period_label
from landledger.functions.numbers import float_mean, plain_number, ratio_pct, round_even
from landledger.operators.series import correlation_table, growth_pct, top_rows
from landledger.storage import materialise, run_together


@dataclass(frozen=True)
class Years:
    partial: int
    baseline: int


@dataclass
class Marts:
    monthly: DataFrame
    county: DataFrame
    planning: DataFrame

    def written(self) -> Marts:
        """The marts as written tables, so that many reports share one build."""
        tables = {"monthly": self.monthly, "county": self.county, "planning": self.planning}
        jobs = [lambda n=n, df=df: materialise(df, n) for n, df in tables.items()]
        return Marts(*run_together(jobs))


MARKET_METRICS = ["transactions", "mean_price", "median_price", "national_rppi"]
PLANNING_METRICS = [
    "applications",
    "granted_applications",
    "refused_applications",
    "residential_units",
]


def mean_of(c: str) -> Column:
    """Unweighted float mean of a decimal column, the same in any row order."""
    return float_mean(F.sum(F.col(c).cast("decimal(28,2)")), F.count(c))


def total_of(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def money_total(c: str) -> Column:
    return total_of(c).cast("decimal(28,2)")


def by_year(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("year", F.year("month_start"))


def annual_market_summary(monthly: DataFrame, years: Years) -> DataFrame:
    """Completed years: sums, and means of the monthly values."""
    return (
        by_year(monthly)
        .filter(F.col("year") < years.partial)
        .groupBy("year")
        .agg(
            F.lit("Full Year").alias("period"),
            total_of("transactions").alias("transactions"),
            money_total("total_value").alias("total_value"),
            round_even(mean_of("mean_price"), 2).alias("avg_monthly_mean_price"),
            round_even(mean_of("median_price"), 2).alias("avg_monthly_median_price"),
            round_even(mean_of("national_rppi"), 2).alias("avg_rppi"),
        )
        .orderBy("year")
    )


def market_ytd(monthly: DataFrame, years: Years) -> DataFrame:
    """Exactly one row for the partial year, "No data" when it has no month."""
    return (
        by_year(monthly)
        .filter(F.col("year") == years.partial)
        .agg(
            F.lit(years.partial).alias("year"),
            period_label(F.max("month_start")).alias("period"),
            total_of("transactions").alias("transactions"),
            money_total("total_value").alias("total_value"),
            round_even(mean_of("mean_price"), 2).alias("avg_monthly_mean_price"),
            round_even(mean_of("median_price"), 2).alias("avg_monthly_median_price"),
            round_even(mean_of("national_rppi"), 2).alias("avg_rppi"),
        )
    )


def price_growth(monthly: DataFrame, years: Years) -> DataFrame:
    """Annual averages and their growth; growth uses the unrounded averages."""
    averages = {"avg_mean_price": "mean_price", "avg_median_price": "median_price", "avg_rppi": "national_rppi"}
    growth = {
        "avg_mean_price": "mean_price_yoy_pct",
        "avg_median_price": "median_price_yoy_pct",
        "avg_rppi": "rppi_yoy_pct",
    }
    annual = (
        by_year(monthly)
        .filter(F.col("year") < years.partial)
        .groupBy("year")
        .agg(*[mean_of(source).alias(name) for name, source in averages.items()])
    )
    grown = growth_pct(annual, growth, ["year"], digits=2)
    return grown.withColumns({c: round_even(c, 2) for c in averages}).orderBy("year")


def latest_completed(df: DataFrame, year: str, years: Years) -> DataFrame:
    """Rows of the latest year before the partial one.

    The year is a one-row aggregate joined back, so nothing visits the driver.
    The table is read twice: pass a stored mart, not its whole build.
    """
    last = df.filter(F.col(year) < years.partial).agg(F.max(year).alias("_last")).select(_known_year("_last"))
    return df.join(F.broadcast(last), F.col(year) == F.col("_last")).drop("_last")


def _known_year(column: str) -> Column:
    """The year of a one-row aggregate; raises where there is no completed year."""
    none = F.raise_error(F.lit("no completed year available")).cast("int")
    return F.coalesce(F.col(column), none).alias(column)


def county_market_latest(county: DataFrame, years: Years) -> DataFrame:
    kept = county.dropna(subset=["county", "sale_year"])
    return latest_completed(kept, "sale_year", years).orderBy(F.desc("transactions"), "county")


def latest_year(df: DataFrame, year: Column, years: Years) -> int:
    """Latest completed year as a number on the driver."""
    found = df.agg(F.max(F.when(year < years.partial, year))).first()[0]
    if found is None:
        raise ValueError("no completed year available")
    return found


def comparison_year(county: DataFrame, years: Years) -> int:
    """Latest completed year of a stored county mart, needed for column names."""
    return latest_year(county.dropna(subset=["county"]), F.col("sale_year"), years)


def county_price_change(county: DataFrame, years: Years, latest: int | None = None) -> DataFrame:
    """Mean price of the baseline and the latest completed year, change in %.

    Empty when either year is absent from the whole table.
    """
    latest = latest or comparison_year(county, years)
    base_col, last_col = f"mean_price_{years.baseline}", f"mean_price_{latest}"
    pivoted = (
        county.dropna(subset=["county", "sale_year"])
        .filter(F.col("sale_year").isin(years.baseline, latest) & F.col("mean_price").isNotNull())
        .groupBy("county")
        .pivot("sale_year", [years.baseline, latest])
        .agg(F.first("mean_price", ignorenulls=True))
        .withColumnsRenamed({str(years.baseline): base_col, str(latest): last_col})
    )
    base, last = F.col(base_col), F.col(last_col)
    present = pivoted.agg(
        ((F.count(base_col) > 0) & (F.count(last_col) > 0)).alias("_both")
    )
    return (
        pivoted.join(F.broadcast(present), F.col("_both"))
        .select("county", base_col, last_col, ratio_pct(last - base, base).alias("price_change_pct"))
        .orderBy(F.col("price_change_pct").desc_nulls_last(), "county")
    )


def county_property_mix(county_latest: DataFrame) -> DataFrame:
    """New and second-hand shares of the classified transactions."""
    new, old = "new_property_transactions", "second_hand_property_transactions"
    total = F.coalesce(F.col(new), F.lit(0)) + F.coalesce(F.col(old), F.lit(0))
    return county_latest.select(
        "county",
        "sale_year",
        new,
        old,
        total.alias("total_classified_transactions"),
        ratio_pct(new, total).alias("new_property_share_pct"),
        ratio_pct(old, total).alias("second_hand_property_share_pct"),
    )


def _planning_sums(planning: DataFrame, key: str) -> DataFrame:
    return planning.groupBy(key).agg(
        total_of("applications").alias("applications"),
        total_of("granted_applications").alias("granted_applications"),
        total_of("refused_applications").alias("refused_applications"),
        total_of("residential_units").cast("double").alias("residential_units"),
    )


def _with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "grant_rate_pct": ratio_pct("granted_applications", "applications"),
            "refusal_rate_pct": ratio_pct("refused_applications", "applications"),
        }
    )


def annual_planning(planning: DataFrame, years: Years) -> DataFrame:
    completed = by_year(planning).filter(F.col("year") < years.partial)
    return _with_rates(_planning_sums(completed, "year")).orderBy("year")


def planning_authority_latest(planning: DataFrame, years: Years) -> DataFrame:
    kept = latest_completed(by_year(planning), "year", years).filter(
        F.col("planning_authority").isNotNull()
    )
    return _with_rates(_planning_sums(kept, "planning_authority")).orderBy(
        F.desc("applications"), "planning_authority"
    )


def national_planning(planning: DataFrame) -> DataFrame:
    return _planning_sums(planning.filter(F.col("month_start").isNotNull()), "month_start")


def market_with_planning(monthly: DataFrame, planning: DataFrame) -> DataFrame:
    """National market joined with national planning on common months."""
    return monthly.select("month_start", *MARKET_METRICS).join(
        national_planning(planning), "month_start"
    )


def market_planning_correlation(monthly: DataFrame, planning: DataFrame) -> DataFrame:
    """Pearson r of every market / planning metric pair over common months.

    No common month, or fewer than three complete ones, raises; both are counted
    by the aggregation that gives the correlations.
    """
    merged = market_with_planning(monthly, planning)
    cells = F.array(*[F.col(c).isNull() for c in MARKET_METRICS + PLANNING_METRICS])
    rules = {
        "no common months between market and planning": F.count(F.lit(1)) == 0,
        "fewer than three complete months for correlation": F.count_if(~F.array_contains(cells, True)) < 3,
    }
    return correlation_table(merged, MARKET_METRICS, PLANNING_METRICS, "month_start", rules=rules)


def key_kpis(marts: Marts, years: Years) -> DataFrame:
    """Twelve (kpi, value, unit) rows; each mart is read once and never collected."""
    market = by_year(marts.monthly)
    last_year = F.max(F.when(F.col("year") < years.partial, F.col("year")))
    per_year = market.groupBy("year").agg(
        total_of("transactions").alias("transactions"),
        money_total("total_value").alias("total_value"),
        mean_of("mean_price").alias("mean_price"),
        mean_of("median_price").alias("median_price"),
        mean_of("national_rppi").alias("rppi"),
        F.max("month_start").alias("last_month"),
    )
    figures = F.struct("transactions", "total_value", "mean_price", "median_price", "rppi", "last_month")
    completed = F.when(F.col("year") < years.partial, F.col("year"))
    partial = F.when(F.col("year") == years.partial, figures)
    head = per_year.agg(
        last_year.alias("_my"),
        F.max_by(figures, completed).alias("m"),
        F.max(partial).alias("y"),
    ).select(_known_year("_my").alias("my"), "m", "y")
    # counties are ranked in every year; the latest completed market year picks one
    best = (
        marts.county.dropna(subset=["county", "sale_year"])
        .filter(F.col("sale_year") < years.partial)
        .groupBy("sale_year")
        .agg(*_leaders())
    )
    plans = (
        by_year(marts.planning)
        .filter(F.col("year") < years.partial)
        .groupBy("year")
        .agg(
            total_of("applications").alias("applications"),
            total_of("residential_units").cast("double").alias("units"),
        )
        .agg(
            F.max("year").alias("py"),
            F.max_by("applications", "year").alias("applications"),
            F.max_by("units", "year").alias("units"),
        )
    )

    def count_text(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast("string")

    def number(c: Column) -> Column:
        return plain_number(round_even(c, 2))

    my, ytd, py = F.col("my").cast("string"), str(years.partial), F.coalesce(F.col("py").cast("string"), F.lit("None"))
    rows = [
        (F.concat(my, F.lit(" Transactions")), count_text(F.col("m.transactions")), "transactions"),
        (F.concat(my, F.lit(" Total Transaction Value")), plain_number(F.col("m.total_value")), "EUR"),
        (F.concat(my, F.lit(" Average Monthly Mean Price")), number(F.col("m.mean_price")), "EUR"),
        (F.concat(my, F.lit(" Average Monthly Median Price")), number(F.col("m.median_price")), "EUR"),
        (F.concat(my, F.lit(" Average RPPI")), number(F.col("m.rppi")), "index"),
        (F.lit(f"{ytd} YTD Transactions"), count_text(F.col("y.transactions")), "transactions"),
        (F.lit(f"{ytd} YTD Average Monthly Mean Price"), number(F.col("y.mean_price")), "EUR"),
        (F.lit(f"{ytd} YTD Period"), period_label(F.col("y.last_month")), "period"),
        (F.concat(F.lit("Highest Transaction Volume County "), my), F.col("highest_transactions"), "county"),
        (F.concat(F.lit("Highest Average Price County "), my), F.col("highest_mean_price"), "county"),
        (F.concat(py, F.lit(" Planning Applications")), count_text(F.col("applications")), "applications"),
        (
            F.concat(py, F.lit(" Residential Units in Applications")),
            F.when(F.col("py").isNull(), F.lit("0")).otherwise(number(F.col("units"))),
            "units",
        ),
    ]
    table = F.array(
        *[F.struct(k.alias("kpi"), v.alias("value"), F.lit(u).alias("unit")) for k, v, u in rows]
    )
    one = F.lit(True)
    return (
        head.join(best, F.col("my") == F.col("sale_year"), "left")
        .join(F.broadcast(plans), one, "left")
        .select(F.inline(table))
    )


def _leaders() -> list[Column]:
    def best(metric: str) -> Column:
        rank = F.struct(-F.col(metric), F.col("county"))
        return F.min_by("county", F.when(F.col(metric).isNotNull(), rank)).alias(f"highest_{metric}")

    return [best("transactions"), best("mean_price")]


def argmax_rows(county_latest: DataFrame) -> DataFrame:
    """County with most transactions and with the highest mean price; ties by name."""
    return county_latest.agg(*_leaders())


def top_counties(county_latest: DataFrame, price_change: DataFrame, n: int = 5) -> DataFrame:
    """Top counties by transactions, mean price and price change."""
    parts = []
    for ranking, df, metric in (
        ("transactions", county_latest, "transactions"),
        ("mean_price", county_latest, "mean_price"),
        ("price_change_pct", price_change, "price_change_pct"),
    ):
        parts.append(
            top_rows(df, ["county", metric], metric, n, ["county"]).select(
                F.lit(ranking).alias("ranking"), "county", F.col(metric).cast("double").alias("value")
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def source_coverage(marts: Marts) -> DataFrame:
    """First and last period and row count of each mart."""
    parts = []
    for name, df, lowest, highest in (
        ("monthly_market", marts.monthly, F.date_format(F.min("month_start"), "yyyy-MM"), F.date_format(F.max("month_start"), "yyyy-MM")),
        ("county_market", marts.county, F.min("sale_year").cast("string"), F.max("sale_year").cast("string")),
        ("planning_activity", marts.planning, F.date_format(F.min("month_start"), "yyyy-MM"), F.date_format(F.max("month_start"), "yyyy-MM")),
    ):
        parts.append(
            df.agg(
                F.lit(name).alias("mart"),
                lowest.alias("first_period"),
                highest.alias("last_period"),
                F.count(F.lit(1)).alias("row_count"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def all_reports(marts: Marts, years: Years) -> dict[str, DataFrame]:
    """The ten report tables by name."""
    county_latest = county_market_latest(marts.county, years)
    return {
        "annual_market": annual_market_summary(marts.monthly, years),
        "market_ytd": market_ytd(marts.monthly, years),
        "price_growth": price_growth(marts.monthly, years),
        "county_market": county_latest,
        "county_price_change": county_price_change(marts.county, years),
        "county_property_mix": county_property_mix(county_latest),
        "annual_planning": annual_planning(marts.planning, years),
        "planning_authority": planning_authority_latest(marts.planning, years),
        "market_planning_correlation": market_planning_correlation(marts.monthly, marts.planning),
        "key_kpis": key_kpis(marts, years),
    }
