"""Marts, combined table and the ten reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import bindings as b
from catalogue.bindings import YEARS
from catalogue.registry import cte, query
from landledger.plans import marts, reports

MONTHLY_COLUMNS = "year_month, month_start, transactions, total_value, mean_price, median_price, national_rppi"


@query("monthly_market", f"SELECT {MONTHLY_COLUMNS} FROM b_monthly")
def monthly_market(spark, d):
    return b.monthly(spark, d)


@query("county_market", "SELECT * FROM b_county")
def county_market(spark, d):
    return b.county(spark, d)


@query("planning_activity", "SELECT * FROM b_planning")
def planning_activity(spark, d):
    return b.planning(spark, d)


cte(
    "b_summary",
    """SELECT 'ppr_transactions' AS metric_name, CAST(count(*) AS DECIMAL(28,2)) AS metric_value,
      CAST(NULL AS VARCHAR) AS metric_text FROM b_tx
    UNION ALL SELECT 'ppr_total_value_eur', CAST(sum(price_eur) AS DECIMAL(28,2)), NULL FROM b_tx
    UNION ALL SELECT 'ppr_start_date', NULL, CAST(min(sale_date) AS VARCHAR) FROM b_tx
    UNION ALL SELECT 'ppr_end_date', NULL, CAST(max(sale_date) AS VARCHAR) FROM b_tx
    UNION ALL SELECT 'rppi_rows', CAST(count(*) AS DECIMAL(28,2)), NULL FROM b_ix
    UNION ALL SELECT 'planning_applications', CAST(count(*) AS DECIMAL(28,2)), NULL FROM b_pl""",
)


def summary_mart(spark, d):
    return marts.property_market_summary(
        b.tx(spark, d, "sale_date", "price_eur"), b.ix(spark, d), b.pl(spark, d)
    )


@query("property_market_summary", "SELECT * FROM b_summary")
def property_market_summary(spark, d):
    return summary_mart(spark, d)


query("union_all_metrics", "SELECT * FROM b_summary")(summary_mart)

cte(
    "b_combined",
    f"""SELECT t.*, CAST(i.rppi_value AS DOUBLE) AS national_rppi FROM (
      SELECT strftime(sale_date, '%Y-%m') AS year_month, count(*) AS transactions,
        CAST(sum(price_eur) AS DECIMAL(28,2)) AS total_value, {b.FLOAT_MEAN} AS mean_price,
        {b.FLOAT_MEDIAN} AS median_price FROM b_tx GROUP BY 1) t
    LEFT JOIN (SELECT year_month, rppi_value FROM b_ix WHERE property_series = 'ALL'
      AND unit = 'Base 1995=100') i USING (year_month)""",
)


def combined(spark, d):
    return marts.combined_tx_index(
        b.tx(spark, d, "sale_date", "price_eur"), b.ix(spark, d), b.SERIES, b.UNIT
    )


@query(
    "combined_tx_index",
    """SELECT year_month, transactions, total_value, round_even(mean_price * 10000, 0) / 10000 AS mean_price,
    median_price, national_rppi FROM b_combined""",
)
def combined_tx_index(spark, d):
    # four decimals for the comparison only
    from landledger.functions.numbers import round_even

    return combined(spark, d).withColumns(
        {"mean_price": round_even("mean_price", 4), "total_value": F.col("total_value").cast("decimal(28,2)")}
    )


@query(
    "combined_summary",
    """SELECT count(*) AS monthly_observations, min(year_month) AS first_month,
    max(year_month) AS last_month, count(*) FILTER (WHERE national_rppi IS NULL) AS missing_index_months
    FROM b_combined""",
)
def combined_summary(spark, d):
    return marts.combined_summary(combined(spark, d))


# ---- reports ---------------------------------------------------------------
def _r2(expr: str, digits: int = 2) -> str:
    scale = 10**digits
    return f"(round_even(({expr}) * {scale}.0::DOUBLE, 0) / {scale}.0::DOUBLE)"


def _avg(col: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE) / nullif(count({col}), 0)"


P, B0 = YEARS.partial, YEARS.baseline
_ANNUAL = f"""CAST(sum(transactions) AS BIGINT) AS transactions,
    CAST(sum(total_value) AS DECIMAL(28,2)) AS total_value,
    {_r2(_avg('mean_price'))} AS avg_monthly_mean_price,
    {_r2(_avg('median_price'))} AS avg_monthly_median_price, {_r2(_avg('national_rppi'))} AS avg_rppi"""

cte(
    "b_annual",
    f"""SELECT CAST(year(month_start) AS INTEGER) AS year, 'Full Year' AS period, {_ANNUAL}
    FROM b_monthly WHERE year(month_start) < {P} GROUP BY 1""",
)
cte(
    "b_ytd",
    f"""SELECT {P} AS year, coalesce('January-' || monthname(max(month_start)), 'No data') AS period,
    CAST(coalesce(sum(transactions), 0) AS BIGINT) AS transactions,
    CAST(coalesce(sum(total_value), 0) AS DECIMAL(28,2)) AS total_value,
    {_r2(_avg('mean_price'))} AS avg_monthly_mean_price,
    {_r2(_avg('median_price'))} AS avg_monthly_median_price, {_r2(_avg('national_rppi'))} AS avg_rppi
    FROM b_monthly WHERE year(month_start) = {P}""",
)
cte(
    "b_growth",
    f"""SELECT year, {_r2('am')} AS avg_mean_price, {_r2('ad')} AS avg_median_price, {_r2('ar')} AS avg_rppi,
    {_r2('(am / lag(am) OVER (ORDER BY year) - 1) * 100')} AS mean_price_yoy_pct,
    {_r2('(ad / lag(ad) OVER (ORDER BY year) - 1) * 100')} AS median_price_yoy_pct,
    {_r2('(ar / lag(ar) OVER (ORDER BY year) - 1) * 100')} AS rppi_yoy_pct
    FROM (SELECT CAST(year(month_start) AS INTEGER) AS year, {_avg('mean_price')} AS am,
      {_avg('median_price')} AS ad, {_avg('national_rppi')} AS ar FROM b_monthly
      WHERE year(month_start) < {P} GROUP BY 1)""",
)
cte(
    "b_county_latest",
    f"""SELECT * FROM b_county WHERE county IS NOT NULL AND sale_year =
    (SELECT max(sale_year) FROM b_county WHERE sale_year < {P} AND county IS NOT NULL)""",
)
LATEST = 2000
cte(
    "b_change",
    f"""SELECT county, b AS mean_price_{B0}, l AS mean_price_{LATEST},
    {_r2('CAST(l - b AS DOUBLE) / nullif(CAST(b AS DOUBLE), 0) * 100')} AS price_change_pct
    FROM (SELECT county, max(mean_price) FILTER (WHERE sale_year = {B0}) AS b,
      max(mean_price) FILTER (WHERE sale_year = {LATEST}) AS l
      FROM b_county WHERE sale_year IN ({B0}, {LATEST}) AND county IS NOT NULL GROUP BY county)""",
)
cte(
    "b_mix",
    f"""SELECT county, sale_year, new_property_transactions, second_hand_property_transactions,
    tot AS total_classified_transactions,
    {_r2('CAST(new_property_transactions AS DOUBLE) / nullif(tot, 0) * 100')} AS new_property_share_pct,
    {_r2('CAST(second_hand_property_transactions AS DOUBLE) / nullif(tot, 0) * 100')} AS second_hand_property_share_pct
    FROM (SELECT *, new_property_transactions + second_hand_property_transactions AS tot FROM b_county_latest)""",
)
_PLAN = f"""CAST(sum(applications) AS BIGINT) AS applications,
    CAST(sum(granted_applications) AS BIGINT) AS granted_applications,
    CAST(sum(refused_applications) AS BIGINT) AS refused_applications,
    CAST(coalesce(sum(residential_units), 0) AS DOUBLE) AS residential_units,
    {_r2('CAST(sum(granted_applications) AS DOUBLE) / nullif(sum(applications), 0) * 100')} AS grant_rate_pct,
    {_r2('CAST(sum(refused_applications) AS DOUBLE) / nullif(sum(applications), 0) * 100')} AS refusal_rate_pct"""
cte(
    "b_annual_planning",
    f"""SELECT CAST(year(month_start) AS INTEGER) AS year, {_PLAN} FROM b_planning
    WHERE year(month_start) < {P} GROUP BY 1""",
)
cte(
    "b_authority",
    f"""SELECT planning_authority, {_PLAN} FROM b_planning WHERE planning_authority IS NOT NULL AND
    year(month_start) = (SELECT max(year(month_start)) FROM b_planning WHERE year(month_start) < {P})
    GROUP BY 1""",
)
cte(
    "b_merged",
    """SELECT m.*, p.* EXCLUDE (month_start) FROM b_monthly m JOIN (
      SELECT month_start, CAST(sum(applications) AS DOUBLE) AS applications,
        CAST(sum(granted_applications) AS DOUBLE) AS granted_applications,
        CAST(sum(refused_applications) AS DOUBLE) AS refused_applications,
        CAST(coalesce(sum(residential_units), 0) AS DOUBLE) AS residential_units
      FROM b_planning GROUP BY 1) p USING (month_start)""",
)
_PAIRS = " UNION ALL ".join(
    f"""SELECT '{m}' AS market_metric, '{p}' AS planning_metric,
    {_r2(f"CASE WHEN regr_count(CAST({p} AS DOUBLE), CAST({m} AS DOUBLE)) >= 3 THEN corr(CAST({p} AS DOUBLE), CAST({m} AS DOUBLE)) END", 4)} AS pearson_correlation,
    CAST(regr_count(CAST({p} AS DOUBLE), CAST({m} AS DOUBLE)) AS BIGINT) AS observations,
    min(month_start) AS period_start, max(month_start) AS period_end FROM b_merged"""
    for m in reports.MARKET_METRICS
    for p in reports.PLANNING_METRICS
)
cte("b_corr", _PAIRS)


def _text(expr: str) -> str:
    # two decimals without the last zero, as 34248.0 or 476976.59
    return f"regexp_replace(CAST(CAST({expr} AS DECIMAL(38,2)) AS VARCHAR), '0$', '')"


cte(
    "b_market_years",
    f"""SELECT year(month_start) AS y, sum(transactions) AS n, sum(total_value) AS v,
    {_avg('mean_price')} AS mp, {_avg('median_price')} AS md, {_avg('national_rppi')} AS ix,
    max(month_start) AS last_month FROM b_monthly GROUP BY 1""",
)
cte(
    "b_plan_years",
    f"""SELECT year(month_start) AS y, sum(applications) AS n, coalesce(sum(residential_units), 0) AS u
    FROM b_planning WHERE year(month_start) < {P} GROUP BY 1""",
)
cte("b_ml", f"SELECT * FROM b_market_years WHERE y < {P} ORDER BY y DESC LIMIT 1")
cte("b_plast", "SELECT * FROM b_plan_years ORDER BY y DESC LIMIT 1")
cte("b_yt", f"SELECT * FROM b_market_years WHERE y = {P}")
cte(
    "b_kpi",
    f"""SELECT y || ' Transactions' AS kpi, CAST(n AS VARCHAR) AS value, 'transactions' AS unit FROM b_ml
    UNION ALL SELECT y || ' Total Transaction Value', {_text('v')}, 'EUR' FROM b_ml
    UNION ALL SELECT y || ' Average Monthly Mean Price', {_text(_r2('mp'))}, 'EUR' FROM b_ml
    UNION ALL SELECT y || ' Average Monthly Median Price', {_text(_r2('md'))}, 'EUR' FROM b_ml
    UNION ALL SELECT y || ' Average RPPI', {_text(_r2('ix'))}, 'index' FROM b_ml
    UNION ALL SELECT '{P} YTD Transactions', CAST(n AS VARCHAR), 'transactions' FROM b_yt
    UNION ALL SELECT '{P} YTD Average Monthly Mean Price', {_text(_r2('mp'))}, 'EUR' FROM b_yt
    UNION ALL SELECT '{P} YTD Period', 'January-' || monthname(last_month), 'period' FROM b_yt
    UNION ALL (SELECT 'Highest Transaction Volume County ' || sale_year, county, 'county'
      FROM b_county WHERE sale_year = (SELECT y FROM b_ml) AND county IS NOT NULL
      ORDER BY transactions DESC, county LIMIT 1)
    UNION ALL (SELECT 'Highest Average Price County ' || sale_year, county, 'county'
      FROM b_county WHERE sale_year = (SELECT y FROM b_ml) AND county IS NOT NULL
      ORDER BY mean_price DESC NULLS LAST, county LIMIT 1)
    UNION ALL SELECT y || ' Planning Applications', CAST(n AS VARCHAR), 'applications' FROM b_plast
    UNION ALL SELECT y || ' Residential Units in Applications', {_text('u')}, 'units' FROM b_plast""",
)

REPORT_CTES = {
    "annual_market": "b_annual",
    "market_ytd": "b_ytd",
    "price_growth": "b_growth",
    "county_market": "b_county_latest",
    "county_price_change": "b_change",
    "county_property_mix": "b_mix",
    "annual_planning": "b_annual_planning",
    "planning_authority": "b_authority",
    "market_planning_correlation": "b_corr",
    "key_kpis": "b_kpi",
}


@query("annual_market_summary", "SELECT * FROM b_annual")
def annual_market_summary(spark, d):
    return reports.annual_market_summary(b.stored_monthly(spark, d), YEARS)


@query("market_ytd", "SELECT * FROM b_ytd")
def market_ytd(spark, d):
    return reports.market_ytd(b.stored_monthly(spark, d), YEARS)


@query("price_growth", "SELECT * FROM b_growth")
def price_growth(spark, d):
    return reports.price_growth(b.stored_monthly(spark, d), YEARS)


@query("county_market_latest", "SELECT * FROM b_county_latest")
def county_market_latest(spark, d):
    return reports.county_market_latest(b.stored_county(spark, d), YEARS)


@query("county_price_change", "SELECT * FROM b_change")
def county_price_change(spark, d):
    return reports.county_price_change(b.stored_county(spark, d), YEARS)


@query("county_property_mix", "SELECT * FROM b_mix")
def county_property_mix(spark, d):
    return reports.county_property_mix(reports.county_market_latest(b.stored_county(spark, d), YEARS))


@query("annual_planning", "SELECT * FROM b_annual_planning")
def annual_planning(spark, d):
    return reports.annual_planning(b.planning(spark, d), YEARS)


@query("planning_authority_latest", "SELECT * FROM b_authority")
def planning_authority_latest(spark, d):
    return reports.planning_authority_latest(b.stored_planning(spark, d), YEARS)


@query("market_planning_correlation", "SELECT * FROM b_corr")
def market_planning_correlation(spark, d):
    marts = b.stored(spark, d, "monthly", "planning")
    return reports.market_planning_correlation(*marts)


@query("key_kpis", "SELECT * FROM b_kpi")
def key_kpis(spark, d):
    return reports.key_kpis(b.marts(spark, d).written(), YEARS)


@query(
    "source_coverage",
    """SELECT 'monthly_market' AS mart, min(year_month) AS first_period, max(year_month) AS last_period,
      count(*) AS row_count FROM b_monthly
    UNION ALL SELECT 'county_market', CAST(min(sale_year) AS VARCHAR), CAST(max(sale_year) AS VARCHAR), count(*) FROM b_county
    UNION ALL SELECT 'planning_activity', min(year_month), max(year_month), count(*) FROM b_planning""",
)
def source_coverage(spark, d):
    return reports.source_coverage(b.marts(spark, d).written())
