"""Exploration tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalogue import bindings as b
from catalogue.aggregates import (
    HISTOGRAM_SQL,
    QUANTILES,
    change_sql,
    masked_sql,
    q6,
    quantile_sql,
    r6,
)
from catalogue.bindings import FLOAT_MEAN, FLOAT_MEDIAN
from catalogue import layers  # noqa: F401 - its SQL is used below
from catalogue.registry import ORACLES, cte, query
from landledger import storage
from landledger.functions.numbers import plain_number
from landledger.plans import exploration as eda
from landledger.plans.rebuild import explore
from landledger.sources.writers import Warehouse

_F = f"""count(*) AS transactions, CAST(sum(price_eur) AS DECIMAL(28,2)) AS total_value,
    {FLOAT_MEAN} AS mean_price, {FLOAT_MEDIAN} AS median_price"""
_MM = f"{q6('mean_price')} AS mean_price, {q6('median_price')} AS median_price"


def _eda(spark, d, *columns):
    return b.tx(spark, d, *columns, eda=True)


def _num(expr: str) -> str:
    """Text of a number without trailing zeros, one decimal at least."""
    return f"regexp_replace(CAST({expr} AS VARCHAR), '(\\.[0-9]+?)0+$', '\\1')"


@query(
    "dataset_summary",
    f"""SELECT 'rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM b_tx
    UNION ALL SELECT 'columns', '18'
    UNION ALL SELECT 'start_date', CAST(min(sale_date) AS VARCHAR) FROM b_tx
    UNION ALL SELECT 'end_date', CAST(max(sale_date) AS VARCHAR) FROM b_tx
    UNION ALL SELECT 'total_transaction_value', {_num('CAST(sum(price_eur) AS DECIMAL(38,2))')} FROM b_tx
    UNION ALL SELECT 'mean_transaction_price', {_num(f'CAST({FLOAT_MEAN} AS DECIMAL(38,4))')} FROM b_tx
    UNION ALL SELECT 'median_transaction_price', {_num(f'CAST({FLOAT_MEDIAN} AS DECIMAL(38,4))')} FROM b_tx""",
)
def dataset_summary(spark, d):
    """Rounded to four decimals for comparison only."""
    value = F.when(
        F.col("metric").isin("mean_transaction_price", "median_transaction_price"),
        plain_number(F.col("value").try_cast("decimal(38,12)"), 4),
    ).otherwise(F.col("value"))
    return eda.dataset_summary(_eda(spark, d, *eda.schemas.TX_COLUMNS)).withColumn("value", value)


def _missing_sql(columns, table, name=lambda c: c):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {name(c)} IS NULL) AS missing_count,
        {q6(f"CAST(count(*) FILTER (WHERE {name(c)} IS NULL) AS DOUBLE) / count(*) * 100.0")} AS missing_percentage
        FROM {table}"""
        for c in columns
    )


@query(
    "missing_values",
    _missing_sql(
        eda.schemas.TX_COLUMNS, "b_tx", lambda c: "eda_size_category" if c == "property_size_category" else c
    ),
)
def missing_values(spark, d):
    return r6(eda.missing_values(b.tx(spark, d, eda=True)), "missing_percentage")


cte("b_by_year", f"SELECT sale_year, {_F} FROM b_tx GROUP BY 1")
cte("b_by_month", f"SELECT sale_year_month, {_F} FROM b_tx GROUP BY 1")
cte("b_by_quarter", f"SELECT sale_year, sale_quarter, {_F} FROM b_tx GROUP BY 1, 2")
cte("b_by_county_year", f"SELECT county, sale_year, {_F} FROM b_tx WHERE county IS NOT NULL GROUP BY 1, 2")


@query(
    "annual_market_analysis",
    f"""SELECT sale_year, transactions, total_value, {_MM},
    {change_sql('transactions', 'sale_year')} AS transaction_growth_pct,
    {change_sql('median_price', 'sale_year')} AS median_price_growth_pct,
    {change_sql('mean_price', 'sale_year')} AS mean_price_growth_pct FROM b_by_year""",
)
def annual_market_analysis(spark, d):
    df = eda.annual_market_analysis(_eda(spark, d, "sale_year", "price_eur"))
    return r6(
        df, "mean_price", "median_price", "transaction_growth_pct", "median_price_growth_pct",
        "mean_price_growth_pct",
    )


@query(
    "monthly_market_analysis",
    f"""SELECT sale_year_month, transactions, total_value, {_MM},
    {change_sql('transactions', 'sale_year_month')} AS transaction_growth_pct,
    {change_sql('median_price', 'sale_year_month')} AS median_price_growth_pct FROM b_by_month""",
)
def monthly_market_analysis(spark, d):
    df = eda.monthly_market_analysis(_eda(spark, d, "sale_year_month", "price_eur"))
    return r6(df, "mean_price", "median_price", "transaction_growth_pct", "median_price_growth_pct")


@query(
    "quarterly_market_analysis",
    f"""SELECT sale_year, sale_quarter, transactions, total_value, {_MM},
    sale_year || '-Q' || sale_quarter AS quarter_label,
    {change_sql('transactions', 'sale_year, sale_quarter')} AS transaction_growth_pct,
    {change_sql('median_price', 'sale_year, sale_quarter')} AS median_price_growth_pct FROM b_by_quarter""",
)
def quarterly_market_analysis(spark, d):
    df = eda.quarterly_market_analysis(_eda(spark, d, "sale_year", "sale_quarter", "price_eur"))
    return r6(df, "mean_price", "median_price", "transaction_growth_pct", "median_price_growth_pct")


@query(
    "monthly_seasonality",
    f"""SELECT sale_month, transactions, {_MM}, monthname(make_date(2000, sale_month, 1)) AS month_name,
    {q6('CAST(transactions AS DOUBLE) / (SELECT count(DISTINCT sale_year) FROM b_tx)')} AS average_transactions_per_year
    FROM (SELECT sale_month, {_F} FROM b_tx GROUP BY 1)""",
)
def monthly_seasonality(spark, d):
    df = eda.monthly_seasonality(_eda(spark, d, "sale_year", "sale_month", "price_eur"))
    return r6(df, "mean_price", "median_price", "average_transactions_per_year")


@query(
    "county_market_analysis",
    f"""SELECT county, transactions, {_MM}, total_value,
    {q6('CAST(transactions AS DOUBLE) / (SELECT count(*) FROM b_tx) * 100.0')} AS national_transaction_share_pct
    FROM (SELECT county, {_F} FROM b_tx WHERE county IS NOT NULL GROUP BY 1)""",
)
def county_market_analysis(spark, d):
    df = eda.county_market_analysis(_eda(spark, d, "county", "price_eur"))
    return r6(df, "mean_price", "median_price", "national_transaction_share_pct")


@query(
    "county_price_growth",
    f"""SELECT county, first_year, {q6('fp')} AS first_year_median_price, latest_year,
    {q6('lp')} AS latest_year_median_price, {q6('CASE WHEN fp > 0 THEN (lp - fp) / fp * 100.0 END')} AS median_price_growth_pct,
    first_year_transactions, latest_year_transactions FROM (
      SELECT county, min(sale_year) AS first_year, arg_min(median_price, sale_year) AS fp,
        max(sale_year) AS latest_year, arg_max(median_price, sale_year) AS lp,
        arg_min(transactions, sale_year) AS first_year_transactions,
        arg_max(transactions, sale_year) AS latest_year_transactions FROM b_by_county_year GROUP BY 1)""",
)
def county_price_growth(spark, d):
    df = eda.county_price_growth(_eda(spark, d, "county", "sale_year", "price_eur"))
    return r6(
        df, "first_year_median_price", "latest_year_median_price", "median_price_growth_pct"
    )


@query(
    "new_vs_second_hand",
    masked_sql("property_type", [("New", "is_new_property"), ("Second-Hand", "is_second_hand_property")]),
)
def new_vs_second_hand(spark, d):
    df = _eda(spark, d, "price_eur", "is_new_property", "is_second_hand_property")
    return r6(eda.new_vs_second_hand(df), "transaction_share_pct", "mean_price", "median_price")


@query(
    "property_description_analysis",
    f"""SELECT property_description, transactions, {_MM} FROM (SELECT property_description, {_F} FROM b_tx
    WHERE property_description IS NOT NULL GROUP BY 1)""",
)
def property_description_analysis(spark, d):
    df = eda.property_description_analysis(_eda(spark, d, "property_description", "price_eur"))
    return r6(df, "mean_price", "median_price")


@query(
    "property_size_analysis",
    f"""SELECT property_size_category, transactions, {_MM},
    {q6('CAST(transactions AS DOUBLE) / (SELECT count(*) FROM b_tx) * 100.0')} AS transaction_share_pct
    FROM (SELECT eda_size_category AS property_size_category, {_F} FROM b_tx GROUP BY 1)""",
)
def property_size_analysis(spark, d):
    df = eda.property_size_analysis(_eda(spark, d, "property_size_category", "price_eur"))
    return r6(df, "mean_price", "median_price", "transaction_share_pct")


@query(
    "non_full_market_price",
    masked_sql(
        "market_price_category",
        [
            ("Full Market Price", "NOT is_not_full_market_price"),
            ("Not Full Market Price", "is_not_full_market_price"),
        ],
        total=False,
    ),
)
def non_full_market_price(spark, d):
    df = eda.non_full_market_price(_eda(spark, d, "price_eur", "is_not_full_market_price"))
    return r6(df, "transaction_share_pct", "mean_price", "median_price")


@query(
    "vat_exclusive",
    masked_sql(
        "vat_category",
        [("Not VAT Exclusive", "NOT is_vat_exclusive"), ("VAT Exclusive", "is_vat_exclusive")],
        total=False,
    ),
)
def vat_exclusive(spark, d):
    df = eda.vat_exclusive(_eda(spark, d, "price_eur", "is_vat_exclusive"))
    return r6(df, "transaction_share_pct", "mean_price", "median_price")


@query(
    "price_percentiles",
    quantile_sql([(0, "min"), *[(q, f"{q * 100:.1f}%") for q in QUANTILES], (1, "max")]),
)
def price_percentiles(spark, d):
    return r6(eda.price_percentiles(_eda(spark, d, "price_eur"), with_range=True), "price_eur")


@query("price_histogram", HISTOGRAM_SQL)
def price_histogram(spark, d):
    return r6(eda.price_histogram(_eda(spark, d, "price_eur")), "bin_start", "bin_end")


_P999 = "(SELECT quantile_cont(cents, 0.999) FROM b_tx)"


@query(
    "extreme_transactions",
    f"SELECT {', '.join(eda.EXTREME_COLUMNS)} FROM b_tx WHERE cents >= {_P999}",
)
def extreme_transactions(spark, d):
    """The county is looked up for the extreme rows only."""
    columns = [c for c in eda.EXTREME_COLUMNS if c != "county"]
    rows = eda.extreme_rows(_eda(spark, d, *columns, "order_key"))
    return eda.as_extreme_report(b.with_county(spark, d, rows))


@query(
    "extreme_comparison",
    masked_sql(
        "analytical_view",
        [
            ("All transactions", "true"),
            ("Below 99.9th percentile", f"cents < {_P999}"),
            ("At or above 99.9th percentile", f"cents >= {_P999}"),
        ],
        share=False,
        total=False,
    ),
)
def extreme_comparison(spark, d):
    return r6(eda.extreme_comparison(_eda(spark, d, "price_eur")), "mean_price", "median_price")


@query(
    "eda_quality_summary",
    """SELECT metric, value FROM (UNPIVOT (SELECT count(*) AS row_count,
      count(*) FILTER (WHERE sale_date IS NULL) AS invalid_dates,
      count(*) FILTER (WHERE price_eur IS NULL) AS invalid_prices,
      count(*) FILTER (WHERE eircode IS NULL) AS missing_eircode,
      count(*) FILTER (WHERE property_size_description IS NULL) AS missing_property_size_description,
      count(*) FILTER (WHERE is_not_full_market_price) AS not_full_market_price_transactions,
      count(*) FILTER (WHERE is_vat_exclusive) AS vat_exclusive_transactions,
      count(*) FILTER (WHERE is_new_property) AS new_property_transactions,
      count(*) FILTER (WHERE is_second_hand_property) AS second_hand_property_transactions FROM b_tx)
      ON COLUMNS(*) INTO NAME metric VALUE value)""",
)
def eda_quality_summary(spark, d):
    columns = [
        "sale_date", "price_eur", "eircode", "property_size_description", "is_not_full_market_price",
        "is_vat_exclusive", "is_new_property", "is_second_hand_property",
    ]
    return eda.eda_quality_summary(_eda(spark, d, *columns))


# table of the exploration job -> (query with its SQL, column whose sum is compared)
JOB_TABLES = {
    "dataset_summary": ("dataset_summary", None),
    "missing_values": ("missing_values", "missing_count"),
    "eda_quality_summary": ("eda_quality_summary", "value"),
    "annual_market_analysis": ("annual_market_analysis", "transactions"),
    "monthly_market_analysis": ("monthly_market_analysis", "transactions"),
    "quarterly_market_analysis": ("quarterly_market_analysis", "transactions"),
    "monthly_seasonality": ("monthly_seasonality", "transactions"),
    "county_market_analysis": ("county_market_analysis", "transactions"),
    "county_price_growth": ("county_price_growth", "latest_year_transactions"),
    "new_vs_second_hand": ("new_vs_second_hand", "transactions"),
    "property_description_analysis": ("property_description_analysis", "transactions"),
    "property_size_analysis": ("property_size_analysis", "transactions"),
    "non_full_market_price_analysis": ("non_full_market_price", "transactions"),
    "vat_exclusive_analysis": ("vat_exclusive", "transactions"),
    "price_percentiles": ("price_percentiles", "price_eur"),
    "extreme_transactions_99_9th_percentile": ("extreme_transactions", "price_eur"),
    "extreme_transaction_comparison": ("extreme_comparison", "transactions"),
    "price_histogram": ("price_histogram", "transactions"),
}


def _job_sql() -> str:
    parts = []
    # the job reports no minimum and maximum, and its table keeps an unknown flag unknown
    sources = {key: ORACLES[key] for key, _ in JOB_TABLES.values()} | {
        "price_percentiles": f"SELECT * FROM ({ORACLES['price_percentiles']}) WHERE percentile NOT IN ('min', 'max')",
        "missing_values": " UNION ALL ".join(
            f"SELECT '{c}' AS c, count(*) FILTER (WHERE {c} IS NULL) AS missing_count FROM ({ORACLES['load_tx_eda']})"
            for c in eda.schemas.TX_COLUMNS
        ),
    }
    for name, (key, column) in JOB_TABLES.items():
        total = f"CAST(sum(CAST({column} AS DECIMAL(28,2))) AS DECIMAL(38,2))" if column else "CAST(NULL AS DECIMAL(38,2))"
        parts.append(f"SELECT '{name}' AS table_name, count(*) AS row_count, {total} AS total FROM ({sources[key]})")
    return " UNION ALL ".join(parts)


@query("exploration_job", _job_sql())
def exploration_job(spark, d):
    """Register to stored analysis table to eighteen written tables, read back from their files."""
    folder = storage.fresh_path(spark, "exploration")
    warehouse = Warehouse(spark, storage.fresh_path(spark, "exploration-tables"))
    explore(b.tx_raw(spark, d), warehouse, folder)
    parts = []
    for name, (_, column) in JOB_TABLES.items():
        table = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
        total = F.sum(F.col(column).cast("decimal(28,2)")) if column else F.lit(None)
        parts.append(
            table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), total.cast("decimal(38,2)").alias("total"))
        )
    return reduce(lambda x, y: x.unionByName(y), parts)
