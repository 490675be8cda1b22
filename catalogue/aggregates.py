"""Aggregation, windows, joins, ordering and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import bindings as b
from catalogue.bindings import MEAN, MEDIAN, TOTAL
from catalogue.marts_and_reports import MONTHLY_COLUMNS, _r2
from catalogue.registry import cte, query
from landledger.functions.numbers import round_even
from landledger.operators import grouped_stats as stats
from landledger.operators import series
from landledger.plans import reports


def r6(df, *columns):
    """Six decimals for comparing floats of two engines."""
    return df.withColumns({c: round_even(c, 6) for c in columns})


def q6(expr: str) -> str:
    return _r2(expr, 6)


@query(
    "group_basic_stats",
    f"""SELECT sale_year, county, count(*) AS transactions, {TOTAL} AS total_value, {MEAN} AS mean_price,
    {MEDIAN} AS median_price FROM b_tx GROUP BY 1, 2""",
)
def group_basic_stats(spark, d):
    df = b.tx(spark, d, "sale_year", "county", "price_eur")
    return stats.money_stats(df, ["sale_year", "county"], "price_eur")


@query(
    "count_filter",
    """SELECT sale_year, count(*) AS transactions, count(*) FILTER (WHERE is_new_property) AS new_count,
    count(*) FILTER (WHERE is_vat_exclusive) AS vat_exclusive_count FROM b_tx GROUP BY 1""",
)
def count_filter(spark, d):
    df = b.tx(spark, d, "sale_year", "price_eur", "is_new_property", "is_vat_exclusive")
    tallies = {
        "new_count": F.col("is_new_property"),
        "vat_exclusive_count": F.col("is_vat_exclusive"),
    }
    return stats.grouped_stats(df, ["sale_year"], "price_eur", tallies=tallies).select(
        "sale_year", F.col("rows").alias("transactions"), *tallies
    )


@query("percentile_cont", f"SELECT property_description, {MEDIAN} AS median_price FROM b_tx GROUP BY 1")
def percentile_cont(spark, d):
    df = b.tx(spark, d, "property_description", "price_eur")
    return stats.money_stats(df, ["property_description"], "price_eur").select(
        "property_description", "median_price"
    )


@query(
    "global_agg",
    f"""SELECT count(*) AS transactions, {TOTAL} AS total_value, {MEAN} AS mean_price,
    {MEDIAN} AS median_price, min(price_eur) AS lowest_price, max(price_eur) AS highest_price FROM b_tx""",
)
def global_agg(spark, d):
    df = b.tx(spark, d, "price_eur")
    found = stats.grouped_stats(
        df, [], "price_eur", {"lowest": 0.0, "median": 0.5, "highest": 1.0}
    )
    return found.select(
        F.col("rows").alias("transactions"),
        F.col("total").cast("decimal(28,2)").alias("total_value"),
        stats.exact_mean(F.col("total"), F.col("value_rows")).alias("mean_price"),
        stats.money("median").alias("median_price"),
        stats.money("lowest").alias("lowest_price"),
        stats.money("highest").alias("highest_price"),
    )


QUANTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99, 0.995, 0.999]


def quantile_sql(labels) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS percentile, {q6(f'quantile_cont(cents, {q}) / 100.0')} AS price_eur FROM b_tx"
        for q, label in labels
    )


@query("quantile_vector", quantile_sql([(q, f"{q * 100:.1f}%") for q in QUANTILES]))
def quantile_vector(spark, d):
    return r6(stats.quantile_rows(b.tx(spark, d, "price_eur"), "price_eur", QUANTILES), "price_eur")


@query("count_distinct", "SELECT count(DISTINCT sale_year) AS distinct_years FROM b_tx")
def count_distinct(spark, d):
    return b.tx(spark, d, "sale_year").agg(F.countDistinct("sale_year").alias("distinct_years"))


def masked_sql(label: str, masks: list[tuple[str, str]], share=True, total=True) -> str:
    parts = []
    for name, mask in masks:
        cols = [f"'{name}' AS {label}", f"count(*) FILTER (WHERE {mask}) AS transactions"]
        if share:
            cols.append(
                q6(f"CAST(count(*) FILTER (WHERE {mask}) AS DOUBLE) / count(*) * 100.0")
                + " AS transaction_share_pct"
            )
        cols.append(
            q6(f"CAST(sum(price_eur) FILTER (WHERE {mask}) AS DOUBLE) / count(price_eur) FILTER (WHERE {mask})")
            + " AS mean_price"
        )
        cols.append(q6(f"median(cents) FILTER (WHERE {mask}) / 100.0") + " AS median_price")
        if total:
            cols.append(
                f"CAST(coalesce(sum(price_eur) FILTER (WHERE {mask}), 0) AS DECIMAL(28,2)) AS total_value"
            )
        parts.append(f"SELECT {', '.join(cols)} FROM b_tx")
    return " UNION ALL ".join(parts)


@query(
    "masked_agg",
    masked_sql(
        "mask",
        [("new", "is_new_property"), ("vat exclusive", "is_vat_exclusive"), ("none", "price_eur < 0")],
    ),
)
def masked_agg(spark, d):
    df = b.tx(spark, d, "price_eur", "is_new_property", "is_vat_exclusive")
    masks = [
        ("new", F.col("is_new_property")),
        ("vat exclusive", F.col("is_vat_exclusive")),
        ("none", F.col("price_eur") < 0),
    ]
    return r6(
        stats.masked_stats(df, "price_eur", masks, "mask"),
        "transaction_share_pct", "mean_price", "median_price",
    )


@query(
    "re_aggregate",
    f"""SELECT CAST(year(month_start) AS INTEGER) AS year, CAST(sum(transactions) AS BIGINT) AS transactions,
    {q6('CAST(sum(median_price) AS DOUBLE) / count(median_price)')} AS mean_of_medians,
    {q6('CAST(sum(national_rppi) AS DOUBLE) / nullif(count(national_rppi), 0)')} AS mean_index
    FROM b_monthly GROUP BY 1""",
)
def re_aggregate(spark, d):
    df = reports.by_year(b.monthly(spark, d)).groupBy("year").agg(
        reports.total_of("transactions").alias("transactions"),
        reports.mean_of("median_price").alias("mean_of_medians"),
        reports.mean_of("national_rppi").alias("mean_index"),
    )
    return r6(df, "mean_of_medians", "mean_index")


@query(
    "pearson_corr",
    f"""SELECT sale_year, {_r2("corr(CAST(price_eur AS DOUBLE), CAST(sale_month AS DOUBLE))", 8)} AS r,
    CAST(regr_count(CAST(price_eur AS DOUBLE), CAST(sale_month AS DOUBLE)) AS BIGINT) AS observations
    FROM b_tx GROUP BY 1""",
)
def pearson_corr(spark, d):
    x, y = F.col("price_eur").cast("double"), F.col("sale_month").cast("double")
    return (
        b.tx(spark, d, "sale_year", "sale_month", "price_eur")
        .groupBy("sale_year")
        .agg(
            round_even(series.pearson(x, y), 8).alias("r"),
            F.count_if(x.isNotNull() & y.isNotNull()).alias("observations"),
        )
    )


@query(
    "first_agg",
    """SELECT county, max(mean_price) FILTER (WHERE sale_year = 1995) AS mean_1995,
    max(mean_price) FILTER (WHERE sale_year = 2000) AS mean_2000 FROM b_county GROUP BY 1""",
)
def first_agg(spark, d):
    return (
        b.county(spark, d)
        .groupBy("county")
        .pivot("sale_year", [1995, 2000])
        .agg(F.first("mean_price", ignorenulls=True))
        .withColumnsRenamed({"1995": "mean_1995", "2000": "mean_2000"})
    )


@query(
    "latest_period",
    """SELECT max(sale_date) AS last_date, CAST(max(sale_year) FILTER (WHERE sale_year < 2001) AS INTEGER)
    AS latest_completed_year FROM b_tx""",
)
def latest_period(spark, d):
    completed = F.when(F.col("sale_year") < b.YEARS.partial, F.col("sale_year"))
    return b.tx(spark, d, "sale_date", "sale_year").agg(
        F.max("sale_date").alias("last_date"), F.max(completed).alias("latest_completed_year")
    )


cte(
    "b_edge",
    "SELECT quantile_cont(cents, 0.99) AS edge, min(cents) AS lo FROM b_tx",
)
cte(
    "b_kept",
    "SELECT cents, lo, max(cents) OVER () AS hi FROM b_tx, b_edge WHERE cents <= edge",
)
HISTOGRAM_SQL = f"""SELECT CAST(g.i + 1 AS INTEGER) AS bin, {q6('(lo + g.i * w) / 100.0')} AS bin_start,
    {q6('(lo + (g.i + 1) * w) / 100.0')} AS bin_end, coalesce(n, 0) AS transactions
    FROM range(50) AS g(i) CROSS JOIN (SELECT min(lo) AS lo, (max(hi) - min(lo)) / 50.0::DOUBLE AS w FROM b_kept)
    LEFT JOIN (SELECT least(CAST(floor((cents - lo) / ((hi - lo) / 50.0::DOUBLE)) AS BIGINT), 49) AS i, count(*) AS n
      FROM b_kept GROUP BY 1) c ON c.i = g.i"""


@query("histogram", HISTOGRAM_SQL)
def histogram(spark, d):
    return r6(stats.histogram(b.tx(spark, d, "price_eur"), "price_eur"), "bin_start", "bin_end")


# ---- windows ---------------------------------------------------------------
def change_sql(col: str, order: str) -> str:
    prev = f"lag(CAST({col} AS DOUBLE)) OVER (ORDER BY {order})"
    return q6(f"(CAST({col} AS DOUBLE) / nullif({prev}, 0) - 1) * 100")


@query(
    "pct_change",
    f"""SELECT year_month, transactions, {change_sql('transactions', 'year_month')} AS transactions_change_pct,
    {change_sql('national_rppi', 'year_month')} AS index_change_pct FROM b_monthly""",
)
def pct_change(spark, d):
    df = b.monthly(spark, d).select("year_month", "transactions", "national_rppi")
    changes = {"transactions": "transactions_change_pct", "national_rppi": "index_change_pct"}
    return r6(series.growth_pct(df, changes, ["year_month"]), *changes.values()).drop("national_rppi")


@query(
    "first_last_by_group",
    """SELECT county, arg_min(sale_year, sale_year) AS first_sale_year,
    arg_min(median_price, sale_year) AS first_median_price, arg_max(sale_year, sale_year) AS latest_sale_year,
    arg_max(median_price, sale_year) AS latest_median_price FROM b_county GROUP BY county""",
)
def first_last_by_group(spark, d):
    return series.first_and_last(b.county(spark, d), "county", "sale_year", ["median_price"])


@query(
    "share_of_total",
    f"""SELECT property_description, count(*) AS transactions,
    {q6('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM b_tx) * 100.0')} AS share_pct FROM b_tx GROUP BY 1""",
)
def share_of_total(spark, d):
    df = b.tx(spark, d, "property_description").groupBy("property_description")
    df = df.agg(F.count(F.lit(1)).alias("transactions"))
    return r6(series.share_of_total(df, "transactions", "share_pct"), "share_pct")


# ---- joins -----------------------------------------------------------------
@query("left_join_month", f"SELECT {MONTHLY_COLUMNS} FROM b_monthly")
def left_join_month(spark, d):
    return b.monthly(spark, d)


@query(
    "inner_join_month",
    """SELECT month_start, transactions, mean_price, median_price, national_rppi,
    CAST(applications AS BIGINT) AS applications, CAST(granted_applications AS BIGINT) AS granted_applications,
    CAST(refused_applications AS BIGINT) AS refused_applications, residential_units FROM b_merged""",
)
def inner_join_month(spark, d):
    return reports.market_with_planning(*b.stored(spark, d, "monthly", "planning"))


@query(
    "set_coverage",
    """SELECT 'missing' AS side, year_month FROM (SELECT DISTINCT sale_year_month AS year_month FROM b_tx
      EXCEPT SELECT DISTINCT year_month FROM b_planning)
    UNION ALL SELECT 'extra', year_month FROM (SELECT DISTINCT year_month FROM b_planning
      EXCEPT SELECT DISTINCT sale_year_month FROM b_tx)""",
)
def set_coverage(spark, d):
    sold = b.tx(spark, d, "sale_year_month").withColumnRenamed("sale_year_month", "year_month")
    return series.set_coverage(sold, b.planning(spark, d), "year_month")


# ---- sort, limit, top-k ----------------------------------------------------
@query("order_by", "SELECT * FROM b_planning ORDER BY planning_authority, year_month")
def order_by(spark, d):
    return b.planning(spark, d).orderBy(
        F.col("planning_authority").asc_nulls_last(), F.col("year_month").asc_nulls_last()
    )


TOP_COLUMNS = [
    "sale_date", "address", "county", "price_eur", "not_full_market_price", "vat_exclusive",
    "property_description",
]


@query(
    "top_k_price",
    f"SELECT {', '.join(TOP_COLUMNS)} FROM b_tx ORDER BY price_eur DESC NULLS LAST, sale_date, address LIMIT 10",
)
def top_k_price(spark, d):
    """The county is looked up for the ten rows only."""
    keys = ["sale_date", "address"]
    rest = [c for c in TOP_COLUMNS if c != "county"]
    top = series.top_rows(b.tx(spark, d, *rest, "order_key"), [*rest, "order_key"], "price_eur", 10, keys)
    return b.with_county(spark, d, top).select(*TOP_COLUMNS)


@query(
    "latest_months",
    """SELECT year_month, transactions, median_price, national_rppi FROM b_monthly
    ORDER BY year_month DESC LIMIT 12""",
)
def latest_months(spark, d):
    df = b.monthly(spark, d).select("year_month", "transactions", "median_price", "national_rppi")
    return df.orderBy(F.desc("year_month")).limit(12)


@query(
    "latest_counties",
    """SELECT county, sale_year, transactions, median_price FROM b_county
    ORDER BY sale_year DESC, transactions DESC, county LIMIT 20""",
)
def latest_counties(spark, d):
    df = b.county(spark, d).select("county", "sale_year", "transactions", "median_price")
    return df.orderBy(F.desc("sale_year"), F.desc("transactions"), "county").limit(20)


@query(
    "latest_authorities",
    """SELECT planning_authority, year_month, applications, granted_applications, residential_units
    FROM b_planning ORDER BY year_month DESC, applications DESC, planning_authority LIMIT 20""",
)
def latest_authorities(spark, d):
    df = b.planning(spark, d).select(
        "planning_authority", "year_month", "applications", "granted_applications", "residential_units"
    )
    return df.orderBy(F.desc("year_month"), F.desc("applications"), "planning_authority").limit(20)


def _top5(ranking: str, table: str, metric: str) -> str:
    return f"""(SELECT '{ranking}' AS ranking, county, CAST({metric} AS DOUBLE) AS value FROM {table}
    ORDER BY {metric} DESC NULLS LAST, county LIMIT 5)"""


@query(
    "top5_counties",
    " UNION ALL ".join(
        [
            _top5("transactions", "b_county_latest", "transactions"),
            _top5("mean_price", "b_county_latest", "mean_price"),
            _top5("price_change_pct", "b_change", "price_change_pct"),
        ]
    ),
)
def top5_counties(spark, d):
    county = b.stored_county(spark, d)
    return reports.top_counties(
        reports.county_market_latest(county, b.YEARS), reports.county_price_change(county, b.YEARS)
    )


@query(
    "argmax_row",
    """SELECT (SELECT county FROM b_county_latest ORDER BY transactions DESC, county LIMIT 1) AS highest_transactions,
    (SELECT county FROM b_county_latest ORDER BY mean_price DESC NULLS LAST, county LIMIT 1) AS highest_mean_price""",
)
def argmax_row(spark, d):
    return reports.argmax_rows(reports.county_market_latest(b.stored_county(spark, d), b.YEARS))


@query(
    "tail_n",
    f"""SELECT {MONTHLY_COLUMNS} FROM (SELECT * FROM b_monthly ORDER BY year_month DESC LIMIT 24)""",
)
def tail_n(spark, d):
    return series.latest(b.monthly(spark, d), ["year_month"], 24)


# ---- reshaping -------------------------------------------------------------
@query(
    "pivot_year",
    """SELECT county, max(mean_price) FILTER (WHERE sale_year = 1995) AS mean_price_1995,
    max(mean_price) FILTER (WHERE sale_year = 2000) AS mean_price_2000 FROM b_county
    WHERE sale_year IN (1995, 2000) GROUP BY 1""",
)
def pivot_year(spark, d):
    county = b.stored_county(spark, d)
    years = [b.YEARS.baseline, reports.comparison_year(county, b.YEARS)]
    return (
        county.filter(F.col("sale_year").isin(*years))
        .groupBy("county")
        .pivot("sale_year", years)
        .agg(F.first("mean_price", ignorenulls=True))
        .withColumnsRenamed({str(y): f"mean_price_{y}" for y in years})
    )


@query(
    "unpivot_metrics",
    """SELECT planning_authority, year_month, metric, value FROM (
      UNPIVOT (SELECT planning_authority, year_month, applications, granted_applications, refused_applications
        FROM b_planning) ON applications, granted_applications, refused_applications INTO NAME metric VALUE value)""",
)
def unpivot_metrics(spark, d):
    metrics = ["applications", "granted_applications", "refused_applications"]
    return b.planning(spark, d).unpivot(["planning_authority", "year_month"], metrics, "metric", "value")
