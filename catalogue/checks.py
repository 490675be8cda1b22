"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import bindings as b
from catalogue.bindings import YEARS
from catalogue.layers import stg_index, stg_planning, stg_tx, written_reports
from catalogue.marts_and_reports import LATEST, P, REPORT_CTES, summary_mart
from catalogue.registry import cte, query
from landledger import schemas
from landledger.plans import quality, reports
from landledger.storage import materialise

B0 = YEARS.baseline
EXPECTED = schemas.report_schemas(B0, LATEST)
FILES = quality.report_files(YEARS, LATEST)


def _names(report: str) -> str:
    return f"market_{P}_ytd" if report == "market_ytd" else report


def _n(expr: str) -> str:
    return f"format('{{:,}}', CAST({expr} AS BIGINT))"


def _each(block, tables=REPORT_CTES) -> str:
    return " UNION ALL ".join(block(name, table) for name, table in tables.items())


def _check(name: str, ok: str, good: str, bad: str, source: str) -> str:
    return f"""SELECT {name} AS check_name, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status,
    CASE WHEN {ok} THEN {good} ELSE {bad} END AS details FROM {source}"""


def _exists(r: str, t: str) -> str:
    return f"""SELECT 'Stage 3 file exists: {FILES[_names(r)]}' AS check_name, 'PASS' AS status,
    {_n('count(*)')} || ' rows' AS details FROM {t}"""


def _columns(r: str, t: str) -> str:
    status, details = "PASS", "All expected columns present"
    if t == "b_damaged_growth":
        status, details = "FAIL", "Missing columns: [''avg_rppi'']"
    return f"SELECT 'Columns: {_names(r)}' AS check_name, '{status}' AS status, '{details}' AS details"


def _duplicates(r: str, t: str) -> str:
    return _check(
        f"'Duplicates: {_names(r)}'", "n = 0", "'No duplicate rows'", f"{_n('n')} || ' duplicate rows'",
        f"(SELECT (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS n)",
    )


def _non_empty(r: str, t: str) -> str:
    return _check(
        f"'Non-empty output: {_names(r)}'", "n > 0", f"{_n('n')} || ' rows'", "'CSV contains no rows'",
        f"(SELECT count(*) AS n FROM {t})",
    )


def _missing(r: str, t: str) -> str:
    return f"""SELECT 'Missing values: {_names(r)}' AS check_name, 'PASS' AS status,
    CASE WHEN n = 0 THEN 'No missing values' ELSE n || ' missing values (review required)' END AS details
    FROM (SELECT {' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in EXPECTED[r].fieldNames())} AS n FROM {t})"""


SQL_EXISTS, SQL_DUPLICATES, SQL_NON_EMPTY, SQL_MISSING = map(_each, (_exists, _duplicates, _non_empty, _missing))
SQL_COLUMNS = _each(_columns)


def _reconcile(label: str, table: str, year: int) -> str:
    source = f"""(SELECT CAST(s.n AS BIGINT) AS sn, CAST(s.v AS DECIMAL(28,2)) AS sv, o.transactions AS tn, o.total_value AS tv
      FROM (SELECT sum(transactions) AS n, sum(total_value) AS v FROM b_monthly WHERE year(month_start) = {year}) s,
      (SELECT transactions, total_value FROM {table} WHERE year = {year}) o)"""

    def euro(amount: str) -> str:
        return f"'€' || format('{{:,.2f}}', CAST({amount} AS DOUBLE))"

    def both(show, source: str, output: str) -> str:
        return f"'Source=' || {show(source)} || ', Output=' || {show(output)}"

    return " UNION ALL ".join(
        [
            _check(f"'{label} transaction reconciliation'", "sn = tn", f"{_n('sn')} || ' transactions'", both(_n, "sn", "tn"), source),
            _check(f"'{label} transaction-value reconciliation'", "sv = tv", euro("sv"), both(euro, "sv", "tv"), source),
        ]
    )


SQL_MARKET = _reconcile(str(LATEST), "b_annual", LATEST) + " UNION ALL " + _reconcile(f"{P} YTD", "b_ytd", P)


def _coverage(table: str) -> str:
    source = f"SELECT county FROM b_county WHERE sale_year = {LATEST} AND county IS NOT NULL"
    names = "coalesce(string_agg(county, ', ' ORDER BY county), '')"
    return _check(
        f"'{LATEST} county coverage'", "m = '' AND x = ''", "n || ' counties'",
        "'Missing={' || m || '}; Extra={' || x || '}'",
        f"""(SELECT (SELECT count(DISTINCT county) FROM ({source})) AS n,
          (SELECT {names} FROM ({source} EXCEPT SELECT county FROM {table})) AS m,
          (SELECT {names} FROM (SELECT county FROM {table} EXCEPT {source})) AS x)""",
    )


SQL_COVERAGE = _coverage("b_county_latest")
SQL_SHARES = _check(
    "'County property-mix shares'", "n = 0", "'Shares sum to approximately 100%'", "n || ' invalid rows'",
    """(SELECT count(*) FILTER (WHERE new_property_share_pct + second_hand_property_share_pct < 99.99
      OR new_property_share_pct + second_hand_property_share_pct > 100.01) AS n FROM b_mix)""",
)
SQL_CHANGE = _check(
    f"'County {B0}-{LATEST} price-change calculation'", "n = 0", "'Calculations reconcile'",
    "'Calculated percentages do not reconcile'",
    f"""(SELECT count(*) FILTER (WHERE price_change_pct IS DISTINCT FROM round_even(CAST(mean_price_{LATEST} - mean_price_{B0} AS DOUBLE)
      / nullif(CAST(mean_price_{B0} AS DOUBLE), 0) * 100 * 100.0::DOUBLE, 0) / 100.0::DOUBLE) AS n FROM b_change)""",
)
SQL_PLANNING = _check(
    f"'{LATEST} planning applications'", "s = o", f"{_n('s')} || ' applications'", "'differs'",
    f"""(SELECT (SELECT sum(applications) FROM b_planning WHERE year(month_start) = {LATEST}) AS s,
      (SELECT applications FROM b_annual_planning WHERE year = {LATEST}) AS o)""",
)


def _rate(kind: str, part: str) -> str:
    return _check(
        f"'Planning {kind}-rate calculation'", "e = a", "format('{:.2f}%', a)", "'differs'",
        f"""(SELECT {kind}_rate_pct AS a, round_even(CAST({part} AS DOUBLE) / applications * 100 * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS e
          FROM b_annual_planning WHERE year = {LATEST})""",
    )


SQL_RATES = _rate("grant", "granted_applications") + " UNION ALL " + _rate("refusal", "refused_applications")
_OBSERVED = " UNION ALL ".join(
    f"SELECT '{m}' AS m, '{p}' AS p, count(*) FILTER (WHERE {m} IS NOT NULL AND {p} IS NOT NULL) AS e FROM b_merged"
    for m in reports.MARKET_METRICS
    for p in reports.PLANNING_METRICS
)
SQL_CORR = _check(
    "'Correlation observation count'", "n = 0",
    "'Observation counts match pairwise complete-data calculations'", "'differs'",
    f"""(SELECT count(*) FILTER (WHERE e <> observations) AS n FROM b_corr
      JOIN ({_OBSERVED}) ON m = market_metric AND p = planning_metric)""",
)  # sound in both folders
SQL_REPORT = " UNION ALL ".join(
    [
        SQL_EXISTS, SQL_COLUMNS, SQL_DUPLICATES, SQL_NON_EMPTY, SQL_MISSING, SQL_MARKET, SQL_COVERAGE,
        SQL_SHARES, SQL_CHANGE, SQL_PLANNING, SQL_RATES, SQL_CORR,
    ]
)


# ---- a folder of damaged reports -------------------------------------------------
# price_growth has a column under another name, annual_market one transaction too many, county_market lacks
# its first county, county_property_mix holds every row twice, planning_authority none, key_kpis is absent.
cte("b_damaged_annual", "SELECT * REPLACE (transactions + 1 AS transactions) FROM b_annual")
cte("b_damaged_growth", "SELECT * RENAME (avg_rppi AS index_value) FROM b_growth")
cte("b_damaged_county", "SELECT * FROM b_county_latest WHERE county <> (SELECT min(county) FROM b_county_latest)")
cte("b_damaged_mix", "SELECT * FROM b_mix UNION ALL SELECT * FROM b_mix")
cte("b_damaged_authority", "SELECT * FROM b_authority WHERE false")
DAMAGED_CTES = {
    **{r: t for r, t in REPORT_CTES.items() if r != "key_kpis"},
    "annual_market": "b_damaged_annual",
    "price_growth": "b_damaged_growth",
    "county_market": "b_damaged_county",
    "county_property_mix": "b_damaged_mix",
    "planning_authority": "b_damaged_authority",
}


def damage(tables):
    """The same damage on report tables."""
    out = {name: df for name, df in tables.items() if name != "key_kpis"}
    county = tables["county_market"]
    first = F.broadcast(county.agg(F.min("county").alias("first")))
    out["annual_market"] = out["annual_market"].withColumn("transactions", F.col("transactions") + 1)
    out["price_growth"] = out["price_growth"].withColumnRenamed("avg_rppi", "index_value")
    out["county_market"] = county.join(first, F.col("county") != F.col("first")).drop("first")
    out["county_property_mix"] = out["county_property_mix"].unionByName(out["county_property_mix"])
    out["planning_authority"] = out["planning_authority"].limit(0)
    return out


def _absent_sql(*prefixes: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{prefix}' AS check_name, 'FAIL' AS status, 'Missing file: key_kpis.csv' AS details" for prefix in prefixes
    )


def _damaged_missing(r: str, t: str) -> str:
    return _missing(r, "b_growth" if t == "b_damaged_growth" else t)


SQL_DAMAGED_COLUMNS = _each(_columns, DAMAGED_CTES) + " UNION ALL " + _absent_sql("Columns: key_kpis")
SQL_DAMAGED = " UNION ALL ".join(
    [
        *[_each(block, DAMAGED_CTES) for block in (_exists, _duplicates, _non_empty, _damaged_missing)],
        SQL_DAMAGED_COLUMNS,
        _absent_sql(
            "Stage 3 file exists: key_kpis.csv", "Duplicates: key_kpis", "Non-empty output: key_kpis", "Missing values: key_kpis"
        ),
        _reconcile(str(LATEST), "b_damaged_annual", LATEST), _reconcile(f"{P} YTD", "b_ytd", P),
        _coverage("b_damaged_county"), SQL_SHARES, SQL_CHANGE, SQL_PLANNING, SQL_RATES, SQL_CORR,
    ]
)


@query("qa_columns", SQL_COLUMNS)
def qa_columns(spark, d):
    found, _, last = written_reports(spark, d)
    return quality.qa_columns(found, schemas.report_schemas(B0, last), YEARS)


@query("qa_columns_damaged", SQL_DAMAGED_COLUMNS.rpartition(" UNION ALL ")[0])
def qa_columns_damaged(spark, d):
    found, _, last = written_reports(spark, d, damage)
    return quality.qa_columns(found, schemas.report_schemas(B0, last), YEARS)


@query("qa_report_damaged", SQL_DAMAGED)
def qa_report_damaged(spark, d):
    found, marts, last = written_reports(spark, d, damage)
    return quality.qa_report(found, marts, YEARS, last)


@query("qa_file_exists", SQL_EXISTS)
def qa_file_exists(spark, d):
    found, _, last = written_reports(spark, d)
    expected = list(schemas.report_schemas(B0, last))
    return quality.qa_file_exists(found, expected, quality.report_files(YEARS, last), YEARS)


@query("qa_duplicates", SQL_DUPLICATES)
def qa_duplicates(spark, d):
    return quality.qa_duplicates(written_reports(spark, d)[0], YEARS)


@query("qa_non_empty", SQL_NON_EMPTY)
def qa_non_empty(spark, d):
    return quality.qa_non_empty(written_reports(spark, d)[0], YEARS)


@query("qa_missing", SQL_MISSING)
def qa_missing(spark, d):
    return quality.qa_missing(written_reports(spark, d)[0], YEARS)


@query("qa_market_reconcile", SQL_MARKET)
def qa_market_reconcile(spark, d):
    monthly = materialise(b.monthly(spark, d), "monthly")
    last = reports.latest_year(reports.by_year(monthly), F.col("year"), YEARS)
    found = {
        "annual_market": reports.annual_market_summary(monthly, YEARS),
        "market_ytd": reports.market_ytd(monthly, YEARS),
    }
    return quality.qa_market_reconcile(found, monthly, YEARS, last)


@query("qa_county_coverage", SQL_COVERAGE)
def qa_county_coverage(spark, d):
    county = b.stored_county(spark, d)
    last = reports.comparison_year(county, YEARS)
    return quality.qa_county_coverage(reports.county_market_latest(county, YEARS), county, last)


@query("qa_mix_shares", SQL_SHARES)
def qa_mix_shares(spark, d):
    latest = reports.county_market_latest(b.stored_county(spark, d), YEARS)
    return quality.qa_mix_shares(reports.county_property_mix(latest))


@query("qa_price_change", SQL_CHANGE)
def qa_price_change(spark, d):
    county = b.stored_county(spark, d)
    last = reports.comparison_year(county, YEARS)
    return quality.qa_price_change(reports.county_price_change(county, YEARS, last), YEARS, last)


def _planning_and_latest(spark, d):
    planning = b.stored_planning(spark, d)
    return planning, reports.latest_year(reports.by_year(planning), F.col("year"), YEARS)


@query("qa_planning_total", SQL_PLANNING)
def qa_planning_total(spark, d):
    planning, last = _planning_and_latest(spark, d)
    return quality.qa_planning_total(reports.annual_planning(planning, YEARS), planning, last)


@query("qa_rates", SQL_RATES)
def qa_rates(spark, d):
    planning, last = _planning_and_latest(spark, d)
    return quality.qa_rates(reports.annual_planning(planning, YEARS), last)


@query("qa_corr_observations", SQL_CORR)
def qa_corr_observations(spark, d):
    marts = b.marts(spark, d).written()
    report = reports.market_planning_correlation(marts.monthly, marts.planning)
    return quality.qa_corr_observations(report, marts)


def _report(spark, d):
    found, marts, last = written_reports(spark, d)
    return quality.qa_report(found, marts, YEARS, last)


@query("qa_report", SQL_REPORT)
def qa_report(spark, d):
    return _report(spark, d)


@query(
    "qa_summary",
    f"""SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
    count(*) FILTER (WHERE status = 'FAIL') AS failed,
    CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'REVIEW REQUIRED' END AS overall_status
    FROM ({SQL_REPORT})""",
)
def qa_summary(spark, d):
    return quality.qa_summary(_report(spark, d))


# ---- table tests ---------------------------------------------------------------
def _tables(spark, d):
    """Staging tables and marts, written once, one after another: side by side, the exchanges of all of them lie on disk at once."""
    builds = {
        "stg_ppr_transactions": lambda: stg_tx(spark, d),
        "stg_rppi_series": lambda: stg_index(spark, d),
        "stg_planning_applications": lambda: stg_planning(spark, d),
        "monthly_market": lambda: materialise(b.monthly(spark, d), "monthly"),
        "county_market": lambda: b.stored_county(spark, d),
        "planning_activity": lambda: b.stored_planning(spark, d),
        "property_market_summary": lambda: summary_mart(spark, d),
    }
    return {name: build() for name, build in builds.items()}


SQL_TABLES = {
    "stg_ppr_transactions": "b_stg_tx",
    "stg_rppi_series": "b_stg_ix",
    "stg_planning_applications": "b_stg_pl",
    "monthly_market": "b_monthly",
    "county_market": "b_county",
    "planning_activity": "b_planning",
    "property_market_summary": "b_summary",
}


def _failing(name: str, count: str) -> str:
    return _check(f"'{name}'", "n = 0", "'0 failing rows'", f"{_n('n')} || ' failing rows'", f"({count})")


def _null_sql(tests) -> str:
    return " UNION ALL ".join(
        _failing(f"not_null: {t}.{c}", f"SELECT count(*) AS n FROM {SQL_TABLES[t]} WHERE {c} IS NULL")
        for t, columns in tests.items()
        for c in columns
    )


def _unique_sql(tests) -> str:
    parts = []
    for t, keys in tests.items():
        for key in keys:
            label = f"({', '.join(key)})" if len(key) > 1 else key[0]
            known = " AND ".join(f"{k} IS NOT NULL" for k in key)
            parts.append(
                _failing(
                    f"unique: {t}.{label}",
                    f"""SELECT count(*) AS n FROM (SELECT {', '.join(key)} FROM {SQL_TABLES[t]} WHERE {known}
                    GROUP BY ALL HAVING count(*) > 1)""",
                )
            )
    return " UNION ALL ".join(parts)


@query("test_not_null", _null_sql(quality.NOT_NULL_TESTS))
def not_null(spark, d):
    return quality.check_not_null(_tables(spark, d))


@query("test_unique", _unique_sql(quality.UNIQUE_TESTS))
def unique(spark, d):
    return quality.check_unique(_tables(spark, d))


@query(
    "constraint_checks",
    _null_sql(quality.NOT_NULL_CONSTRAINTS) + " UNION ALL " + _unique_sql(quality.KEY_CONSTRAINTS),
)
def constraint_checks(spark, d):
    return quality.constraint_checks(_tables(spark, d))


@query(
    "source_range",
    """SELECT min(sale_date) AS ppr_start_date, max(sale_date) AS ppr_end_date, count(*) AS transactions,
    CAST(sum(price_eur) AS DECIMAL(28,2)) AS total_value FROM b_tx""",
)
def source_range(spark, d):
    return quality.source_range(b.tx(spark, d, "sale_date", "price_eur"))
