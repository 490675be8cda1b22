"""Data-quality checks as rows (check_name, status, details)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger import schemas
from landledger.functions.numbers import ratio_pct, round_even
from landledger.operators.id_bitmaps import repeated_ids
from landledger.plans.reports import (
    MARKET_METRICS,
    PLANNING_METRICS,
    Marts,
    Years,
    by_year,
    market_with_planning,
    total_of,
)
from landledger.sources.snapshots import Figures

# The covered period is informative only; no check asks for it.
_OPTIONAL_COLUMNS = {"period_start", "period_end"}


def report_files(years: Years, latest: int) -> dict[str, str]:
    """File names (fixed values) the checks of the ten reports are named by."""
    return {
        "annual_market": "annual_market_summary.csv",
        f"market_{years.partial}_ytd": f"market_{years.partial}_ytd.csv",
        "price_growth": "price_growth.csv",
        "county_market": f"county_market_{latest}.csv",
        "county_price_change": f"county_price_change_{years.baseline}_{latest}.csv",
        "county_property_mix": f"county_property_mix_{latest}.csv",
        "annual_planning": "annual_planning_activity.csv",
        "planning_authority": f"planning_authority_{latest}.csv",
        "market_planning_correlation": "market_planning_correlation.csv",
        "key_kpis": "key_kpis.csv",
    }


def _check_name(report: str, years: Years) -> str:
    return f"market_{years.partial}_ytd" if report == "market_ytd" else report


def _result(name: Column | str, passed: Column, good: Column, bad: Column) -> list[Column]:
    name = F.lit(name) if isinstance(name, str) else name
    ok = F.coalesce(passed, F.lit(False))
    return [
        name.alias("check_name"),
        F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.when(ok, good).otherwise(bad).alias("details"),
    ]


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def grouped(n: Column) -> Column:
    """Whole number with thousands commas."""
    return F.format_number(n.cast("decimal(38,0)"), 0)


def euros(amount: Column) -> Column:
    return F.concat(F.lit("€"), F.format_number(amount.cast("decimal(28,2)"), 2))


# ---- shape checks on the ten report tables ------------------------------

_ROWS = "check_name string, status string, details string"


def _failed(names: Sequence[str], details: str) -> list[tuple[str, str, str]]:
    return [(name, "FAIL", details) for name in names]


# Names and texts of the shape checks.
# kind -> (check name prefix, passed, details when passed, details when failed)
_SHAPE_CHECKS = {
    "exists": ("Stage 3 file exists: ", "true", "concat(format_number(n, 0), ' rows')", "''"),
    "duplicates": (
        "Duplicates: ", "extra = 0", "'No duplicate rows'", "concat(format_number(extra, 0), ' duplicate rows')",
    ),
    "non_empty": ("Non-empty output: ", "n > 0", "concat(format_number(n, 0), ' rows')", "'CSV contains no rows'"),
    # always passes; the details ask for review
    "missing": (
        "Missing values: ", "true",
        "IF(gaps = 0, 'No missing values', concat(gaps, ' missing values (review required)'))", "''",
    ),
}


def _shape_checks(
    reports: Mapping[str, DataFrame], kinds: Sequence[str], labels: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """Rows of the asked kinds for every report.

    The reports are small and differ in columns, so their rows become one table
    of (report, row text, missing cells): one aggregation serves them all.
    """
    spark = SparkSession.active()
    if not reports:
        return spark.createDataFrame([], _ROWS)
    cells = []
    for name, df in reports.items():
        gaps = " + ".join(f"IF(`{c}` IS NULL, 1, 0)" for c in df.columns)
        text = "to_json(struct(*), map('ignoreNullFields', 'false'))"
        cells.append(df.selectExpr(f"'{name}' AS report", f"{text} AS content", f"{gaps} AS gaps"))
    seen = (
        union_all(cells)
        .groupBy("report", "content")
        .agg(F.expr("count(1) AS copies"), F.expr("any_value(gaps) AS gaps"))
        .groupBy("report")
        .agg(
            F.expr("sum(copies) AS n"),
            F.expr("sum(copies - 1) AS extra"),
            F.expr("sum(gaps * copies) AS gaps"),
        )
    )
    named = [(kind, name, labels.get(kind, {}).get(name, name)) for kind in kinds for name in reports]
    names = spark.createDataFrame(named, "kind string, report string, label string")
    # a report without rows is not among the seen ones
    counted = names.join(seen, "report", "left").fillna(0, ["n", "extra", "gaps"])

    def by_kind(part: int) -> str:
        return "CASE kind " + " ".join(f"WHEN '{k}' THEN {_SHAPE_CHECKS[k][part]}" for k in kinds) + " END"

    prefix = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{_SHAPE_CHECKS[k][0]}'" for k in kinds) + " END"
    return counted.selectExpr(
        f"concat({prefix}, label) AS check_name",
        f"IF({by_kind(1)}, 'PASS', 'FAIL') AS status",
        f"IF({by_kind(1)}, {by_kind(2)}, {by_kind(3)}) AS details",
    )


def _labels(reports: Mapping[str, DataFrame], years: Years) -> dict[str, dict[str, str]]:
    named = {name: _check_name(name, years) for name in reports}
    return {kind: named for kind in _SHAPE_CHECKS}


def _not_read(
    reports: Mapping[str, DataFrame], expected: Sequence[str], files: Mapping[str, str], years: Years, kinds: Sequence[str]
) -> DataFrame:
    """FAIL rows of the asked kinds for every report that is absent or cannot be read."""
    problems, rows = getattr(reports, "problems", {}), []
    for report in expected:
        if report in reports:
            continue
        name, file = _check_name(report, years), files[_check_name(report, years)]
        details = f"Unreadable file: {file}: {problems[report]}" if report in problems else f"Missing file: {file}"
        prefixes = {kind: _SHAPE_CHECKS[kind][0] for kind in _SHAPE_CHECKS} | {"columns": "Columns: "}
        rows += _failed([prefixes[kind] + (file if kind == "exists" else name) for kind in kinds], details)
    return SparkSession.active().createDataFrame(rows, _ROWS)


def _file_labels(reports, files, years) -> dict[str, dict[str, str]]:
    return {"exists": {name: files[_check_name(name, years)] for name in reports}}


def qa_file_exists(
    reports: Mapping[str, DataFrame], expected: Sequence[str], files: Mapping[str, str], years: Years
) -> DataFrame:
    """One row per expected report with its row count; an absent or unreadable report fails."""
    present = _shape_checks(reports, ["exists"], _file_labels(reports, files, years))
    return present.unionByName(_not_read(reports, expected, files, years, ["exists"]))


def _missing_columns(report: DataFrame, expected: T.StructType) -> list[str]:
    wanted = [c for c in expected.fieldNames() if c not in _OPTIONAL_COLUMNS]
    return [c for c in wanted if c not in report.columns]


def qa_columns(
    reports: Mapping[str, DataFrame], expected: Mapping[str, T.StructType], years: Years
) -> DataFrame:
    """Expected columns present, by the names the reports carry: one literal row per report."""
    rows = []
    for name, df in reports.items():
        missing = _missing_columns(df, expected[name])
        details = f"Missing columns: {missing}" if missing else "All expected columns present"
        rows.append((f"Columns: {_check_name(name, years)}", "FAIL" if missing else "PASS", details))
    return SparkSession.active().createDataFrame(rows, _ROWS)


def qa_duplicates(reports: Mapping[str, DataFrame], years: Years) -> DataFrame:
    return _shape_checks(reports, ["duplicates"], _labels(reports, years))


def qa_non_empty(reports: Mapping[str, DataFrame], years: Years) -> DataFrame:
    return _shape_checks(reports, ["non_empty"], _labels(reports, years))


def qa_missing(reports: Mapping[str, DataFrame], years: Years) -> DataFrame:
    return _shape_checks(reports, ["missing"], _labels(reports, years))


# ---- recomputation checks -----------------------------------------------

def _source_output(source: Column, output: Column, show) -> tuple[Column, Column]:
    def shown(c: Column) -> Column:
        return F.coalesce(show(c), F.lit("none"))

    return shown(source), F.concat(
        F.lit("Source="), shown(source), F.lit(", Output="), shown(output)
    )


def _rows_of(df: DataFrame, checks: Sequence[Sequence[Column]]) -> DataFrame:
    """Several checks of a one-row table as rows, from one evaluation of it."""
    return df.select(F.inline(F.array(*[F.struct(*check) for check in checks])))


def qa_market_reconcile(
    reports: Mapping[str, DataFrame], monthly: DataFrame, years: Years, latest: int
) -> DataFrame:
    """Counts and values of the latest completed and the partial year; the mart is read once."""
    compared = [
        (0, latest, "annual_market", f"{latest}"),
        (1, years.partial, "market_ytd", f"{years.partial} YTD"),
    ]

    def of_year(year: int, c: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("year") == year, F.col(c))), F.lit(0))

    both = by_year(monthly).agg(
        *[of_year(year, "transactions").alias(f"s_n{i}") for i, year, _, _ in compared],
        *[of_year(year, "total_value").cast("decimal(28,2)").alias(f"s_v{i}") for i, year, _, _ in compared],
    )
    checks = []
    for i, year, report, label in compared:
        output = (
            reports[report]
            .filter(F.col("year") == year)
            .agg(F.max("transactions").alias(f"o_n{i}"), F.max("total_value").alias(f"o_v{i}"))
        )
        both = both.join(F.broadcast(output))
        for kind, s, o, show, suffix in (
            ("transaction", f"s_n{i}", f"o_n{i}", grouped, " transactions"),
            ("transaction-value", f"s_v{i}", f"o_v{i}", euros, ""),
        ):
            good, bad = _source_output(F.col(s), F.col(o), show)
            checks.append(
                _result(
                    f"{label} {kind} reconciliation",
                    F.col(s) == F.col(o).cast("decimal(28,2)"),
                    F.concat(good, F.lit(suffix)),
                    bad,
                )
            )
    return _rows_of(both, checks)


def qa_county_coverage(report: DataFrame, county: DataFrame, latest: int) -> DataFrame:
    """Counties of the latest year on both sides; each side is read once."""
    source = county.filter(F.col("sale_year") == latest)
    sides = (
        source.select("county", F.lit(1).alias("s"), F.lit(0).alias("r"))
        .unionByName(report.select("county", F.lit(0).alias("s"), F.lit(1).alias("r")))
        .filter(F.col("county").isNotNull())
        .groupBy("county")
        .agg(F.max("s").alias("s"), F.max("r").alias("r"))
    )
    return sides.agg(
        F.count_if(F.col("s") == 1).alias("n"),
        F.sort_array(F.collect_set(F.when(F.col("r") == 0, F.col("county")))).alias("m"),
        F.sort_array(F.collect_set(F.when(F.col("s") == 0, F.col("county")))).alias("x"),
    ).select(
        *_result(
            f"{latest} county coverage",
            (F.size("m") == 0) & (F.size("x") == 0),
            F.concat(F.col("n").cast("string"), F.lit(" counties")),
            F.concat(
                F.lit("Missing={"), F.array_join("m", ", "), F.lit("}; Extra={"),
                F.array_join("x", ", "), F.lit("}"),
            ),
        )
    )


def qa_mix_shares(mix: DataFrame) -> DataFrame:
    share = F.col("new_property_share_pct") + F.col("second_hand_property_share_pct")
    bad = F.count_if((share < 99.99) | (share > 100.01))
    return mix.agg(
        *_result(
            "County property-mix shares",
            bad == 0,
            F.lit("Shares sum to approximately 100%"),
            F.concat(bad.cast("string"), F.lit(" invalid rows")),
        )
    )


def qa_price_change(report: DataFrame, years: Years, latest: int) -> DataFrame:
    base, last = F.col(f"mean_price_{years.baseline}"), F.col(f"mean_price_{latest}")
    expected = ratio_pct(last - base, base)
    wrong = F.count_if(~expected.eqNullSafe(round_even("price_change_pct", 2)))
    return report.agg(
        *_result(
            f"County {years.baseline}-{latest} price-change calculation",
            wrong == 0,
            F.lit("Calculations reconcile"),
            F.lit("Calculated percentages do not reconcile"),
        )
    )


def qa_planning_total(report: DataFrame, planning: DataFrame, latest: int) -> DataFrame:
    source = (
        by_year(planning).filter(F.col("year") == latest).agg(total_of("applications").alias("s"))
    )
    output = report.filter(F.col("year") == latest).agg(F.max("applications").alias("o"))
    good, bad = _source_output(F.col("s"), F.col("o"), grouped)
    return source.join(F.broadcast(output)).select(
        *_result(
            f"{latest} planning applications",
            F.col("s") == F.col("o"),
            F.concat(good, F.lit(" applications")),
            bad,
        )
    )


def qa_rates(report: DataFrame, latest: int) -> DataFrame:
    row = report.filter(F.col("year") == latest).agg(
        *[F.max(c).alias(c) for c in report.columns if c != "year"]
    )

    def pct(c: Column) -> Column:
        return F.coalesce(F.format_string("%.2f%%", c), F.lit("none"))

    checks = []
    for kind, part in (("grant", "granted_applications"), ("refusal", "refused_applications")):
        expected = ratio_pct(part, "applications")
        actual = round_even(f"{kind}_rate_pct", 2)
        checks.append(
            _result(
                f"Planning {kind}-rate calculation",
                expected == actual,
                pct(actual),
                F.concat(F.lit("Expected="), pct(expected), F.lit(", Actual="), pct(actual)),
            )
        )
    return _rows_of(row, checks)


def qa_corr_observations(report: DataFrame, marts: Marts) -> DataFrame:
    merged = market_with_planning(marts.monthly, marts.planning)
    pairs = [(a, b) for a in MARKET_METRICS for b in PLANNING_METRICS]
    counts = merged.agg(
        *[
            F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"_{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    expected = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("market_metric"),
                        F.lit(b).alias("planning_metric"),
                        F.col(f"_{i}").alias("expected"),
                    )
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        )
    )
    line = F.format_string(
        "%s vs %s: Expected=%d, Found=%d",
        "market_metric", "planning_metric", "expected", "observations",
    )
    wrong = F.sort_array(
        F.collect_list(F.when(F.col("expected") != F.col("observations"), line))
    )
    return report.join(F.broadcast(expected), ["market_metric", "planning_metric"]).agg(
        *_result(
            "Correlation observation count",
            F.size(wrong) == 0,
            F.lit("Observation counts match pairwise complete-data calculations"),
            F.array_join(wrong, "; "),
        )
    )


def qa_report(
    reports: Mapping[str, DataFrame], marts: Marts, years: Years, latest: int
) -> DataFrame:
    """All 61 checks, always.

    Checks of a report that is absent, cannot be read or lacks columns fail instead
    of stopping the run.
    """
    expected = schemas.report_schemas(years.baseline, latest)
    files = report_files(years, latest)
    kinds = list(_SHAPE_CHECKS)
    parts = [
        _shape_checks(reports, kinds, {**_labels(reports, years), **_file_labels(reports, files, years)}),
        _not_read(reports, list(expected), files, years, [*kinds, "columns"]),
        qa_columns(reports, expected, years),
    ]
    # Names of the recomputation checks.
    market = [
        f"{label} {kind} reconciliation"
        for label in (latest, f"{years.partial} YTD")
        for kind in ("transaction", "transaction-value")
    ]
    recomputed = [
        (["annual_market", "market_ytd"], market,
         lambda: qa_market_reconcile(reports, marts.monthly, years, latest)),
        (["county_market"], [f"{latest} county coverage"],
         lambda: qa_county_coverage(reports["county_market"], marts.county, latest)),
        (["county_property_mix"], ["County property-mix shares"],
         lambda: qa_mix_shares(reports["county_property_mix"])),
        (["county_price_change"], [f"County {years.baseline}-{latest} price-change calculation"],
         lambda: qa_price_change(reports["county_price_change"], years, latest)),
        (["annual_planning"], [f"{latest} planning applications"],
         lambda: qa_planning_total(reports["annual_planning"], marts.planning, latest)),
        (["annual_planning"], ["Planning grant-rate calculation", "Planning refusal-rate calculation"],
         lambda: qa_rates(reports["annual_planning"], latest)),
        (["market_planning_correlation"], ["Correlation observation count"],
         lambda: qa_corr_observations(reports["market_planning_correlation"], marts)),
    ]
    failed = []
    for needed, names, build in recomputed:
        absent = [n for n in needed if n not in reports]
        short = [n for n in needed if n in reports and _missing_columns(reports[n], expected[n])]
        if absent:
            failed += _failed(names, f"Missing reports: {absent}")
        elif short:
            failed += _failed(names, f"Reports without their columns: {short}")
        else:
            parts.append(build())
    return union_all([*parts, SparkSession.active().createDataFrame(failed, _ROWS)])


def qa_summary(report: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAIL")
    return report.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        failed.alias("failed"),
        F.when(failed == 0, "PASS").otherwise("REVIEW REQUIRED").alias("overall_status"),
    )


# ---- table tests ----------------------------------------------------------

# The declared not-null and unique columns, and the stricter
# not-null and key columns of the table definitions.
NOT_NULL_TESTS = {
    "stg_ppr_transactions": ["ppr_id", "sale_date", "sale_year_month", "county", "price_eur"],
    "stg_rppi_series": ["rppi_id", "month_start", "year_month", "property_series"],
    "stg_planning_applications": ["planning_id"],
    "monthly_market": ["year_month", "month_start", "transactions", "total_value"],
    "county_market": ["county", "sale_year", "transactions"],
    "planning_activity": ["planning_authority", "year_month", "month_start", "applications"],
    "property_market_summary": ["metric_name"],
}
UNIQUE_TESTS = {
    "stg_ppr_transactions": [["ppr_id"]],
    "stg_rppi_series": [["rppi_id"]],
    "stg_planning_applications": [["planning_id"]],
    "monthly_market": [["year_month"]],
    "property_market_summary": [["metric_name"]],
}
NOT_NULL_CONSTRAINTS = {
    "stg_ppr_transactions": [
        "ppr_id", "sale_date", "sale_year", "sale_month", "sale_quarter", "sale_year_month",
        "address", "county", "price_eur", "is_not_full_market_price", "is_vat_exclusive",
        "is_new_property", "is_second_hand_property",
    ],
    "stg_rppi_series": [
        "rppi_id", "month_start", "year", "month_number", "quarter", "year_month",
        "property_series",
    ],
    "stg_planning_applications": ["planning_id"],
    "monthly_market": ["year_month", "month_start", "transactions", "total_value"],
    "county_market": [
        "county", "sale_year", "transactions", "total_value", "new_property_transactions",
        "second_hand_property_transactions",
    ],
    "planning_activity": [
        "planning_authority", "year_month", "month_start", "applications",
        "granted_applications", "refused_applications",
    ],
    "property_market_summary": ["metric_name"],
}
KEY_CONSTRAINTS = {
    "stg_ppr_transactions": [["ppr_id"]],
    "stg_rppi_series": [["rppi_id"]],
    "stg_planning_applications": [["planning_id"]],
    "monthly_market": [["year_month"]],
    "county_market": [["county", "sale_year"]],
    "planning_activity": [["planning_authority", "year_month"]],
    "property_market_summary": [["metric_name"]],
}


def _failures(name: Column, failing: Column) -> list[Column]:
    return _result(
        name, failing == 0, F.lit("0 failing rows"), F.concat(grouped(failing), F.lit(" failing rows"))
    )


def check_not_null(tables: Mapping[str, DataFrame], tests=None) -> DataFrame:
    """Null counts of the listed columns, one scan per table."""
    parts = []
    for table, columns in (tests or NOT_NULL_TESTS).items():
        if table not in tables:
            continue
        counts = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        pairs = [
            F.struct(F.lit(f"not_null: {table}.{c}").alias("name"), F.col(c).alias("n"))
            for c in columns
        ]
        parts.append(
            counts.select(F.inline(F.array(*pairs))).select(*_failures(F.col("name"), F.col("n")))
        )
    return union_all(parts)


def recorded_not_null(spark: SparkSession, figures: Mapping[str, Figures], tests=None) -> DataFrame:
    """``check_not_null`` from the figures that were gathered while the tables were written; reads no table."""
    rows = [
        (f"not_null: {table}.{c}", figures[table].nulls[c])
        for table, columns in (tests or NOT_NULL_TESTS).items()
        if table in figures
        for c in columns
    ]
    return spark.createDataFrame(rows, "name string, n long").select(*_failures(F.col("name"), F.col("n")))


def check_unique(tables: Mapping[str, DataFrame], tests=None) -> DataFrame:
    """Key values held by more than one row; rows with a null key part are left out.

    Whole-number keys are told by bitmaps: see ``repeated_ids``.
    """
    parts = []
    for table, keys in (tests or UNIQUE_TESTS).items():
        if table not in tables:
            continue
        for key in keys:
            df = tables[table]
            if len(key) == 1 and isinstance(df.schema[key[0]].dataType, (T.IntegerType, T.LongType)):
                repeated = repeated_ids(df, key[0])
            else:
                repeated = df.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            name = F.lit(f"unique: {table}.({', '.join(key)})" if len(key) > 1 else f"unique: {table}.{key[0]}")
            parts.append(repeated.agg(F.count(F.lit(1)).alias("n")).select(*_failures(name, F.col("n"))))
    return union_all(parts)


def constraint_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    return check_not_null(tables, NOT_NULL_CONSTRAINTS).unionByName(
        check_unique(tables, KEY_CONSTRAINTS)
    )


def source_range(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.min("sale_date").alias("ppr_start_date"),
        F.max("sale_date").alias("ppr_end_date"),
        F.count(F.lit(1)).alias("transactions"),
        F.sum(F.col("price_eur").cast("decimal(28,2)")).cast("decimal(28,2)").alias("total_value"),
    )
