import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from landledger import schemas
from landledger.plans import quality, reports
from landledger.plans.reports import Marts, Years

YEARS = Years(2026, 2010)


@pytest.fixture(scope="module")
def inputs(spark):
    months = [(y, m) for y in (2010, 2025, 2026) for m in (1, 2, 3)]
    monthly = spark.createDataFrame(
        [(f"{y}-{m:02d}", dt.date(y, m, 1), 10 + m, D(1000 * m), D(100 + m), D(90 + m * m), D(y - 1900) + m * m if y < 2026 else None) for y, m in months],
        schemas.MONTHLY_MARKET,
    )
    county = spark.createDataFrame(
        [(c, y, 5, D(500), D(100 + y - 2000), D(90), 2, 3) for c in ("A", "B") for y in (2010, 2025)], schemas.COUNTY_MARKET
    )
    planning = spark.createDataFrame(
        [("X", f"{y}-{m:02d}", dt.date(y, m, 1), 8 + m, 4 + m, m, D(2 * m)) for y, m in months], schemas.PLANNING_ACTIVITY
    )
    marts = Marts(monthly, county, planning)
    return reports.all_reports(marts, YEARS), marts


def statuses(df):
    return {r.check_name: (r.status, r.details) for r in df.collect()}


def test_sound_reports_pass_all_61_checks(inputs):
    found, marts = inputs
    report = quality.qa_report(found, marts, YEARS, 2025)
    got = statuses(report)
    assert len(got) == 61 and {s for s, _ in got.values()} == {"PASS"}
    assert got["2025 transaction reconciliation"][1] == "36 transactions"
    assert got["2025 transaction-value reconciliation"][1] == "€6,000.00"
    assert got["Missing values: price_growth"][1] == "3 missing values (review required)"
    summary = quality.qa_summary(report).first()
    assert (summary.total_checks, summary.failed, summary.overall_status) == (61, 0, "PASS")


def test_absent_report_fails_instead_of_stopping(inputs):
    found, marts = inputs
    fewer = {n: df for n, df in found.items() if n not in ("annual_market", "county_price_change")}
    got = statuses(quality.qa_report(fewer, marts, YEARS, 2025))
    assert len(got) == 61
    assert got["Stage 3 file exists: annual_market_summary.csv"] == ("FAIL", "Missing file: annual_market_summary.csv")
    assert got["Columns: annual_market"] == ("FAIL", "Missing file: annual_market_summary.csv")
    for name in ("2025 transaction", "2025 transaction-value", "2026 YTD transaction", "2026 YTD transaction-value"):
        assert got[f"{name} reconciliation"] == ("FAIL", "Missing reports: ['annual_market']")
    assert got["County 2010-2025 price-change calculation"][0] == "FAIL"


def test_no_report_at_all(inputs):
    _, marts = inputs
    got = statuses(quality.qa_report({}, marts, YEARS, 2025))
    assert len(got) == 61 and {s for s, _ in got.values()} == {"FAIL"}
    expected = list(schemas.report_schemas(2010, 2025))
    rows = quality.qa_file_exists({}, expected, quality.report_files(YEARS, 2025), YEARS).collect()
    assert len(rows) == 10 and {r.status for r in rows} == {"FAIL"}


def test_damaged_files_end_as_fail_rows(spark, inputs, tmp_path):
    from landledger.sources import readers, writers

    found, marts = inputs
    writers.sink_reports(found, str(tmp_path))

    def rewrite(report, text):
        for old in (tmp_path / report).iterdir():
            old.unlink()
        (tmp_path / report / "part.csv").write_text(text)

    rewrite("key_kpis", "wrong_a,value,unit\na,1,x\n")
    rewrite("price_growth", "year,avg_mean_price\n2020\n")  # too short a row
    rewrite("annual_planning", "year,applications\nabc,1\n")  # a text in a number's place
    scanned = readers.scan_reports(spark, str(tmp_path), schemas.report_schemas(2010, 2025))
    assert set(scanned.problems) == {"price_growth", "annual_planning"}
    got = statuses(quality.qa_report(scanned, marts, YEARS, 2025))
    assert len(got) == 61
    assert got["Columns: key_kpis"] == ("FAIL", "Missing columns: ['kpi']")
    assert got["Stage 3 file exists: price_growth.csv"][1].startswith("Unreadable file: price_growth.csv")
    assert got["2025 planning applications"][0] == got["Planning refusal-rate calculation"][0] == "FAIL"
    assert got["2025 transaction reconciliation"][0] == "PASS"


def test_wrong_figures_fail(inputs):
    found, marts = inputs
    bad = dict(found)
    bad["annual_market"] = found["annual_market"].withColumn("transactions", F.col("transactions") + 1)
    bad["county_property_mix"] = found["county_property_mix"].withColumn("new_property_share_pct", F.lit(41.0))
    bad["county_price_change"] = found["county_price_change"].withColumn("price_change_pct", F.lit(1.0))
    bad["county_market"] = found["county_market"].withColumn("county", F.when(F.col("county") == "A", "Z").otherwise(F.col("county")))
    bad["annual_planning"] = found["annual_planning"].withColumn("grant_rate_pct", F.lit(1.5)).withColumn("applications", F.col("applications") * 2)
    bad["market_planning_correlation"] = found["market_planning_correlation"].withColumn("observations", F.lit(1).cast("bigint"))
    bad["key_kpis"] = found["key_kpis"].unionByName(found["key_kpis"].limit(1))
    got = statuses(quality.qa_report(bad, marts, YEARS, 2025))
    assert got["2025 transaction reconciliation"] == ("FAIL", "Source=36, Output=37")
    assert got["2025 transaction-value reconciliation"][0] == "PASS"
    assert got["County property-mix shares"] == ("FAIL", "2 invalid rows")
    assert got["County 2010-2025 price-change calculation"][0] == "FAIL"
    assert got["2025 county coverage"] == ("FAIL", "Missing={A}; Extra={Z}")
    assert got["2025 planning applications"] == ("FAIL", "Source=30, Output=60")
    assert got["Planning grant-rate calculation"] == ("FAIL", "Expected=30.00%, Actual=1.50%")
    assert got["Correlation observation count"][0] == "FAIL"
    assert "transactions vs applications: Expected=9, Found=1" in got["Correlation observation count"][1]
    assert got["Duplicates: key_kpis"] == ("FAIL", "1 duplicate rows")


def test_missing_column_and_empty_report(inputs):
    found, marts = inputs
    bad = {**found, "price_growth": found["price_growth"].drop("avg_rppi"), "key_kpis": found["key_kpis"].limit(0)}
    expected = schemas.report_schemas(2010, 2025)
    assert statuses(quality.qa_columns(bad, expected, YEARS))["Columns: price_growth"][0] == "FAIL"
    assert statuses(quality.qa_non_empty(bad, YEARS))["Non-empty output: key_kpis"] == ("FAIL", "CSV contains no rows")


def test_null_and_unique_tests(spark):
    table = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    got = statuses(quality.check_not_null({"t": table}, {"t": ["k", "v"]}))
    assert got == {"not_null: t.k": ("FAIL", "2 failing rows"), "not_null: t.v": ("PASS", "0 failing rows")}
    got = statuses(quality.check_unique({"t": table}, {"t": [["k"], ["k", "v"]]}))
    # rows without a key are left out
    assert got == {"unique: t.k": ("FAIL", "1 failing rows"), "unique: t.(k, v)": ("PASS", "0 failing rows")}


def test_declared_tests_count():
    assert sum(len(c) for c in quality.NOT_NULL_TESTS.values()) == 22
    assert sum(len(k) for k in quality.UNIQUE_TESTS.values()) == 5
