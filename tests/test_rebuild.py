"""Source files to layers, reports, exploration tables and the quality report."""

import json

import pytest
from pyspark.sql import functions as F

from landledger import schemas, storage
from landledger.plans import cleaning, exploration, quality, reports
from landledger.plans.marts import NATIONAL_SERIES, NATIONAL_UNIT
from landledger.plans.rebuild import TABLE_TESTS, Sources, explore, rebuild, save_quality_report
from landledger.storage import fresh_path, materialise, release, scratch
from landledger.plans.reports import Marts, Years
from landledger.sources import readers, writers

YEARS = Years(partial=2012, baseline=2010)
NEW, OLD = "New Dwelling house /Apartment", "Second-Hand Dwelling house /Apartment"
MONTH_NAMES = ["January", "February", "March"]
PERIODS = [(y, m) for y in (2010, 2011, 2012) for m in (1, 2, 3)]


def register_lines():
    yield ",".join(schemas.REGISTER_SOURCE_COLUMNS)
    for n, (y, m) in enumerate(PERIODS):
        for k, county in enumerate(["DUBLIN", " cork "]):
            price = f'"€{(n + 1) * 10_000 + k * 1500 + m:,}.50"'
            line = f"0{m}/0{m}/{y},{n}-{k},{county},,{price},No,Yes,{NEW if k else OLD},less than 38 sq metres"
            yield line
            if n == 0:
                yield line  # an exact copy


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    (landing / "register.csv").write_bytes("\n".join(register_lines()).encode("cp1252"))
    (landing / "index").mkdir()
    index = [",".join(schemas.INDEX_SOURCE_COLUMNS)]
    index += [f"RPI,{y} {MONTH_NAMES[m - 1]},{NATIONAL_SERIES},{NATIONAL_UNIT},{100 + y - 2010 + m * m}" for y, m in PERIODS[:-1]]
    (landing / "index" / "index.csv").write_text("\n".join(index))
    (landing / "pages").mkdir()
    features = [
        {"attributes": {"OBJECTID": i, "PlanningAuthority": f" A{i % 2} ", "Decision": ["granted", "Refused", None][i % 3],
                        "NumResidentialUnits": i, "ReceivedDate": (1262304000 + (y - 2010) * 31557600 + (m - 1) * 2678400) * 1000}}
        for i, (y, m) in enumerate(PERIODS * 2)
    ]
    (landing / "pages" / "0.json").write_text(json.dumps({"features": features}))
    sources = Sources(
        readers.scan_tx_csv(spark, str(landing / "register.csv")),
        readers.scan_index_csv(spark, str(landing / "index")),
        readers.scan_feature_pages(spark, str(landing / "pages")),
    )
    return rebuild(sources, writers.Warehouse(spark, str(landing / "warehouse"))), sources


def built_root(tables):
    return tables["raw.ppr_transactions"].inputFiles()[0].split("/raw/")[0]


def test_layers(built):
    tables, _ = built
    counts = {r.table_name: r.row_count for r in writers.layer_row_counts({n: tables[n] for n in writers.LAYER_TABLES}).collect()}
    assert counts["raw.ppr_transactions"] == counts["staging.ppr_transactions"] == 18
    warehouse = writers.Warehouse(tables["raw.ppr_transactions"].sparkSession, built_root(tables))
    recorded = writers.layer_row_counts(warehouse)
    assert {r.table_name: r.row_count for r in recorded.collect()} == counts
    assert "FileScan" not in recorded._jdf.queryExecution().toString()
    assert not any(warehouse.damaged(name) for name in writers.LAYER_TABLES)
    assert counts["analytics.monthly_market"] == 9 and counts["analytics.county_market"] == 6
    staged = tables["staging.ppr_transactions"]
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in schemas.STAGING_TX]
    assert sorted(r.ppr_id for r in staged.collect()) == list(range(1, 19))
    assert {r.county for r in staged.collect()} == {"Dublin", "Cork"}
    assert {r.planning_authority for r in tables["staging.planning_applications"].collect()} == {"A0", "A1"}


def test_table_tests_pass(built):
    tables, _ = built
    named = {
        "stg_ppr_transactions": "staging.ppr_transactions",
        "stg_rppi_series": "staging.rppi_series",
        "stg_planning_applications": "staging.planning_applications",
        **{n: f"analytics.{n}" for n in schemas.MARTS},
    }
    found = {n: tables[t] for n, t in named.items()}
    assert {r.status for r in quality.constraint_checks(found).collect()} == {"PASS"}
    assert quality.check_not_null(found).count() == 22 and quality.check_unique(found).count() == 5


def test_rebuild_ends_with_its_tests(spark, built, tmp_path):
    tables, sources = built
    assert tables[TABLE_TESTS].count() == 27
    index = sources.index.unionByName(sources.index.withColumn("Statistic Label", F.lit("other")))
    warehouse = writers.Warehouse(spark, str(tmp_path))
    warehouse.save("analytics.monthly_market", spark.range(7).toDF("old"))
    with pytest.raises(RuntimeError, match="unique: monthly_market.year_month"):
        rebuild(Sources(sources.register, index, sources.planning), warehouse)
    # readers stay on the old tables, and nothing of the failed build is left
    assert warehouse.tables() == ["analytics.monthly_market"] and warehouse.load("analytics.monthly_market").count() == 7
    assert not (tmp_path / "staging" / "ppr_transactions").exists() or not list((tmp_path / "staging" / "ppr_transactions").iterdir())


def test_failed_save_leaves_the_old_table(spark, tmp_path):
    warehouse = writers.Warehouse(spark, str(tmp_path))
    warehouse.save("a.t", spark.range(3).toDF("id"))
    with pytest.raises(Exception, match="broken"):
        warehouse.save("a.t", spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")))
    assert warehouse.load("a.t").count() == 3
    # a table may be made from itself
    assert warehouse.save("a.t", warehouse.load("a.t").filter("id > 0")).count() == 2


def test_scratch_goes_at_the_end_of_its_block(spark, tmp_path):
    import os

    since = len(storage._WRITTEN)
    kept = materialise(spark.range(2), "kept")
    with scratch(spark):
        path = fresh_path(spark, "inside")
        spark.range(1).write.parquet(path)
    assert not os.path.exists(path) and kept.count() == 2
    assert release(spark, since) == 1 and not os.path.exists(kept.inputFiles()[0].removeprefix("file://"))


def test_reports_and_quality_from_files(spark, built, tmp_path):
    tables, _ = built
    marts = Marts(*[tables[f"analytics.{n}"] for n in ("monthly_market", "county_market", "planning_activity")])
    writers.sink_reports(reports.all_reports(marts, YEARS), str(tmp_path))
    found = readers.scan_reports(spark, str(tmp_path), schemas.report_schemas(2010, 2011))
    report = quality.qa_report(found, marts, YEARS, 2011)
    failed = [r for r in report.collect() if r.status != "PASS"]
    assert failed == [] and report.count() == 61
    summary = save_quality_report(found, marts, YEARS, 2011, str(tmp_path / "quality")).first()
    assert (summary.total_checks, summary.failed) == (61, 0)
    observed = {r.market_metric: r.observations for r in found["market_planning_correlation"].collect()}
    assert observed["transactions"] == 9 and observed["national_rppi"] == 8


def test_all_exploration_tables(spark, built, tmp_path):
    _, sources = built
    tx = exploration.load_tx_eda(cleaning.clean_tx(sources.register))
    tables = exploration.all_tables(tx)
    assert len(tables) == 18 and writers.GROWING_TABLES < set(tables)
    stored = explore(sources.register, writers.Warehouse(spark, str(tmp_path / "warehouse")), str(tmp_path))
    assert list(stored) == list(tables)
    for name in tables:
        assert len(spark.read.option("header", True).csv(f"{tmp_path}/{name}").take(1)) == 1
