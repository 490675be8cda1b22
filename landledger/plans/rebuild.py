"""The whole rebuild: sources to raw, staging and analytics layers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from landledger.operators.copies import drop_copies_stored
from landledger.plans import cleaning, exploration, marts, quality, staging
from landledger.plans.reports import Marts, Years
from landledger.sources.snapshots import Snapshot, Warehouse
from landledger.sources.writers import sink_reports, write_csv
from landledger.storage import run_together, scratch


@dataclass
class Sources:
    """Delivered tables: sale register, price index, planning applications."""

    register: DataFrame
    index: DataFrame
    planning: DataFrame


def rebuild(
    sources: Sources,
    warehouse: Warehouse,
    series: str = marts.NATIONAL_SERIES,
    unit: str = marts.NATIONAL_UNIT,
    distinct: Callable[[DataFrame], DataFrame] = drop_copies_stored,
) -> dict[str, DataFrame]:
    """Replace every layer and return its tables by name.

    Each layer is written once and the next one reads the written table, so a
    source is cleaned once however many marts follow. Scratch goes when its layer is
    written. The table tests run over the new tables, their rows are saved as ``quality.table_tests``, and all of it
    becomes current at once. ``distinct`` removes copies from the register and the applications: ``copies.drop_copies_stored``
    stores them as delivered and shuffles only rows that have a copy. A failed build or test raises and leaves readers with the tables they had.
    """
    with warehouse.begin() as snapshot:
        tables = _build(sources, warehouse.spark, snapshot, series, unit, distinct)
    return tables


def _build(sources: Sources, spark: SparkSession, snapshot: Snapshot, series: str, unit: str, distinct: Callable) -> dict[str, DataFrame]:
    raw = {
        "raw.ppr_transactions": lambda: cleaning.as_text_layer(cleaning.clean_tx(sources.register, distinct)),
        "raw.rppi_series": lambda: cleaning.as_text_layer(cleaning.clean_index(sources.index)),
        "raw.planning_applications": lambda: cleaning.clean_planning(sources.planning, distinct),
    }
    tables: dict[str, DataFrame] = {}

    def save_all(builds: dict) -> None:
        # tables of one layer do not depend on each other
        names = list(builds)
        jobs = [lambda n=n: snapshot.save(n, builds[n]()) for n in names]
        with scratch(spark):
            tables.update(zip(names, run_together(jobs)))

    save_all(raw)
    tx, ix, pl = "staging.ppr_transactions", "staging.rppi_series", "staging.planning_applications"
    save_all(
        {
            tx: lambda: staging.stg_tx(tables["raw.ppr_transactions"]),
            ix: lambda: staging.stg_index(tables["raw.rppi_series"]),
            pl: lambda: staging.stg_planning(tables["raw.planning_applications"]),
        }
    )
    save_all(
        {
            "analytics.monthly_market": lambda: marts.monthly_market(tables[tx], tables[ix], series, unit),
            "analytics.county_market": lambda: marts.county_market(tables[tx]),
            "analytics.planning_activity": lambda: marts.planning_activity(tables[pl]),
            "analytics.property_market_summary": lambda: marts.property_market_summary(
                tables[tx], tables[ix], tables[pl]
            ),
        }
    )
    save_all({TABLE_TESTS: lambda: table_tests(tables, snapshot)})
    failed = [r.check_name for r in tables[TABLE_TESTS].filter("status = 'FAIL'").collect()]
    if failed:
        raise RuntimeError(f"table tests failed: {sorted(failed)}")
    return tables


TABLE_TESTS = "quality.table_tests"


def table_tests(tables: dict[str, DataFrame], snapshot: Snapshot) -> DataFrame:
    """The declared not-null and unique tests over the staging and mart tables of a rebuild.

    Nulls were counted when the tables were written; the unique tests read the key columns.
    """
    short = {"staging.ppr_transactions": "stg_ppr_transactions", "staging.rppi_series": "stg_rppi_series",
             "staging.planning_applications": "stg_planning_applications"}
    short |= {name: name.split(".")[1] for name in tables if name.startswith("analytics.")}
    nulls = quality.recorded_not_null(next(iter(tables.values())).sparkSession, {own: snapshot.figures(name) for name, own in short.items()})
    return nulls.unionByName(quality.check_unique({own: tables[name] for name, own in short.items()}))


def explore(register: DataFrame, warehouse: Warehouse, folder: str) -> dict[str, DataFrame]:
    """The exploration as one job: the analysis table stored once, then every table written from it."""
    save = "analytics.exploration_transactions"
    with scratch(warehouse.spark):
        tx = exploration.load_tx_eda(
            cleaning.clean_tx(register, drop_copies_stored), lambda df: warehouse.save(save, df), drop_copies_stored
        )
        tables = exploration.all_tables(tx)
        sink_reports(tables, folder)
    return tables


def save_quality_report(reports, tables: Marts, years: Years, latest: int, folder: str) -> DataFrame:
    """Write the quality report as one CSV and return its summary, taken from the written rows."""
    spark = tables.monthly.sparkSession
    report = quality.qa_report(reports, tables, years, latest)
    path = write_csv(report, f"{folder}/qa_report", one_file=True)
    stored = spark.read.schema(report.schema).option("header", True).option("escape", '"').csv(path)
    return quality.qa_summary(stored)
