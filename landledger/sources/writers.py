"""Sinks: layered tables, CSV reports and reconciled export."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger import schemas
from landledger.functions.text import flag_word
from landledger.sources.snapshots import Warehouse, figures_of, write_observed
from landledger.storage import remove, replace_folder, run_together, shuffles_cleaned


def _with_flags_as_words(df: DataFrame) -> DataFrame:
    """Booleans as True / False text, the spelling of the cleaned files."""
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: flag_word(c) for c in flags}) if flags else df


MOST_ROWS = 1_000_000  # of a compressed file, which one task must read


def write_csv(df: DataFrame, path: str, one_file: bool = False, compression: str | None = None) -> str:
    """CSV with header; ``one_file`` only for tables known to be small. Compressed files are told by their names when read."""
    out = df.coalesce(1) if one_file else df
    writer = out.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", MOST_ROWS)
    writer = (
        writer
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    with shuffles_cleaned(df.sparkSession):
        writer.csv(path)
    return path


def sink_clean(df: DataFrame, path: str, file_format: str = "parquet", compression: str | None = None) -> str:
    """Cleaned table as parquet, or as CSV text, ``compression`` if it is named, for a text raw layer."""
    if file_format == "csv":
        return write_csv(_with_flags_as_words(df), path, compression=compression)
    with shuffles_cleaned(df.sparkSession):
        df.write.mode("overwrite").format(file_format).save(path)
    return path


# Exploration tables that grow with the register, by rows or by its free texts.
GROWING_TABLES = frozenset(
    {"extreme_transactions_99_9th_percentile", "property_description_analysis"}
)


def sink_reports(
    reports: Mapping[str, DataFrame], folder: str, growing: Collection[str] = GROWING_TABLES
) -> dict[str, str]:
    """One CSV folder per report, with one file: periods, counties and the like are few.

    Those named in ``growing`` are written in parallel, a file per task.
    """
    jobs = [
        lambda name=name, df=df: write_csv(df, f"{folder}/{name}", one_file=name not in growing)
        for name, df in reports.items()
    ]
    return dict(zip(reports, run_together(jobs)))


LAYER_TABLES = [
    "raw.ppr_transactions",
    "staging.ppr_transactions",
    "raw.rppi_series",
    "staging.rppi_series",
    "raw.planning_applications",
    "staging.planning_applications",
    "analytics.monthly_market",
    "analytics.county_market",
    "analytics.planning_activity",
]


def layer_row_counts(tables: Mapping[str, DataFrame] | Warehouse) -> DataFrame:
    """(table_name, row_count) of every layer table, by name.

    Of a warehouse, whose writes were counted as they ran, no table is read; other tables are scanned.
    """
    if isinstance(tables, Warehouse):
        rows = [(name, tables.figures(name).rows) for name in LAYER_TABLES if name in tables.tables()]
        return tables.spark.createDataFrame(rows, "table_name string, row_count bigint").orderBy("table_name")
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out.orderBy("table_name")


# Target names of the exported marts.
EXPORT_TARGETS = {
    "county_market": "mart_county_market",
    "monthly_market": "mart_monthly_market",
    "planning_activity": "mart_planning_activity",
    "property_market_summary": "property_market_summary",
}


def export_marts(
    marts: Mapping[str, DataFrame], folder: str, file_format: str = "parquet"
) -> DataFrame:
    """Replace each target with its mart's rows, and report the counts of both.

    Every mart is written beside its target first and read back. Rows and content digest, gathered by the write, must
    be those of the stored files; only when all marts are right are the targets switched. An error
    before that leaves every old target as it was.
    """
    results, staged = [], []
    spark = None
    try:
        for name, target in EXPORT_TARGETS.items():
            schema = schemas.MARTS[name]
            source = marts[name]
            spark = source.sparkSession
            columns = []
            for field in schema.fields:
                col = F.col(field.name)
                if isinstance(field.dataType, T.DateType):
                    columns.append(col.try_cast("date").alias(field.name))
                else:
                    columns.append(col.cast(field.dataType).alias(field.name))
            path = f"{folder}/{target}"
            new = f"{path}.new-{uuid.uuid4().hex}"
            staged.append((new, path))
            sent = write_observed(source.select(*columns), new, file_format)
            stored = figures_of(_read_back(spark, new, schema, file_format))
            if sent != stored:
                raise RuntimeError(f"content mismatch for {target}: sent {sent.rows} rows, stored {stored.rows}")
            results.append((name, target, sent.rows, stored.rows))
    except Exception:
        for new, _ in staged:
            remove(spark, new)
        raise
    for new, path in staged:
        replace_folder(spark, new, path)
    return spark.createDataFrame(
        results, "source_table string, target_table string, source_rows bigint, target_rows bigint"
    )


def _read_back(spark: SparkSession, path: str, schema: T.StructType, file_format: str) -> DataFrame:
    return spark.read.format(file_format).schema(schema).load(path)
