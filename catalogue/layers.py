"""Cleaning, staging, row ids, scans, sinks and the full rebuild."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import bindings as b
from catalogue.bindings import YEARS
from catalogue.marts_and_reports import LATEST, MONTHLY_COLUMNS, REPORT_CTES, summary_mart
from catalogue.registry import cte, query
from landledger import schemas, storage
from landledger.functions import text
from landledger.operators.copies import drop_copies_stored
from landledger.operators.profile import require_columns
from landledger.operators.row_ids import dense_row_id
from landledger.plans import cleaning, exploration, reports, staging
from landledger.plans.rebuild import Sources, rebuild
from landledger.sources import readers, writers

# ---- cleaning ----------------------------------------------------------------
cte(
    "b_clean_tx",
    """SELECT sale_date, sale_year, sale_month, sale_quarter, sale_year_month, address,
    upper(county[1]) || lower(county[2:]) AS county, eircode, price_eur, not_full_market_price,
    is_not_full_market_price, vat_exclusive, vat_exclusive = 'Yes' AS is_vat_exclusive,
    property_description, is_new_property, is_second_hand_property, property_size_description,
    property_size_category FROM (SELECT DISTINCT * FROM b_lines_typed)""",
)
cte("b_lines_typed", "SELECT * EXCLUDE (is_vat_exclusive, cents, eda_size_category) FROM b_tx")


# cleaned tables keep every digit; staging and later layers have two
cte("b_clean_wide", "SELECT * REPLACE (CAST(price_eur AS DECIMAL(38,10)) AS price_eur) FROM b_clean_tx")


@query("clean_tx", "SELECT * FROM b_clean_wide")
def clean_tx(spark, d):
    return cleaning.clean_tx(b.tx_raw(spark, d), drop_copies_stored)


cte("b_clean_ix", "SELECT DISTINCT * FROM b_ix")


@query("clean_index", "SELECT * REPLACE (CAST(rppi_value AS DECIMAL(38,10)) AS rppi_value) FROM b_clean_ix")
def clean_index(spark, d):
    return cleaning.clean_index(b.ix_raw(spark, d))


_PL_CLEAN = ", ".join(f'trim("{c}") AS "{c}"' for c in schemas.PLANNING_SOURCE_COLUMNS)


@query("clean_planning", f"SELECT {_PL_CLEAN} FROM (SELECT DISTINCT * FROM b_pl_raw)")
def clean_planning(spark, d):
    return cleaning.clean_planning(b.pl_raw(spark, d), drop_copies_stored)


# ---- staging -----------------------------------------------------------------
def _order(first: list[str], columns: list[str]) -> str:
    rest = [c for c in columns if c not in first]
    return ", ".join(f"{c} ASC NULLS LAST" for c in [*first, *rest])


_TX_ORDER = _order(["sale_date", "address", "county", "price_eur", "sale_year_month"], schemas.TX_COLUMNS)
cte(
    "b_stg_tx",
    f"""SELECT row_number() OVER (ORDER BY {_TX_ORDER}) AS ppr_id,
    * REPLACE (coalesce(is_vat_exclusive, false) AS is_vat_exclusive) FROM b_clean_tx""",
)


def raw_tx(spark, d):
    """All-text raw layer of the cleaned register, stored as in the rebuild."""
    return storage.materialise_built(
        spark, lambda: cleaning.as_text_layer(cleaning.clean_tx(b.tx_raw(spark, d), drop_copies_stored)), "raw-register", "zstd"
    )


def raw_ix(spark, d):
    text_layer = cleaning.as_text_layer(cleaning.clean_index(b.ix_raw(spark, d)))
    return storage.materialise(text_layer, "raw-index")


def raw_pl(spark, d):
    return storage.materialise_built(
        spark, lambda: cleaning.clean_planning(b.pl_raw(spark, d), drop_copies_stored), "raw-planning", "zstd"
    )


def _staged(spark, d, raw, stage):
    """A staging table of a raw layer, which goes as soon as the staged rows are stored."""
    with storage.own_scratch(spark):
        layer = raw(spark, d)
        with storage.surviving():
            return stage(layer)


@query("stg_tx", "SELECT * FROM b_stg_tx")
def stg_tx(spark, d):
    return _staged(spark, d, raw_tx, staging.stg_tx)


_IX_COLUMNS = schemas.STAGING_INDEX.fieldNames()[1:]
_IX_ORDER = _order(
    ["month_start", "property_series", "statistic_label", "residential_property_type"], _IX_COLUMNS
)
cte(
    "b_stg_ix",
    f"""SELECT row_number() OVER (ORDER BY {_IX_ORDER}) AS rppi_id, {', '.join(_IX_COLUMNS)}
    FROM (SELECT month AS month_start, * FROM b_clean_ix)""",
)


@query("stg_index", "SELECT * FROM b_stg_ix")
def stg_index(spark, d):
    return _staged(spark, d, raw_ix, staging.stg_index)


_PL_COLUMNS = list(schemas.PLANNING_CASTS)
_PL_ORDER = _order(["object_id", "application_number", "received_text"], _PL_COLUMNS)
_PL_TRIMMED = ", ".join(
    f"nullif(trim({n}), '') AS {n}" if kind == "string" else n
    for n, (_, kind) in schemas.PLANNING_CASTS.items()
)
cte(
    "b_stg_pl",
    f"""SELECT row_number() OVER (ORDER BY {_PL_ORDER}) AS planning_id, {', '.join(_PL_COLUMNS)}
    FROM (SELECT {_PL_TRIMMED}, received_text FROM b_pl)""",
)


@query("stg_planning", "SELECT * FROM b_stg_pl")
def stg_planning(spark, d):
    return _staged(spark, d, raw_pl, staging.stg_planning)


@query(
    "dense_row_id",
    f"""SELECT row_number() OVER (ORDER BY county ASC NULLS LAST, sale_year ASC NULLS LAST,
    price_eur ASC NULLS LAST, address ASC NULLS LAST) AS row_id, county, sale_year, price_eur, address FROM b_tx""",
)
def dense_row_id_query(spark, d):
    df = b.tx(spark, d, "county", "sale_year", "price_eur", "address")
    return dense_row_id(storage.materialise(df, "rows"), df.columns, "row_id")


# ---- exploration load ----------------------------------------------------------
@query(
    "load_tx_eda",
    """SELECT * EXCLUDE (eda_size_category) REPLACE (upper(county[1]) || lower(county[2:]) AS county,
    CAST(price_eur AS DECIMAL(18,6)) AS price_eur, eda_size_category AS property_size_category, vat_exclusive = 'Yes' AS is_vat_exclusive)
    FROM (SELECT DISTINCT * EXCLUDE (cents) FROM b_tx)""",
)
def load_tx_eda(spark, d):
    register = cleaning.clean_tx(b.tx_raw(spark, d), drop_copies_stored)
    return exploration.load_tx_eda(register, distinct=drop_copies_stored)


# ---- scans and sinks -----------------------------------------------------------
def _scratch(spark, label):
    return storage.fresh_path(spark, label)


@query("scan_tx_csv", "SELECT * FROM b_tx_raw")
def scan_tx_csv(spark, d):
    """The register written in code page 1252, then scanned."""
    raw = b.tx_raw(spark, d)
    encoded = raw.select(*[text.cp1252_to_latin1(f"`{c}`").alias(text.cp1252_name(c)) for c in raw.columns])
    path = _scratch(spark, "register-csv")
    (
        encoded.write.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return readers.scan_tx_csv(spark, path)


_BREAK = """CASE WHEN "Address" LIKE '%7' THEN "Address" || chr(10) || '"' || chr(10) || 'x' ELSE "Address" END"""


@query("scan_tx_quoted", f"""SELECT * REPLACE ({_BREAK} AS "Address") FROM b_tx_raw""")
def scan_tx_quoted(spark, d):
    """The register with line breaks and quotes in every tenth address or so, scanned by splits."""
    raw = b.tx_raw(spark, d)
    broken = F.when(F.col("Address").endswith("7"), F.concat("Address", F.lit('\n"\nx'))).otherwise(F.col("Address"))
    raw = raw.withColumn("Address", broken)
    encoded = raw.select(*[text.cp1252_to_latin1(f"`{c}`").alias(text.cp1252_name(c)) for c in raw.columns])
    path = _scratch(spark, "register-quoted")
    (
        encoded.write.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return readers.scan_tx_quoted(spark, path)


@query(
    "scan_index_csv",
    """SELECT "Statistic Label", "Month", "Type of Residential Property", "UNIT", "VALUE" FROM b_ix_raw""",
)
def scan_index_csv(spark, d):
    path = _scratch(spark, "index-csv")
    writers.write_csv(b.ix_raw(spark, d), path, one_file=True)
    return readers.scan_index_csv(spark, path)


@query(
    "scan_feature_pages",
    "SELECT "
    + ", ".join(f'"{c}"' for c in schemas.PLANNING_SOURCE_COLUMNS)
    + " FROM b_pl_raw",
)
def scan_feature_pages(spark, d):
    """Applications written as pages of at most 2,000 features, then scanned."""
    raw = b.pl_raw(spark, d)
    attributes = F.struct(*[F.col(c) for c in raw.columns])
    pages = (
        raw.select(
            (F.col("OBJECTID").cast("bigint") / 2000).cast("bigint").alias("page"),
            F.struct(attributes.alias("attributes")).alias("feature"),
        )
        .groupBy("page")
        .agg(F.collect_list("feature").alias("features"))
        .select("features")
    )
    path = _scratch(spark, "planning-pages")
    pages.write.json(path)
    return readers.scan_feature_pages(spark, path, multi_line=False)


@query(
    "scan_numbered_pages",
    "SELECT "
    + ", ".join(f'"{c}"' for c in schemas.PLANNING_SOURCE_COLUMNS)
    + " FROM b_pl_raw",
)
def scan_numbered_pages(spark, d):
    """Applications landed as pages named by the offset of their first record, then scanned with their ledger checked."""
    raw = b.pl_raw(spark, d)
    keyed = storage.materialise(raw.withColumn("key", F.col("OBJECTID").cast("bigint")), "applications")
    attributes = F.struct(F.struct(*[F.col(c) for c in raw.columns]).alias("attributes"))
    path = _scratch(spark, "numbered-pages")
    (
        dense_row_id(keyed, ["key"], "id")
        .groupBy(((F.col("id") - 1).cast("bigint") - (F.col("id") - 1) % 2000).alias("first"))
        .agg(F.collect_list(attributes).alias("features"))
        .write.partitionBy("first").json(path)
    )
    return readers.scan_numbered_pages(spark, path, multi_line=False)


_TX_TEXT = ", ".join(
    f"upper(CAST({f.name} AS VARCHAR)[1]) || CAST({f.name} AS VARCHAR)[2:] AS {f.name}"
    if f.dataType.simpleString() == "boolean"
    else f"CAST({f.name} AS VARCHAR) AS {f.name}"
    for f in schemas.CLEAN_TX.fields
)


CODEC = "gzip"  # of the register as CSV text, which is some five times its size as parquet


@query("scan_text_raw", f"SELECT {_TX_TEXT} FROM b_clean_wide")
def scan_text_raw(spark, d):
    path = _scratch(spark, "clean-csv")
    writers.sink_clean(cleaning.clean_tx(b.tx_raw(spark, d), drop_copies_stored), path, "csv", CODEC)
    return readers.scan_text_raw(spark, path, schemas.RAW_TX, multi_line=False)


@query("scan_mart", f"SELECT {MONTHLY_COLUMNS} FROM b_monthly")
def scan_mart(spark, d):
    path = _scratch(spark, "mart")
    b.monthly(spark, d).write.parquet(path)
    return readers.scan_mart(spark, path, "monthly_market")


def written_reports(spark, d, change=dict):
    """All ten reports written as CSV from marts built once, then scanned; ``change`` may damage them first."""
    marts = b.marts(spark, d).written()
    folder = _scratch(spark, "reports")
    writers.sink_reports(change(reports.all_reports(marts, YEARS)), folder)
    last = reports.comparison_year(marts.county, YEARS)
    expected = schemas.report_schemas(YEARS.baseline, last)
    return readers.scan_reports(spark, folder, expected), marts, last


_REPORT_SCHEMAS = schemas.report_schemas(YEARS.baseline, LATEST)


def _is_number(field) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _report_content_sql() -> str:
    """Every column of every report: filled cells, and the sum or the ends of its values."""
    parts = []
    for name, table in REPORT_CTES.items():
        for field in _REPORT_SCHEMAS[name].fields:
            c = field.name
            total, low, high = f"CAST(sum(CAST({c} AS DECIMAL(28,4))) AS DECIMAL(38,4))", "NULL", "NULL"
            if not _is_number(field):
                total, low, high = "NULL", f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)"
            parts.append(
                f"""SELECT '{name}' AS report, '{c}' AS "column", count({c}) AS cells, CAST({total} AS DECIMAL(38,4)) AS total,
                CAST({low} AS VARCHAR) AS lowest, CAST({high} AS VARCHAR) AS highest FROM {table}"""
            )
    return " UNION ALL ".join(parts)


def _report_content(found):
    parts = []
    for name, df in found.items():
        cells = []
        for field in df.schema.fields:
            c, number = F.col(field.name), _is_number(field)
            total = F.sum(c.cast("decimal(28,4)")) if number else F.lit(None)
            ends = [F.lit(None), F.lit(None)] if number else [F.min(c), F.max(c)]
            cells.append(
                F.struct(
                    F.lit(name).alias("report"), F.lit(field.name).alias("column"), F.count(c).alias("cells"),
                    total.cast("decimal(38,4)").alias("total"),
                    ends[0].cast("string").alias("lowest"), ends[1].cast("string").alias("highest"),
                )
            )
        parts.append(df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")))
    return reduce(lambda x, y: x.unionByName(y), parts)


@query(
    "sink_reports",
    " UNION ALL ".join(f"SELECT '{name}' AS report, count(*) AS row_count FROM {t}" for name, t in REPORT_CTES.items()),
)
def sink_reports(spark, d):
    found = written_reports(spark, d)[0]
    counts = [df.agg(F.lit(n).alias("report"), F.count(F.lit(1)).alias("row_count")) for n, df in found.items()]
    return reduce(lambda x, y: x.unionByName(y), counts)


@query("scan_reports", _report_content_sql())
def scan_reports(spark, d):
    """All ten reports and all their columns."""
    return _report_content(written_reports(spark, d)[0])


@query("sink_clean", "SELECT * FROM b_clean_wide")
def sink_clean(spark, d):
    path = _scratch(spark, "clean")
    writers.sink_clean(cleaning.clean_tx(b.tx_raw(spark, d), drop_copies_stored), path)
    return require_columns(spark.read.schema(schemas.CLEAN_TX).parquet(path), schemas.TX_COLUMNS)


def sources(spark, d) -> Sources:
    return Sources(b.tx_raw(spark, d), b.ix_raw(spark, d), b.pl_raw(spark, d))


_LAYERS = " UNION ALL ".join(
    f"SELECT '{layer}' AS table_name, count(*) AS row_count FROM {table}"
    for layer, table in [
        ("raw.ppr_transactions", "b_clean_tx"),
        ("staging.ppr_transactions", "b_clean_tx"),
        ("raw.rppi_series", "b_clean_ix"),
        ("staging.rppi_series", "b_clean_ix"),
        ("raw.planning_applications", "b_pl"),
        ("staging.planning_applications", "b_pl"),
        ("analytics.monthly_market", "b_monthly"),
        ("analytics.county_market", "b_county"),
        ("analytics.planning_activity", "b_planning"),
    ]
)


@query("full_refresh", f"SELECT *, true AS unchanged FROM ({_LAYERS})")
def full_refresh(spark, d):
    """Two rebuilds into the same folder: the second replaces the first with the same content."""
    warehouse = writers.Warehouse(spark, _scratch(spark, "warehouse"))
    seen = []
    for _ in range(2):
        tables = rebuild(sources(spark, d), warehouse, b.SERIES, b.UNIT)
        rows = []
        for name in writers.LAYER_TABLES:
            df = tables[name]
            digest = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)"))
            rows.append(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), digest.alias("digest")))
        seen.append(storage.materialise(reduce(lambda x, y: x.unionByName(y), rows), "layer-content"))
    before, after = seen
    return after.alias("a").join(before.alias("b"), "table_name").select(
        "table_name", F.col("a.row_count").alias("row_count"),
        (F.col("a.row_count").eqNullSafe(F.col("b.row_count")) & F.col("a.digest").eqNullSafe(F.col("b.digest"))).alias("unchanged"),
    )


@query("layer_row_counts", _LAYERS)
def layer_row_counts(spark, d):
    warehouse = writers.Warehouse(spark, _scratch(spark, "warehouse"))
    rebuild(sources(spark, d), warehouse, b.SERIES, b.UNIT)
    return writers.layer_row_counts(warehouse)


@query(
    "export_marts",
    """SELECT 'county_market' AS source_table, 'mart_county_market' AS target_table, n AS source_rows, n AS target_rows
      FROM (SELECT count(*) AS n FROM b_county)
    UNION ALL SELECT 'monthly_market', 'mart_monthly_market', n, n FROM (SELECT count(*) AS n FROM b_monthly)
    UNION ALL SELECT 'planning_activity', 'mart_planning_activity', n, n FROM (SELECT count(*) AS n FROM b_planning)
    UNION ALL SELECT 'property_market_summary', 'property_market_summary', n, n FROM (SELECT count(*) AS n FROM b_summary)""",
)
def export_marts(spark, d):
    marts = b.marts(spark, d).written()
    tables = {
        "monthly_market": marts.monthly,
        "county_market": marts.county,
        "planning_activity": marts.planning,
        "property_market_summary": storage.materialise(summary_mart(spark, d), "summary"),
    }
    return writers.export_marts(tables, _scratch(spark, "export"))
