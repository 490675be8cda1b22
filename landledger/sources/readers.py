"""Scans of source files, text layers, marts and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger import schemas
from landledger.functions.numbers import parse_number
from landledger.functions.text import (
    MISSING_TOKENS,
    decode_header,
    latin1_to_cp1252,
    missing_to_null,
)
from landledger.operators.profile import require_columns
from landledger.sources.page_ledger import check_ledger, page_ledger
from landledger.sources.quoted_csv import scan_quoted_csv
from landledger.storage import materialise, run_together


def _csv(spark: SparkSession, encoding: str, multi_line: bool):
    # keep blanks: exact duplicates are removed before trimming
    return (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mode", "FAILFAST")
    )


def scan_tx_csv(
    spark: SparkSession, path: str, multi_line: bool = False, missing=MISSING_TOKENS
) -> DataFrame:
    """Sale register CSV in code page 1252, all text, columns taken by header name.

    The bytes are read as Latin-1 and the few signs that differ are translated,
    which needs no session setting. Files are split. A quoted line break then
    raises, as its parts are no whole rows; pass ``multi_line`` for a feed that has them, at
    one task per file. The header of every file is compared with the first one's; a
    file with other columns or another order raises: scan such groups of files apart and union them by name.
    """
    names = _csv(spark, "ISO-8859-1", multi_line).csv(path).columns
    df = _csv(spark, "ISO-8859-1", multi_line).schema(schemas.text_schema(names)).option("enforceSchema", False).csv(path)
    return _register(df, missing)


def scan_tx_quoted(spark: SparkSession, path: str, missing=MISSING_TOKENS) -> DataFrame:
    """``scan_tx_csv`` for registers with quoted line breaks, whose files are split all the same; they are read
    three times, once to count quotes and once more where a block's edge cuts a record. All files must have one header.
    """
    return _register(scan_quoted_csv(spark, path, "ISO-8859-1"), missing)


def _register(df: DataFrame, missing) -> DataFrame:
    df = df.toDF(*[decode_header(c) for c in df.columns])
    require_columns(df, schemas.REGISTER_SOURCE_COLUMNS)
    return df.select(
        *[
            missing_to_null(latin1_to_cp1252(f"`{c}`"), missing).alias(c)
            for c in schemas.REGISTER_SOURCE_COLUMNS
        ]
    )


def scan_index_csv(spark: SparkSession, folder: str, missing=MISSING_TOKENS) -> DataFrame:
    """Price index CSV: the folder must hold exactly one file."""
    df = _csv(spark, "UTF-8", True).csv(folder)
    files = df.inputFiles()
    if len(files) != 1:
        raise ValueError(f"expected one index file in {folder}, found {len(files)}")
    require_columns(df, schemas.INDEX_SOURCE_COLUMNS)
    return df.select(
        *[missing_to_null(f"`{c}`", missing).alias(c) for c in schemas.INDEX_SOURCE_COLUMNS]
    )


def scan_feature_pages(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    page_schema: T.StructType = schemas.FEATURE_PAGE,
) -> DataFrame:
    """Landed JSON pages, one row per feature's attributes.

    An ``error`` payload or no feature at all raises, as a failed download does.
    """
    return _features(materialise(spark.read.schema(page_schema).option("multiLine", multi_line).json(path), "pages"))


def scan_numbered_pages(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    page_schema: T.StructType = schemas.FEATURE_PAGE,
) -> DataFrame:
    """Landed JSON pages, each in a file or folder ``first=...`` named by the offset of its first record, one row per
    feature's attributes.

    Besides what ``scan_feature_pages`` refuses, a lost, doubled, overlapping or cut page raises and is named with its
    offset: the pages must be one gapless sequence of records that starts at 0. One page a file.
    """
    more = T.StructField("exceededTransferLimit", T.BooleanType(), True)
    named = spark.read.schema(T.StructType([*page_schema.fields, more])).option("multiLine", multi_line).json(path)
    pages = materialise(named.select("*", F.col("_metadata.file_path").alias("page")), "numbered-pages")
    features = _features(pages)
    check_ledger(materialise(page_ledger(pages), "page-ledger"))
    return features


def _features(pages: DataFrame) -> DataFrame:
    seen = pages.agg(
        F.max("error").alias("error"), F.sum(F.coalesce(F.size("features"), F.lit(0))).alias("features")
    ).first()
    if seen["error"] is not None:
        raise RuntimeError(f"feature service error: {seen['error']}")
    if not seen["features"]:
        raise ValueError("no feature records were retrieved")
    return pages.select(F.explode("features").alias("f")).select("f.attributes.*")


def scan_text_raw(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Cleaned CSV as text by position; no missing tokens besides the empty text.

    Files are split; a quoted line break raises unless ``multi_line`` is set.
    """
    return (
        _csv(spark, "UTF-8", multi_line)
        .schema(schema)
        .option("enforceSchema", True)
        .csv(path)
    )


def scan_mart(
    spark: SparkSession, path: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Mart by explicit columns in its fixed order; an empty mart raises."""
    schema = schemas.MARTS[name]
    wanted = list(columns or schema.fieldNames())
    df = spark.read.parquet(path)
    require_columns(df, wanted)
    if not df.take(1):
        raise ValueError(f"{name} returned no rows")
    coerced = []
    for field in schema.fields:
        if field.name not in wanted:
            continue
        source = df.schema[field.name].dataType
        col = F.col(field.name)
        if isinstance(source, T.StringType) and not isinstance(field.dataType, T.StringType):
            col = parse_number(col, field.dataType.simpleString())
        coerced.append(col.cast(field.dataType).alias(field.name))
    keys = [F.col(k).asc_nulls_last() for k in schemas.MART_ORDER[name]]
    return df.orderBy(*keys).select(*coerced)


class Reports(dict):
    """Readable report tables by name; ``problems`` says of others why they are not."""

    def __init__(self, tables: Mapping[str, DataFrame], problems: Mapping[str, str]):
        super().__init__(tables)
        self.problems = dict(problems)


def _scan_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A report by its own header: known columns get their types, others stay text."""
    names = _csv(spark, "UTF-8", True).csv(path).columns
    text = _csv(spark, "UTF-8", True).schema(schemas.text_schema(names)).option("enforceSchema", False).csv(path)
    types = {f.name: f.dataType for f in schema.fields}
    return materialise(text.select(*[F.col(f"`{c}`").cast(types.get(c, T.StringType())).alias(c) for c in names]), "report")


def scan_reports(
    spark: SparkSession, folder: str, report_schemas: Mapping[str, T.StructType]
) -> Reports:
    """Report tables by name, each read once, by the names in its own header.

    An absent report is left out. One that cannot be read, because rows are too
    short or a value is not of the column's type, is left out too and named in ``problems``.
    """

    def scan(name: str):
        try:
            return name, _scan_report(spark, f"{folder}/{name}", report_schemas[name]), None
        except Exception as problem:  # noqa: BLE001 - Spark's errors have no common narrower class
            return name, None, None if "PATH_NOT_FOUND" in str(problem) else str(problem).split("\n")[0][:200]

    found = run_together([lambda n=n: scan(n) for n in report_schemas])
    return Reports(
        {name: table for name, table, _ in found if table is not None},
        {name: problem for name, _, problem in found if problem},
    )
