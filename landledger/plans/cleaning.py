"""Source text to cleaned tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landledger import schemas
from landledger.functions import dates, numbers, text
from landledger.operators.profile import checked, drop_exact_duplicates, require_columns, require_rows

# Source headers (one also in damaged form) and cleaned names.
REGISTER_NAMES = {
    "Date of Sale (dd/mm/yyyy)": "sale_date",
    "Address": "address",
    "County": "county",
    "Eircode": "eircode",
    "Price (€)": "price_eur",
    "Price (â‚¬)": "price_eur",
    "Not Full Market Price": "not_full_market_price",
    "VAT Exclusive": "vat_exclusive",
    "Description of Property": "property_description",
    "Property Size Description": "property_size_description",
}
# The register's text columns.
TEXT_COLUMNS = [
    "address",
    "county",
    "eircode",
    "not_full_market_price",
    "vat_exclusive",
    "property_description",
    "property_size_description",
]


def rename_columns(df: DataFrame, names: dict[str, str] = REGISTER_NAMES) -> DataFrame:
    """Rename the columns that are present."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def default_missing_column(df: DataFrame, column: str, data_type: str = "string") -> DataFrame:
    """Add a null column unless the table has it."""
    return df if column in df.columns else df.withColumn(column, F.lit(None).cast(data_type))


def reorder_project(df: DataFrame, columns=tuple(schemas.TX_COLUMNS)) -> DataFrame:
    return df.select(*columns)


def clean_tx(raw: DataFrame, distinct: Callable[[DataFrame], DataFrame] = drop_exact_duplicates) -> DataFrame:
    """Cleaned sale register: 18 typed columns.

    Copies go before trimming, by ``distinct``, so rows that differ in blanks both stay. After
    that everything is a projection.
    """
    require_columns(raw, schemas.REGISTER_SOURCE_COLUMNS)
    df = rename_columns(distinct(raw))
    df = df.withColumns({c: text.trim_text(c) for c in TEXT_COLUMNS})
    df = df.withColumns(
        {
            "sale_date": dates.parse_sale_date("sale_date"),
            "price_eur": numbers.parse_price("price_eur"),
            "county": text.title_case("county"),
            "not_full_market_price": text.title_case("not_full_market_price"),
            "vat_exclusive": text.title_case("vat_exclusive"),
        }
    )
    df = df.withColumns(
        {
            **dates.calendar_parts("sale_date", "sale_"),
            "is_not_full_market_price": text.is_yes("not_full_market_price"),
            "is_vat_exclusive": text.is_yes("vat_exclusive"),
            "is_new_property": text.mentions("property_description", text.NEW_PHRASE),
            "is_second_hand_property": text.mentions(
                "property_description", text.SECOND_HAND_PHRASE_INGEST
            ),
            "property_size_category": text.size_category_ingest("property_size_description"),
        }
    )
    return reorder_project(df)


def clean_index(raw: DataFrame) -> DataFrame:
    """Cleaned price index: 12 columns; an unreadable month raises, a missing value stays.

    The check is part of the plan: the rows are worked out once.
    """
    require_columns(raw, schemas.INDEX_SOURCE_COLUMNS)
    df = drop_exact_duplicates(raw)
    label, month_text, kind, unit, value = (F.col(f"`{c}`") for c in schemas.INDEX_SOURCE_COLUMNS)
    df = df.select(
        text.trim_text(label).alias("statistic_label"),
        text.trim_text(month_text).alias("source_month_label"),
        text.trim_text(kind).alias("residential_property_type"),
        text.trim_text(unit).alias("unit"),
        value.alias("source_value"),
    )
    month = checked("month", {"invalid index month": F.col("month").isNull()})
    df = df.withColumn("month", dates.parse_index_month("source_month_label")).withColumn("month", month).withColumns(
        {
            "year": F.year("month"),
            "month_number": F.month("month"),
            "quarter": F.quarter("month"),
            "year_month": dates.year_month("month"),
            "property_series": F.col("residential_property_type"),
            "rppi_value": numbers.parse_wide("source_value"),
        }
    )
    return df.select(*schemas.INDEX_COLUMNS)


def clean_planning(raw: DataFrame, distinct: Callable[[DataFrame], DataFrame] = drop_exact_duplicates) -> DataFrame:
    """Planning rows without exact copies, text columns trimmed; no rows at all raise."""
    require_rows(raw)
    texts = {
        f.name: text.trim_text(f"`{f.name}`")
        for f in raw.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return distinct(raw).withColumns(texts)


def as_text_layer(df: DataFrame) -> DataFrame:
    """Cleaned table as the all-text raw layer; booleans read True / False."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        col = text.flag_word(col) if isinstance(field.dataType, T.BooleanType) else col.cast("string")
        out.append(col.alias(field.name))
    return df.select(*out)
