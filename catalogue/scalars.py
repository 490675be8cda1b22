"""Scalar functions over the delivered tables, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import bindings as b
from catalogue.registry import query
from landledger.functions import dates, numbers, text
from landledger.plans import cleaning
from landledger.plans import marts as mart_plans
from landledger.plans import reports

KEY = "Address"


def _from_raw(spark, d, *columns):
    return b.tx_raw(spark, d, KEY, *columns)


# Python's title(): a capital after every non-letter
def title_sql(c: str) -> str:
    return (
        f"list_aggregate(list_transform(regexp_extract_all({c}, '(\\p{{L}}+|\\P{{L}}+)'), "
        "lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '')"
    )


@query(
    "parse_sale_date",
    """SELECT "Address" AS address, CAST(try_strptime("Date of Sale (dd/mm/yyyy)", '%d/%m/%Y') AS DATE) AS sale_date
    FROM b_tx_raw""",
)
def parse_sale_date(spark, d):
    df = _from_raw(spark, d, "Date of Sale (dd/mm/yyyy)")
    return df.select(
        F.col(KEY).alias("address"),
        dates.parse_sale_date("`Date of Sale (dd/mm/yyyy)`").alias("sale_date"),
    )


@query(
    "parse_price",
    """SELECT "Address" AS address, TRY_CAST(trim(replace(replace("Price (€)", '€', ''), ',', ''))
    AS DECIMAL(38,10)) AS price_eur FROM b_tx_raw""",
)
def parse_price(spark, d):
    df = _from_raw(spark, d, "Price (€)")
    return df.select(F.col(KEY).alias("address"), numbers.parse_price("`Price (€)`").alias("price_eur"))


@query("trim_text", """SELECT "Address" AS address, trim("County") AS county FROM b_tx_raw""")
def trim_text(spark, d):
    df = _from_raw(spark, d, "County")
    return df.select(F.col(KEY).alias("address"), text.trim_text("County").alias("county"))


@query(
    "title_case",
    f"""SELECT "Address" AS address, {title_sql('trim("County")')} AS county FROM b_tx_raw""",
)
def title_case(spark, d):
    df = _from_raw(spark, d, "County")
    return df.select(
        F.col(KEY).alias("address"), text.title_case(text.trim_text("County")).alias("county")
    )


@query(
    "date_features",
    """SELECT address, sale_year, sale_month, sale_quarter, sale_year_month FROM b_tx""",
)
def date_features(spark, d):
    df = b.tx(spark, d, "address", "sale_date")
    parts = dates.calendar_parts("sale_date", "sale_")
    return df.select("address", *[c.alias(n) for n, c in parts.items()])


@query(
    "yes_flag",
    """SELECT "Address" AS address, "Not Full Market Price" = 'Yes' AS is_not_full_market_price,
    "VAT Exclusive" = 'Yes' AS is_vat_exclusive,
    lower("VAT Exclusive") = 'yes' AS is_vat_exclusive_any_case FROM b_tx_raw""",
)
def yes_flag(spark, d):
    df = _from_raw(spark, d, "Not Full Market Price", "VAT Exclusive")
    return df.select(
        F.col(KEY).alias("address"),
        text.is_yes("Not Full Market Price").alias("is_not_full_market_price"),
        text.is_yes("VAT Exclusive").alias("is_vat_exclusive"),
        text.is_yes_any_case("VAT Exclusive").alias("is_vat_exclusive_any_case"),
    )


@query(
    "contains_flag",
    """SELECT "Address" AS address,
    coalesce(contains(lower("Description of Property"), 'new dwelling'), false) AS is_new_property,
    coalesce(contains(lower("Description of Property"), 'second-hand'), false) AS is_second_hand_property,
    coalesce(contains(lower("Description of Property"), 'second-hand dwelling'), false) AS is_second_hand_dwelling
    FROM b_tx_raw""",
)
def contains_flag(spark, d):
    c = "Description of Property"
    return _from_raw(spark, d, c).select(
        F.col(KEY).alias("address"),
        text.mentions(c, text.NEW_PHRASE).alias("is_new_property"),
        text.mentions(c, text.SECOND_HAND_PHRASE_INGEST).alias("is_second_hand_property"),
        text.mentions(c, text.SECOND_HAND_PHRASE_EDA).alias("is_second_hand_dwelling"),
    )


@query(
    "size_category_ingest",
    """SELECT "Address" AS address, CASE
    WHEN "Property Size Description" ILIKE '%greater than or equal to 125%' THEN '125 sq m or more'
    WHEN "Property Size Description" ILIKE '%greater than or equal to 38%'
      AND "Property Size Description" ILIKE '%less than 125%' THEN '38-124 sq m'
    WHEN "Property Size Description" ILIKE '%less than 38%' THEN 'Under 38 sq m'
    ELSE 'Unknown' END AS property_size_category FROM b_tx_raw""",
)
def size_category_ingest(spark, d):
    c = "Property Size Description"
    return _from_raw(spark, d, c).select(
        F.col(KEY).alias("address"), text.size_category_ingest(c).alias("property_size_category")
    )


@query("size_category_eda", "SELECT address, eda_size_category AS property_size_category FROM b_tx")
def size_category_eda(spark, d):
    c = "Property Size Description"
    return _from_raw(spark, d, c).select(
        F.col(KEY).alias("address"), text.size_category_eda(c).alias("property_size_category")
    )


_RENAMED = """SELECT "Date of Sale (dd/mm/yyyy)" AS sale_date, "Address" AS address, "County" AS county,
    "Eircode" AS eircode, "Price (€)" AS price_eur, "Not Full Market Price" AS not_full_market_price,
    "VAT Exclusive" AS vat_exclusive, "Description of Property" AS property_description,
    "Property Size Description" AS property_size_description FROM b_tx_raw"""


@query("rename_columns", _RENAMED)
def rename_columns(spark, d):
    return cleaning.rename_columns(b.tx_raw(spark, d))


@query(
    "reorder_project",
    """SELECT sale_date, sale_year, sale_month, sale_quarter, sale_year_month, address, county, eircode,
    price_eur, not_full_market_price, is_not_full_market_price, vat_exclusive, is_vat_exclusive,
    property_description, is_new_property, is_second_hand_property, property_size_description,
    property_size_category FROM b_tx""",
)
def reorder_project(spark, d):
    return cleaning.reorder_project(b.tx(spark, d))


@query(
    "default_missing_column",
    "SELECT address, price_eur, CAST(NULL AS VARCHAR) AS vat_exclusive FROM b_tx",
)
def default_missing_column(spark, d):
    df = b.tx(spark, d, "address", "price_eur")
    for c in ("price_eur", "vat_exclusive"):
        df = cleaning.default_missing_column(df, c)
    return df


@query(
    "parse_index_month",
    """SELECT "Month" AS month_text, "Type of Residential Property" AS series,
    CAST(try_strptime("Month", '%Y %B') AS DATE) AS month FROM b_ix_raw""",
)
def parse_index_month(spark, d):
    return b.ix_raw(spark, d).select(
        F.col("Month").alias("month_text"),
        F.col("Type of Residential Property").alias("series"),
        dates.parse_index_month("Month").alias("month"),
    )


@query(
    "parse_number",
    """SELECT "Month" AS month_text, "Type of Residential Property" AS series,
    TRY_CAST("VALUE" AS DOUBLE) AS rppi_value, TRY_CAST("Month" AS DOUBLE) AS not_a_number FROM b_ix_raw""",
)
def parse_number(spark, d):
    return b.ix_raw(spark, d).select(
        F.col("Month").alias("month_text"),
        F.col("Type of Residential Property").alias("series"),
        numbers.parse_number("VALUE").alias("rppi_value"),
        numbers.parse_number("Month").alias("not_a_number"),
    )


@query(
    "nullif_cast",
    """SELECT CAST(nullif("OBJECTID", '') AS BIGINT) AS object_id,
    CAST(nullif("NumResidentialUnits", '') AS DECIMAL(38,10)) AS num_residential_units,
    CAST(nullif("FloorArea", '') AS DECIMAL(14,2)) AS floor_area,
    CAST(nullif("AreaofSite", '') AS DECIMAL(14,2)) AS area_of_site,
    CAST(nullif("NumResidentialUnits", '') AS INTEGER) AS units,
    nullif("DevelopmentPostcode", '') AS development_postcode FROM b_pl_raw""",
)
def nullif_cast(spark, d):
    return b.pl_raw(spark, d).select(
        text.typed("OBJECTID", "bigint").alias("object_id"),
        text.typed("NumResidentialUnits", "decimal(38,10)").alias("num_residential_units"),
        text.typed("FloorArea", "decimal(14,2)").alias("floor_area"),
        text.typed("AreaofSite", "decimal(14,2)").alias("area_of_site"),
        text.typed("NumResidentialUnits", "int").alias("units"),
        text.typed("DevelopmentPostcode", "string").alias("development_postcode"),
    )


@query(
    "coalesce_bool",
    """SELECT "Address" AS address, coalesce(CAST(nullif("VAT Exclusive", '') AS BOOLEAN), false) AS is_vat_exclusive
    FROM b_tx_raw""",
)
def coalesce_bool(spark, d):
    return _from_raw(spark, d, "VAT Exclusive").select(
        F.col(KEY).alias("address"), text.flag_or_false("VAT Exclusive").alias("is_vat_exclusive")
    )


@query(
    "epoch_ms_to_date",
    "SELECT object_id, received_date, decision_date, decision_due_date, grant_date FROM b_pl",
)
def epoch_ms_to_date(spark, d):
    sources = {
        "received_date": "ReceivedDate",
        "decision_date": "DecisionDate",
        "decision_due_date": "DecisionDueDate",
        "grant_date": "GrantDate",
    }
    return b.pl_raw(spark, d).select(
        text.typed("OBJECTID", "bigint").alias("object_id"),
        *[dates.epoch_ms_to_date(c).alias(n) for n, c in sources.items()],
    )


@query("month_start", "SELECT address, CAST(date_trunc('month', sale_date) AS DATE) AS month_start FROM b_tx")
def month_start(spark, d):
    return b.tx(spark, d, "address", "sale_date").select(
        "address", dates.month_start("sale_date").alias("month_start")
    )


@query("year_month_text", "SELECT address, strftime(sale_date, '%Y-%m') AS year_month FROM b_tx")
def year_month_text(spark, d):
    return b.tx(spark, d, "address", "sale_date").select(
        "address", dates.year_month("sale_date").alias("year_month")
    )


@query(
    "ilike_predicate",
    """SELECT CAST("OBJECTID" AS BIGINT) AS object_id,
    "Decision" ILIKE '%grant%' OR "Decision" ILIKE '%conditional%' AS granted,
    "Decision" ILIKE '%refus%' AS refused FROM b_pl_raw""",
)
def ilike_predicate(spark, d):
    return b.pl_raw(spark, d).select(
        text.typed("OBJECTID", "bigint").alias("object_id"),
        text.contains_any("Decision", "grant", "conditional").alias("granted"),
        text.contains_any("Decision", "refus").alias("refused"),
    )


@query("filter_not_null", "SELECT object_id, received_date FROM b_pl WHERE received_date IS NOT NULL")
def filter_not_null(spark, d):
    return b.pl(spark, d).select("object_id", "received_date").dropna(subset=["received_date"])


@query(
    "filter_series_unit",
    """SELECT year_month, rppi_value AS national_rppi FROM b_ix
    WHERE property_series = 'ALL' AND unit = 'Base 1995=100'""",
)
def filter_series_unit(spark, d):
    return mart_plans.national_index(b.ix(spark, d), b.SERIES, b.UNIT)


@query(
    "safe_ratio_pct",
    """SELECT planning_authority, year_month,
    round_even(CAST(granted_applications AS DOUBLE) / nullif(applications, 0) * 100.0 * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS grant_rate_pct,
    round_even(CAST(applications AS DOUBLE) / nullif(refused_applications, 0) * 100.0 * 100.0::DOUBLE, 0) / 100.0::DOUBLE AS applications_per_refusal_pct
    FROM b_planning""",
)
def safe_ratio_pct(spark, d):
    return b.planning(spark, d).select(
        "planning_authority",
        "year_month",
        numbers.ratio_pct("granted_applications", "applications").alias("grant_rate_pct"),
        numbers.ratio_pct("applications", "refused_applications").alias(
            "applications_per_refusal_pct"
        ),
    )


@query(
    "label_concat",
    """SELECT address, sale_year || '-Q' || sale_quarter AS quarter_label,
    monthname(sale_date) AS month_name, '99.5%' AS percentile_label FROM b_tx""",
)
def label_concat(spark, d):
    return b.tx(spark, d, "address", "sale_year", "sale_month", "sale_quarter").select(
        "address",
        dates.quarter_label("sale_year", "sale_quarter").alias("quarter_label"),
        dates.month_name("sale_month").alias("month_name"),
        F.lit(dates.quantile_label(0.995)).alias("percentile_label"),
    )


@query(
    "period_label",
    """SELECT CAST(year(sale_date) AS INTEGER) AS sale_year,
    'January-' || monthname(max(date_trunc('month', sale_date))) AS period FROM b_tx GROUP BY 1""",
)
def period_label(spark, d):
    return (
        b.tx(spark, d, "sale_year", "sale_date")
        .groupBy("sale_year")
        .agg(dates.period_label(F.max(dates.month_start("sale_date"))).alias("period"))
    )


@query(
    "cast_text",
    """SELECT CAST(min(sale_date) AS VARCHAR) AS first_date, CAST(max(sale_date) AS VARCHAR) AS last_date FROM b_tx""",
)
def cast_text(spark, d):
    return b.tx(spark, d, "sale_date").agg(
        F.min("sale_date").cast("string").alias("first_date"),
        F.max("sale_date").cast("string").alias("last_date"),
    )


@query("isin_filter", "SELECT county, sale_year, mean_price FROM b_county WHERE sale_year IN (1995, 2000)")
def isin_filter(spark, d):
    county = b.stored_county(spark, d)
    compared = (b.YEARS.baseline, reports.comparison_year(county, b.YEARS))
    return county.filter(F.col("sale_year").isin(*compared)).select("county", "sale_year", "mean_price")
