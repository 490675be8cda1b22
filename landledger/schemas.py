"""Declared schemas of every layer.

Counts are 64 bit and money totals ``decimal(28,2)``: the same values as the
usual integer / numeric(18,2) columns, without overflow on very large tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(14, 2)
MONEY_TOTAL = T.DecimalType(28, 2)
INDEX_VALUE = T.DecimalType(10, 2)
OPEN_NUMERIC = T.DecimalType(38, 10)
UNITS = T.DecimalType(14, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


# ---- source columns (fixed values) -------------------------------------
REGISTER_SOURCE_COLUMNS = [
    "Date of Sale (dd/mm/yyyy)",
    "Address",
    "County",
    "Eircode",
    "Price (€)",
    "Not Full Market Price",
    "VAT Exclusive",
    "Description of Property",
    "Property Size Description",
]
INDEX_SOURCE_COLUMNS = [
    "Statistic Label",
    "Month",
    "Type of Residential Property",
    "UNIT",
    "VALUE",
]
PLANNING_SOURCE_COLUMNS = [
    "OBJECTID", "PlanningAuthority", "ApplicationNumber", "DevelopmentDescription",
    "DevelopmentAddress", "DevelopmentPostcode", "ITMEasting", "ITMNorthing",
    "ApplicationStatus", "ApplicationType", "Decision", "LandUseCode", "AreaofSite",
    "NumResidentialUnits", "OneOffHouse", "FloorArea", "ReceivedDate", "WithdrawnDate",
    "DecisionDate", "DecisionDueDate", "GrantDate", "ExpiryDate", "AppealRefNumber",
    "AppealStatus", "AppealDecision", "AppealDecisionDate", "AppealSubmittedDate",
    "FIRequestDate", "FIRecDate", "LinkAppDetails", "OneOffKPI", "ETL_DATE", "SiteId",
    "Shape__Area", "Shape__Length",
]

# ---- raw layer: all text (fixed values) ----------------------------------
TX_COLUMNS = [
    "sale_date", "sale_year", "sale_month", "sale_quarter", "sale_year_month", "address",
    "county", "eircode", "price_eur", "not_full_market_price", "is_not_full_market_price",
    "vat_exclusive", "is_vat_exclusive", "property_description", "is_new_property",
    "is_second_hand_property", "property_size_description", "property_size_category",
]
# "Month" and "month" differ only by case, so the first gets its own name.
INDEX_COLUMNS = [
    "statistic_label", "source_month_label", "residential_property_type", "unit",
    "source_value", "month", "year", "month_number", "quarter", "year_month",
    "property_series", "rppi_value",
]
RAW_TX = text_schema(TX_COLUMNS)
RAW_INDEX = text_schema(INDEX_COLUMNS)
RAW_PLANNING = text_schema(PLANNING_SOURCE_COLUMNS)

FEATURE_PAGE = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(T.StructType([T.StructField("attributes", RAW_PLANNING, True)])),
            True,
        ),
        T.StructField("error", T.StringType(), True),
    ]
)

# ---- cleaned / staging layer --------------------------------------------
CLEAN_TX = _struct(
    sale_date=T.DateType(), sale_year=T.IntegerType(), sale_month=T.IntegerType(),
    sale_quarter=T.IntegerType(), sale_year_month=T.StringType(), address=T.StringType(),
    county=T.StringType(), eircode=T.StringType(), price_eur=OPEN_NUMERIC,
    not_full_market_price=T.StringType(), is_not_full_market_price=T.BooleanType(),
    vat_exclusive=T.StringType(), is_vat_exclusive=T.BooleanType(),
    property_description=T.StringType(), is_new_property=T.BooleanType(),
    is_second_hand_property=T.BooleanType(), property_size_description=T.StringType(),
    property_size_category=T.StringType(),
)
# the cleaned table keeps every digit of a price; staging gives it its type
TYPED_TX = T.StructType(
    [T.StructField(f.name, PRICE if f.name == "price_eur" else f.dataType, True) for f in CLEAN_TX.fields]
)
STAGING_TX = T.StructType([T.StructField("ppr_id", T.LongType(), True), *TYPED_TX.fields])
STAGING_INDEX = _struct(
    rppi_id=T.LongType(), statistic_label=T.StringType(), source_month_label=T.StringType(),
    residential_property_type=T.StringType(), unit=T.StringType(), source_value=T.StringType(),
    month_start=T.DateType(), year=T.IntegerType(), month_number=T.IntegerType(),
    quarter=T.IntegerType(), year_month=T.StringType(), property_series=T.StringType(),
    rppi_value=INDEX_VALUE,
)
# Staging name -> (raw column, target type); epoch columns are tagged "epoch".
PLANNING_CASTS = {
    "object_id": ("OBJECTID", "bigint"),
    "planning_authority": ("PlanningAuthority", "string"),
    "application_number": ("ApplicationNumber", "string"),
    "development_description": ("DevelopmentDescription", "string"),
    "development_address": ("DevelopmentAddress", "string"),
    "development_postcode": ("DevelopmentPostcode", "string"),
    "itm_easting": ("ITMEasting", "decimal(38,10)"),
    "itm_northing": ("ITMNorthing", "decimal(38,10)"),
    "application_status": ("ApplicationStatus", "string"),
    "application_type": ("ApplicationType", "string"),
    "decision": ("Decision", "string"),
    "land_use_code": ("LandUseCode", "string"),
    "area_of_site": ("AreaofSite", "decimal(38,10)"),
    "num_residential_units": ("NumResidentialUnits", "decimal(38,10)"),
    "one_off_house": ("OneOffHouse", "string"),
    "floor_area": ("FloorArea", "decimal(38,10)"),
    "received_date": ("ReceivedDate", "epoch"),
    "withdrawn_date": ("WithdrawnDate", "epoch"),
    "decision_date": ("DecisionDate", "epoch"),
    "decision_due_date": ("DecisionDueDate", "epoch"),
    "grant_date": ("GrantDate", "epoch"),
    "expiry_date": ("ExpiryDate", "epoch"),
    "appeal_ref_number": ("AppealRefNumber", "string"),
    "appeal_status": ("AppealStatus", "string"),
    "appeal_decision": ("AppealDecision", "string"),
    "appeal_decision_date": ("AppealDecisionDate", "epoch"),
    "appeal_submitted_date": ("AppealSubmittedDate", "epoch"),
    "further_information_request_date": ("FIRequestDate", "epoch"),
    "further_information_received_date": ("FIRecDate", "epoch"),
    "link_app_details": ("LinkAppDetails", "string"),
    "one_off_kpi": ("OneOffKPI", "string"),
    "etl_date": ("ETL_DATE", "epoch"),
    "site_id": ("SiteId", "string"),
    "shape_area": ("Shape__Area", "decimal(38,10)"),
    "shape_length": ("Shape__Length", "decimal(38,10)"),
}

# ---- marts --------------------------------------------------------------
MONTHLY_MARKET = _struct(
    year_month=T.StringType(), month_start=T.DateType(), transactions=T.LongType(),
    total_value=MONEY_TOTAL, mean_price=PRICE, median_price=PRICE, national_rppi=INDEX_VALUE,
)
COUNTY_MARKET = _struct(
    county=T.StringType(), sale_year=T.IntegerType(), transactions=T.LongType(),
    total_value=MONEY_TOTAL, mean_price=PRICE, median_price=PRICE,
    new_property_transactions=T.LongType(), second_hand_property_transactions=T.LongType(),
)
PLANNING_ACTIVITY = _struct(
    planning_authority=T.StringType(), year_month=T.StringType(), month_start=T.DateType(),
    applications=T.LongType(), granted_applications=T.LongType(),
    refused_applications=T.LongType(), residential_units=UNITS,
)
MARKET_SUMMARY = _struct(
    metric_name=T.StringType(), metric_value=MONEY_TOTAL, metric_text=T.StringType()
)
MARTS = {
    "monthly_market": MONTHLY_MARKET,
    "county_market": COUNTY_MARKET,
    "planning_activity": PLANNING_ACTIVITY,
    "property_market_summary": MARKET_SUMMARY,
}
MART_ORDER = {
    "monthly_market": ["month_start"],
    "county_market": ["sale_year", "county"],
    "planning_activity": ["month_start", "planning_authority"],
    "property_market_summary": ["metric_name"],
}

# ---- reports (fixed values: column lists) ---------------------------------
_LONG, _DBL, _STR, _INT, _DATE = (
    T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType(), T.DateType()
)
_ANNUAL = dict(
    year=_INT, period=_STR, transactions=_LONG, total_value=MONEY_TOTAL,
    avg_monthly_mean_price=_DBL, avg_monthly_median_price=_DBL, avg_rppi=_DBL,
)
_PLANNING_RATES = dict(
    applications=_LONG, granted_applications=_LONG, refused_applications=_LONG,
    residential_units=_DBL, grant_rate_pct=_DBL, refusal_rate_pct=_DBL,
)


def report_schemas(baseline_year: int, comparison_year: int) -> dict[str, T.StructType]:
    """Schemas of the ten reports; two column names carry the compared years."""
    return {
        "annual_market": _struct(**_ANNUAL),
        "market_ytd": _struct(**_ANNUAL),
        "price_growth": _struct(
            year=_INT, avg_mean_price=_DBL, avg_median_price=_DBL, avg_rppi=_DBL,
            mean_price_yoy_pct=_DBL, median_price_yoy_pct=_DBL, rppi_yoy_pct=_DBL,
        ),
        "county_market": COUNTY_MARKET,
        "county_price_change": _struct(
            county=_STR,
            **{f"mean_price_{baseline_year}": PRICE, f"mean_price_{comparison_year}": PRICE},
            price_change_pct=_DBL,
        ),
        "county_property_mix": _struct(
            county=_STR, sale_year=_INT, new_property_transactions=_LONG,
            second_hand_property_transactions=_LONG, total_classified_transactions=_LONG,
            new_property_share_pct=_DBL, second_hand_property_share_pct=_DBL,
        ),
        "annual_planning": _struct(year=_INT, **_PLANNING_RATES),
        "planning_authority": _struct(planning_authority=_STR, **_PLANNING_RATES),
        "market_planning_correlation": _struct(
            market_metric=_STR, planning_metric=_STR, pearson_correlation=_DBL,
            observations=_LONG, period_start=_DATE, period_end=_DATE,
        ),
        "key_kpis": _struct(kpi=_STR, value=_STR, unit=_STR),
    }
