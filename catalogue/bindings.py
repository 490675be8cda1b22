"""The given tables seen as sale register, price index and planning tables.

Every view is built from the columns asked for: a lookup table is joined only
when one of its columns is used. The lookups are left joins on unique keys, so
leaving one out changes no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogue.registry import cte
from landledger import schemas
from landledger.functions import text as tx_text
from landledger.functions.dates import year_month
from landledger.plans import marts as mart_plans
from landledger.plans.reports import Marts, Years
from landledger.plans.staging import typed_planning
from landledger.storage import materialise, run_together

YEARS = Years(partial=2001, baseline=1995)
SERIES, UNIT = "ALL", "Base 1995=100"

NEW_TEXT = "New Dwelling house /Apartment"
OLD_TEXT = "Second-Hand Dwelling house /Apartment"
SIZE_TEXTS = [
    (10, "less than 38 sq metres"),
    (30, "greater than or equal to 38 sq metres and less than 125 sq metres"),
    (45, "greater than or equal to 125 sq metres"),
]


# Declared, so that planning a query reads no file footers.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Column definitions as SQL text over the given tables.
_SHIP = "CAST(l_shipdate AS DATE)"
_PRICE = "CAST(l_extendedprice AS DECIMAL(14,2))"
_ADDRESS = "concat(l_orderkey, '-', l_linenumber)"
_EIRCODE = "IF(l_partkey % 3 != 0, concat('E', l_partkey), NULL)"
_NOT_FULL = "IF(l_linestatus = 'F', 'Yes', 'No')"
_VAT_OF_LINE = "IF(l_suppkey % 7 != 0, IF(l_tax > 0.05, 'Yes', 'No'), NULL)"
_VAT = "vat_flag"
# What a line is narrowed to before its lookups, which exchange it: dates and cents take fewer bytes than times and floats.
_LINE = {"l_shipdate": _SHIP, "l_extendedprice": _PRICE, _VAT: _VAT_OF_LINE}
_DESCRIPTION = f"CASE l_returnflag WHEN 'N' THEN '{NEW_TEXT}' WHEN 'R' THEN '{OLD_TEXT}' END"
_SIZE_TEXT = "CASE " + " ".join(f"WHEN p_size < {n} THEN '{t}'" for n, t in SIZE_TEXTS) + " END"


def _place_tables(spark, sf_dir) -> list[DataFrame]:
    return [
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
    ]


def _join_place(spark, sf_dir, df: DataFrame, order_key: str) -> DataFrame:
    """Of a large table: the lookups meet first, so its wide rows are exchanged for one join, not for every lookup."""
    orders, customers, nations = _place_tables(spark, sf_dir)
    places = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("o_orderkey", "n_name")
    )
    return df.join(places, F.col(order_key) == F.col("o_orderkey"), "left")


def with_county(spark, sf_dir, df: DataFrame) -> DataFrame:
    """Look the county up for few rows that carry ``order_key``."""
    orders, customers, nations = _place_tables(spark, sf_dir)
    return (
        df.join(orders, F.col("order_key") == F.col("o_orderkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .withColumnRenamed("n_name", "county")
    )


def _tx_view(spark, sf_dir, definitions, columns) -> DataFrame:
    wanted = columns or [c for c in definitions if c != "order_key"]
    used = " ".join(definitions[c] for c in wanted)
    df = table(spark, sf_dir, "lineitem")
    df = df.selectExpr(*[c for c in df.columns if c not in _LINE], *[f"{e} AS {c}" for c, e in _LINE.items()])
    if "n_name" in used:
        df = _join_place(spark, sf_dir, df, "l_orderkey")
    if "p_size" in used:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
        df = df.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    return df.selectExpr(*[f"{definitions[c]} AS `{c}`" for c in wanted])


REGISTER_VIEW = {
    "Date of Sale (dd/mm/yyyy)": f"date_format({_SHIP}, 'dd/MM/yyyy')",
    "Address": _ADDRESS,
    "County": "IF(l_orderkey % 3 = 0, concat('  ', upper(n_name), ' '), upper(n_name))",
    "Eircode": _EIRCODE,
    "Price (€)": f"concat('€', format_number({_PRICE}, 2))",
    "Not Full Market Price": _NOT_FULL,
    "VAT Exclusive": _VAT,
    "Description of Property": _DESCRIPTION,
    "Property Size Description": _SIZE_TEXT,
}
TYPED_VIEW = {
    "order_key": "l_orderkey",
    "sale_date": _SHIP,
    "sale_year": f"year({_SHIP})",
    "sale_month": f"month({_SHIP})",
    "sale_quarter": f"quarter({_SHIP})",
    "sale_year_month": f"left(CAST({_SHIP} AS STRING), 7)",
    "address": _ADDRESS,
    "county": "n_name",
    "eircode": _EIRCODE,
    "price_eur": _PRICE,
    "not_full_market_price": _NOT_FULL,
    "is_not_full_market_price": "l_linestatus = 'F'",
    "vat_exclusive": _VAT,
    "is_vat_exclusive": f"coalesce({_VAT} = 'Yes', false)",
    "property_description": _DESCRIPTION,
    "is_new_property": "l_returnflag = 'N'",
    "is_second_hand_property": "l_returnflag = 'R'",
    "property_size_description": _SIZE_TEXT,
}


def tx_raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Sale register as delivered: nine text columns."""
    return _tx_view(spark, sf_dir, REGISTER_VIEW, columns)


def tx(spark: SparkSession, sf_dir: str, *columns: str, eda: bool = False) -> DataFrame:
    """Typed sale register; ``eda`` switches to the exploration size classes."""
    wanted = columns or schemas.TX_COLUMNS
    category = "property_size_category"
    if category not in wanted:
        return _tx_view(spark, sf_dir, TYPED_VIEW, wanted)
    classify = tx_text.size_category_eda if eda else tx_text.size_category_ingest
    size = "property_size_description"
    plain = [c for c in wanted if c != category]
    df = _tx_view(spark, sf_dir, TYPED_VIEW, [*plain, *([] if size in plain else [size])])
    return df.withColumn(category, classify(size)).select(*wanted)


def _index_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average order price per month and series against 1995, from one scan."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(month.alias("m"), "o_orderpriority")
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"),
            F.count("o_totalprice").alias("n"),
        )
        .select("m", "s", "n", F.explode(F.array(F.lit(SERIES), "o_orderpriority")).alias("series"))
        .groupBy("m", "series")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    )
    of_series, in_base = Window.partitionBy("series"), F.year("m") == 1995
    base = F.sum(F.when(in_base, F.col("s"))).over(of_series).cast("double") / F.sum(
        F.when(in_base, F.col("n"))
    ).over(of_series)
    level = F.col("s").cast("double") / F.col("n") / base * F.lit(100.0)
    missing = (F.col("series") == "5-LOW") & (F.month("m") == 2)
    return monthly.select("m", "series", F.when(~missing, level.cast("decimal(10,2)")).alias("level"))


def ix_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price index as delivered: five text columns."""
    return _index_levels(spark, sf_dir).select(
        F.lit("Residential price index").alias("Statistic Label"),
        F.date_format("m", "yyyy MMMM").alias("Month"),
        F.concat(F.lit(" "), F.col("series")).alias("Type of Residential Property"),
        F.lit(UNIT).alias("UNIT"),
        F.col("level").cast("string").alias("VALUE"),
    )


def ix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed price index columns the marts use."""
    return _index_levels(spark, sf_dir).select(
        F.col("m").alias("month"),
        year_month("m").alias("year_month"),
        F.col("series").alias("property_series"),
        F.lit(UNIT).alias("unit"),
        F.col("level").alias("rppi_value"),
    )


def pl_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planning applications as delivered: 35 text columns."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def millis(days: int) -> Column:
        day = F.date_add(F.col("o_orderdate").cast("date"), days)
        whole = (F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400000).cast("string")
        return F.when(key % 2 == 0, F.concat(whole, F.lit(".0"))).otherwise(whole)

    given = {
        "OBJECTID": key.cast("string"),
        "PlanningAuthority": F.col("n_name"),
        "ApplicationNumber": F.concat(F.lit("A"), (key % 1000).cast("string")),
        "DevelopmentDescription": F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("  ")),
        "DevelopmentAddress": F.col("c_name"),
        "DevelopmentPostcode": F.lit(""),
        "ITMEasting": F.concat(customer.cast("string"), F.lit(".5")),
        "ApplicationStatus": F.col("c_mktsegment"),
        "ApplicationType": F.lit("PERMISSION"),
        "Decision": F.when(F.col("o_orderstatus") == "F", "GRANT PERMISSION")
        .when(F.col("o_orderstatus") == "O", "Conditional")
        .otherwise("REFUSED"),
        "AreaofSite": F.concat((customer % 97).cast("string"), F.lit(".25")),
        "NumResidentialUnits": F.when(customer % 4 != 0, (customer % 5).cast("string")),
        "OneOffHouse": F.when(customer % 2 == 0, "Y").otherwise("N"),
        "FloorArea": F.lit(""),
        "ReceivedDate": F.when(key % 50 != 0, millis(0)),
        "DecisionDate": millis(56),
        "DecisionDueDate": F.lit(""),
        "GrantDate": F.when(F.col("o_orderstatus") == "F", millis(90)),
        "SiteId": F.concat(F.lit("S"), customer.cast("string")),
        "Shape__Area": (customer % 13).cast("string"),
    }
    df = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), customer == F.col("c_custkey"), "left")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    empty = F.lit(None).cast("string")
    return df.select(*[given.get(c, empty).alias(c) for c in schemas.PLANNING_SOURCE_COLUMNS])


def pl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed planning columns the marts use."""
    return typed_planning(pl_raw(spark, sf_dir))


def monthly(spark, sf_dir) -> DataFrame:
    return mart_plans.monthly_market(
        tx(spark, sf_dir, "sale_year_month", "sale_date", "price_eur"),
        ix(spark, sf_dir),
        SERIES,
        UNIT,
    )


def county(spark, sf_dir) -> DataFrame:
    return mart_plans.county_market(
        tx(spark, sf_dir, "county", "sale_year", "price_eur", "is_new_property", "is_second_hand_property")
    )


def planning(spark, sf_dir) -> DataFrame:
    return mart_plans.planning_activity(pl(spark, sf_dir))


def stored_monthly(spark, sf_dir) -> DataFrame:
    """Monthly mart written once: reports read stored marts."""
    return materialise(monthly(spark, sf_dir), "monthly")


def stored_county(spark, sf_dir) -> DataFrame:
    """County mart written once, for reports that read it more than once."""
    return materialise(county(spark, sf_dir), "county")


def stored_planning(spark, sf_dir) -> DataFrame:
    return materialise(planning(spark, sf_dir), "planning")


_STORED = {"monthly": stored_monthly, "county": stored_county, "planning": stored_planning}


def stored(spark, sf_dir, *names: str) -> list[DataFrame]:
    """Several stored marts, built side by side."""
    return run_together([lambda n=n: _STORED[n](spark, sf_dir) for n in names])


def marts(spark, sf_dir) -> Marts:
    return Marts(monthly(spark, sf_dir), county(spark, sf_dir), planning(spark, sf_dir))


# ---- the same views for DuckDB ------------------------------------------
cte(
    "b_lines",
    """SELECT l.*, CAST(l_shipdate AS DATE) AS ship, CAST(l_extendedprice AS DECIMAL(14,2)) AS price,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS addr,
    CASE WHEN l_partkey % 3 <> 0 THEN 'E' || CAST(l_partkey AS VARCHAR) END AS eir,
    CASE WHEN l_linestatus = 'F' THEN 'Yes' ELSE 'No' END AS notfull,
    CASE WHEN l_suppkey % 7 <> 0 THEN CASE WHEN l_tax > 0.05 THEN 'Yes' ELSE 'No' END END AS vat,
    CASE l_returnflag WHEN 'N' THEN 'New Dwelling house /Apartment'
        WHEN 'R' THEN 'Second-Hand Dwelling house /Apartment' END AS descr,
    CASE WHEN p_size < 10 THEN 'less than 38 sq metres'
        WHEN p_size < 30 THEN 'greater than or equal to 38 sq metres and less than 125 sq metres'
        WHEN p_size < 45 THEN 'greater than or equal to 125 sq metres' END AS size_text,
    n_name
    FROM lineitem l LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN part ON l_partkey = p_partkey""",
)
cte(
    "b_tx_raw",
    """SELECT strftime(ship, '%d/%m/%Y') AS "Date of Sale (dd/mm/yyyy)", addr AS "Address",
    CASE WHEN l_orderkey % 3 = 0 THEN '  ' || upper(n_name) || ' ' ELSE upper(n_name) END AS "County",
    eir AS "Eircode", '€' || format('{:,.2f}', l_extendedprice) AS "Price (€)",
    notfull AS "Not Full Market Price", vat AS "VAT Exclusive", descr AS "Description of Property",
    size_text AS "Property Size Description" FROM b_lines""",
)
cte(
    "b_tx",
    """SELECT ship AS sale_date, CAST(year(ship) AS INTEGER) AS sale_year,
    CAST(month(ship) AS INTEGER) AS sale_month, CAST(quarter(ship) AS INTEGER) AS sale_quarter,
    strftime(ship, '%Y-%m') AS sale_year_month, addr AS address, n_name AS county, eir AS eircode,
    price AS price_eur, CAST(price * 100 AS BIGINT) AS cents,
    notfull AS not_full_market_price, notfull = 'Yes' AS is_not_full_market_price,
    vat AS vat_exclusive, coalesce(vat = 'Yes', false) AS is_vat_exclusive,
    descr AS property_description, l_returnflag = 'N' AS is_new_property,
    l_returnflag = 'R' AS is_second_hand_property, size_text AS property_size_description,
    CASE WHEN p_size < 10 THEN 'Under 38 sq m' WHEN p_size < 30 THEN '38-124 sq m'
        WHEN p_size < 45 THEN '125 sq m or more' ELSE 'Unknown' END AS property_size_category,
    CASE WHEN p_size < 10 THEN 'Less than 38 sq m' WHEN p_size < 30 THEN '38–124 sq m'
        WHEN p_size < 45 THEN 'Other / Unclassified' ELSE 'Unknown' END AS eda_size_category
    FROM (SELECT b_lines.*, part.p_size FROM b_lines LEFT JOIN part ON l_partkey = p_partkey)""",
)
cte(
    "b_ix_months",
    """SELECT m, series, sum(s) AS s, sum(n) AS n FROM (
      SELECT date_trunc('month', o_orderdate)::DATE AS m, unnest(['ALL', o_orderpriority]) AS series,
        CAST(o_totalprice AS DECIMAL(18,2)) AS s, 1 AS n FROM orders) GROUP BY ALL""",
)
cte(
    "b_ix_raw",
    """SELECT 'Residential price index' AS "Statistic Label", strftime(a.m, '%Y %B') AS "Month",
    ' ' || a.series AS "Type of Residential Property", 'Base 1995=100' AS "UNIT",
    CASE WHEN NOT (a.series = '5-LOW' AND month(a.m) = 2) THEN CAST(CAST(
      (CAST(a.s AS DOUBLE) / CAST(a.n AS DOUBLE)) / (CAST(b.s AS DOUBLE) / CAST(b.n AS DOUBLE)) * 100.0
      AS DECIMAL(10,2)) AS VARCHAR) END AS "VALUE", a.m
    FROM b_ix_months a JOIN (SELECT series, sum(s) AS s, sum(n) AS n FROM b_ix_months
      WHERE year(m) = 1995 GROUP BY series) b USING (series)""",
)
cte(
    "b_ix",
    """SELECT "Statistic Label" AS statistic_label, "Month" AS source_month_label,
    trim("Type of Residential Property") AS residential_property_type, "UNIT" AS unit,
    "VALUE" AS source_value, m AS month, CAST(year(m) AS INTEGER) AS year,
    CAST(month(m) AS INTEGER) AS month_number, CAST(quarter(m) AS INTEGER) AS quarter,
    strftime(m, '%Y-%m') AS year_month, trim("Type of Residential Property") AS property_series,
    CAST("VALUE" AS DECIMAL(10,2)) AS rppi_value FROM b_ix_raw""",
)


def _sql_millis(days: int) -> str:
    whole = f"CAST(CAST((CAST(o_orderdate AS DATE) + {days}) - DATE '1970-01-01' AS BIGINT) * 86400000 AS VARCHAR)"
    return f"CASE WHEN o_orderkey % 2 = 0 THEN {whole} || '.0' ELSE {whole} END"


_PL_SQL = {
    "OBJECTID": "CAST(o_orderkey AS VARCHAR)",
    "PlanningAuthority": "n_name",
    "ApplicationNumber": "'A' || CAST(o_orderkey % 1000 AS VARCHAR)",
    "DevelopmentDescription": "' ' || o_orderpriority || '  '",
    "DevelopmentAddress": "c_name",
    "DevelopmentPostcode": "''",
    "ITMEasting": "CAST(o_custkey AS VARCHAR) || '.5'",
    "ApplicationStatus": "c_mktsegment",
    "ApplicationType": "'PERMISSION'",
    "Decision": "CASE o_orderstatus WHEN 'F' THEN 'GRANT PERMISSION' WHEN 'O' THEN 'Conditional' ELSE 'REFUSED' END",
    "AreaofSite": "CAST(o_custkey % 97 AS VARCHAR) || '.25'",
    "NumResidentialUnits": "CASE WHEN o_custkey % 4 <> 0 THEN CAST(o_custkey % 5 AS VARCHAR) END",
    "OneOffHouse": "CASE WHEN o_custkey % 2 = 0 THEN 'Y' ELSE 'N' END",
    "FloorArea": "''",
    "ReceivedDate": f"CASE WHEN o_orderkey % 50 <> 0 THEN {_sql_millis(0)} END",
    "DecisionDate": _sql_millis(56),
    "DecisionDueDate": "''",
    "GrantDate": f"CASE WHEN o_orderstatus = 'F' THEN {_sql_millis(90)} END",
    "SiteId": "'S' || CAST(o_custkey AS VARCHAR)",
    "Shape__Area": "CAST(o_custkey % 13 AS VARCHAR)",
}
cte(
    "b_pl_raw",
    "SELECT "
    + ", ".join(
        f'{_PL_SQL.get(c, "CAST(NULL AS VARCHAR)")} AS "{c}"' for c in schemas.PLANNING_SOURCE_COLUMNS
    )
    + " FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey",
)


def _sql_planning_column(name: str, source: str, kind: str) -> str:
    value = f"""nullif("{source}", '')"""
    if kind == "epoch":
        value = f"CAST(to_timestamp(CAST({value} AS DOUBLE) / 1000) AT TIME ZONE 'UTC' AS DATE)"
    elif kind != "string":
        value = f"CAST({value} AS {kind.upper()})"
    return f"{value} AS {name}"


cte(
    "b_pl",
    "SELECT "
    + ", ".join(_sql_planning_column(n, s, k) for n, (s, k) in schemas.PLANNING_CASTS.items())
    + ', nullif("ReceivedDate", \'\') AS received_text FROM b_pl_raw',
)

# exact mean in cents, halves up (prices are positive); median of whole cents
MEAN = "CAST(((2 * sum(cents) + count(cents)) // (2 * count(cents))) / 100 AS DECIMAL(14,2))"
MEDIAN = "CAST(round(median(cents)) / 100 AS DECIMAL(14,2))"
TOTAL = "CAST(sum(price_eur) AS DECIMAL(28,2))"
FLOAT_MEAN = "CAST(sum(price_eur) AS DOUBLE) / count(price_eur)"
FLOAT_MEDIAN = "median(cents) / 100.0"

cte(
    "b_monthly",
    f"""SELECT t.*, CAST(i.rppi_value AS DECIMAL(10,2)) AS national_rppi FROM (
      SELECT sale_year_month AS year_month, CAST(date_trunc('month', sale_date) AS DATE) AS month_start,
        count(*) AS transactions, {TOTAL} AS total_value, {MEAN} AS mean_price, {MEDIAN} AS median_price
      FROM b_tx GROUP BY 1, 2) t
    LEFT JOIN (SELECT year_month, rppi_value FROM b_ix WHERE property_series = 'ALL'
      AND unit = 'Base 1995=100') i USING (year_month)""",
)
cte(
    "b_county",
    f"""SELECT county, sale_year, count(*) AS transactions, {TOTAL} AS total_value, {MEAN} AS mean_price,
    {MEDIAN} AS median_price, count(*) FILTER (WHERE is_new_property) AS new_property_transactions,
    count(*) FILTER (WHERE is_second_hand_property) AS second_hand_property_transactions
    FROM b_tx GROUP BY county, sale_year""",
)
cte(
    "b_planning",
    """SELECT planning_authority, strftime(received_date, '%Y-%m') AS year_month,
    CAST(date_trunc('month', received_date) AS DATE) AS month_start, count(*) AS applications,
    count(*) FILTER (WHERE decision ILIKE '%grant%' OR decision ILIKE '%conditional%') AS granted_applications,
    count(*) FILTER (WHERE decision ILIKE '%refus%') AS refused_applications,
    CAST(sum(num_residential_units) AS DECIMAL(14,2)) AS residential_units
    FROM b_pl WHERE received_date IS NOT NULL GROUP BY 1, 2, 3""",
)
