"""Ingest validation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import bindings as b
from catalogue.aggregates import q6, r6
from catalogue.exploration import _missing_sql
from catalogue.registry import cte, query
from landledger import schemas
from landledger.operators import copies, profile
from landledger.plans import exploration as eda
from landledger.storage import materialise

DATE, PRICE = "Date of Sale (dd/mm/yyyy)", "Price (€)"
# the register with the rows of every fiftieth order delivered twice
ALL = schemas.REGISTER_SOURCE_COLUMNS
ALL_SQL = ", ".join(f'"{c}"' for c in ALL)
cte(
    "b_tx_twice",
    """SELECT * FROM b_tx_raw UNION ALL
    SELECT * FROM b_tx_raw WHERE CAST(split_part("Address", '-', 1) AS BIGINT) % 50 = 0""",
)


def tx_twice(spark, d):
    rows = b.tx_raw(spark, d)
    again = F.substring_index("Address", "-", 1).cast("bigint") % 50 == 0
    return rows.unionByName(rows.filter(again))


@query(
    "missing_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS missing_count FROM b_tx_raw"""
        for c in schemas.REGISTER_SOURCE_COLUMNS
    ),
)
def missing_counts(spark, d):
    return profile.missing_counts(b.tx_raw(spark, d))


def _pl_missing() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS missing_count,
        round_even(CAST(count(*) FILTER (WHERE "{c}" IS NULL) AS DOUBLE) / count(*) * 100.0 * 100.0::DOUBLE, 0) / 100.0::DOUBLE
        AS missing_percentage FROM b_pl_raw"""
        for c in schemas.PLANNING_SOURCE_COLUMNS
    )


@query("missing_summary", _pl_missing())
def missing_summary(spark, d):
    return profile.missing_summary(b.pl_raw(spark, d), digits=2)


@query(
    "duplicate_count",
    f"""SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS unique_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
    FROM (SELECT {ALL_SQL}, count(*) AS n FROM b_tx_twice GROUP BY ALL)""",
)
def duplicate_count(spark, d):
    return profile.duplicate_count(tx_twice(spark, d))


@query(
    "duplicate_rows",
    f"""SELECT {ALL_SQL} FROM (SELECT {ALL_SQL}, count(*) OVER (PARTITION BY {ALL_SQL}) AS n FROM b_tx_twice)
    WHERE n > 1 ORDER BY {', '.join(f'"{c}" NULLS LAST' for c in ALL)} LIMIT 10""",
)
def duplicate_rows(spark, d):
    return profile.duplicate_rows(tx_twice(spark, d), limit=10)


@query("drop_exact_duplicates", f"SELECT DISTINCT {ALL_SQL} FROM b_tx_raw")
def drop_exact_duplicates(spark, d):
    return profile.drop_exact_duplicates(tx_twice(spark, d))


@query("drop_copies", f"SELECT DISTINCT {ALL_SQL} FROM b_tx_raw")
def drop_copies(spark, d):
    """The same rows in two phases, from a stored table: only rows with a copy are shuffled."""
    return copies.drop_copies(materialise(tx_twice(spark, d), "delivered"))


@query(
    "copy_count",
    f"""SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS unique_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
    FROM (SELECT {ALL_SQL}, count(*) AS n FROM b_tx_twice GROUP BY ALL)""",
)
def copy_count(spark, d):
    return copies.copy_count(materialise(tx_twice(spark, d), "delivered"))


@query(
    "invalid_dates",
    f"""SELECT count(*) FILTER (WHERE try_strptime("{DATE}", '%d/%m/%Y') IS NULL) AS invalid_dates FROM b_tx_raw""",
)
def invalid_dates(spark, d):
    return profile.invalid_dates(b.tx_raw(spark, d, DATE), DATE)


@query(
    "invalid_prices",
    f"""SELECT count(*) FILTER (WHERE TRY_CAST(replace(replace("{PRICE}", '€', ''), ',', '') AS DOUBLE) IS NULL)
    AS invalid_prices FROM b_tx_raw""",
)
def invalid_prices(spark, d):
    return profile.invalid_prices(b.tx_raw(spark, d, PRICE), PRICE)


@query("value_counts", 'SELECT "County", count(*) AS count FROM b_tx_raw GROUP BY 1')
def value_counts(spark, d):
    return profile.value_counts(b.tx_raw(spark, d, "County"), "County")


@query(
    "value_counts_not_null",
    """SELECT "VAT Exclusive", count(*) AS count FROM b_tx_raw WHERE "VAT Exclusive" IS NOT NULL GROUP BY 1""",
)
def value_counts_not_null(spark, d):
    return profile.value_counts(b.tx_raw(spark, d, "VAT Exclusive"), "VAT Exclusive", keep_null=False)


@query("price_range", "SELECT min(price_eur) AS minimum, max(price_eur) AS maximum FROM b_tx")
def price_range(spark, d):
    return profile.value_range(b.tx(spark, d, "price_eur"), "price_eur")


@query(
    "classification_counts",
    """SELECT count(*) FILTER (WHERE is_new_property) AS new_properties,
    count(*) FILTER (WHERE is_second_hand_property) AS second_hand_properties,
    count(*) FILTER (WHERE NOT is_new_property AND NOT is_second_hand_property) AS neither,
    count(*) FILTER (WHERE is_new_property AND is_second_hand_property) AS both FROM b_tx""",
)
def classification_counts(spark, d):
    df = b.tx(spark, d, "is_new_property", "is_second_hand_property")
    return profile.classification_counts(df, "is_new_property", "is_second_hand_property")


@query(
    "guard_invalid",
    """SELECT 'rows' AS rule, count(*) AS violations FROM b_tx
    UNION ALL SELECT 'invalid sale dates', count(*) FILTER (WHERE sale_date IS NULL) FROM b_tx
    UNION ALL SELECT 'invalid prices', count(*) FILTER (WHERE price_eur IS NULL) FROM b_tx
    UNION ALL SELECT 'non-positive prices', count(*) FILTER (WHERE price_eur <= 0) FROM b_tx""",
)
def guard_invalid(spark, d):
    """The guard itself, which raises on a broken rule, then its counts from the same stored rows."""
    rows = materialise(b.tx(spark, d, "sale_date", "price_eur"), "guarded")
    return profile.violation_counts(profile.guard(rows, eda.eda_rules()), eda.eda_rules())


@query(
    "index_profile",
    """SELECT count(*) AS row_count, 5 AS column_count, min(month) AS first_month, max(month) AS last_month
    FROM b_ix""",
)
def index_profile(spark, d):
    return profile.index_profile(b.ix(spark, d), "month")
