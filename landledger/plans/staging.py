"""All-text raw layer to typed staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from landledger import schemas
from landledger.functions.dates import epoch_ms_to_date
from landledger.functions.text import empty_to_null, flag_or_false, typed
from landledger.operators.row_ids import dense_row_id


def typed_tx(raw: DataFrame) -> DataFrame:
    """Typed transactions without the surrogate id, all the marts need."""
    out = []
    for field in schemas.TYPED_TX.fields:
        kind = field.dataType.simpleString()
        if kind == "boolean":
            out.append(flag_or_false(field.name).alias(field.name))
        else:
            out.append(typed(field.name, kind).alias(field.name))
    return raw.select(*out)


def typed_index(raw: DataFrame) -> DataFrame:
    types = {
        "month_start": ("month", "date"),
        "year": ("year", "int"),
        "month_number": ("month_number", "int"),
        "quarter": ("quarter", "int"),
        "rppi_value": ("rppi_value", "decimal(10,2)"),
    }
    out = []
    for field in schemas.STAGING_INDEX.fields[1:]:
        source, kind = types.get(field.name, (field.name, "string"))
        out.append(typed(source, kind).alias(field.name))
    return raw.select(*out)


def typed_planning(raw: DataFrame, extra: dict | None = None) -> DataFrame:
    out = [c.alias(n) for n, c in (extra or {}).items()]
    for name, (source, kind) in schemas.PLANNING_CASTS.items():
        col = epoch_ms_to_date(source) if kind == "epoch" else typed(source, kind)
        out.append(col.alias(name))
    return raw.select(*out)


def stg_tx(raw: DataFrame) -> DataFrame:
    df = typed_tx(raw)
    keys = ["sale_date", "address", "county", "price_eur", "sale_year_month"]
    return dense_row_id(df, _with_tie_break(df, keys), "ppr_id")


def stg_index(raw: DataFrame) -> DataFrame:
    df = typed_index(raw)
    keys = ["month_start", "property_series", "statistic_label", "residential_property_type"]
    return dense_row_id(df, _with_tie_break(df, keys), "rppi_id")


def stg_planning(raw: DataFrame) -> DataFrame:
    # the third key is the received text itself, which the typed table drops
    received = "_received_text"
    df = typed_planning(raw, {received: empty_to_null("ReceivedDate")})
    keys = ["object_id", "application_number", received]
    return dense_row_id(df, _with_tie_break(df, keys), "planning_id").drop(received)


def _with_tie_break(df: DataFrame, keys: list[str]) -> list[str]:
    """Sort keys, then every other column so that only equal rows can tie."""
    return keys + [c for c in df.columns if c not in keys]
