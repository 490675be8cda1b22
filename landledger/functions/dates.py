"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landledger.functions.text import column, empty_to_null


def parse_sale_date(c: Column | str) -> Column:
    """dd/mm/yyyy text, one- or two-digit day and month; bad dates are null."""
    return F.try_to_date(column(c), "d/M/yyyy")


def parse_index_month(c: Column | str) -> Column:
    """"2005 January" to the first of that month; anything else is null."""
    return F.try_to_date(column(c), "yyyy MMMM")


def epoch_ms_to_date(c: Column | str) -> Column:
    """Millisecond text, with or without a decimal part, to a date."""
    seconds = empty_to_null(c).cast("decimal(20,3)") / F.lit(1000)
    return F.timestamp_seconds(seconds).cast("date")


def month_start(c: Column | str) -> Column:
    return F.trunc(column(c), "MM")


def year_month(c: Column | str) -> Column:
    """yyyy-MM of a date; a cut of its ISO text is cheaper than a formatter."""
    return F.left(column(c).cast("date").cast("string"), F.lit(7))


def month_name(c: Column | str) -> Column:
    """Name of a month number."""
    return F.date_format(F.make_date(F.lit(2000), column(c), F.lit(1)), "MMMM")


def quarter_label(year: Column | str, quarter: Column | str) -> Column:
    return F.concat(column(year).cast("string"), F.lit("-Q"), column(quarter).cast("string"))


def quantile_label(q: float) -> str:
    return f"{q * 100:.1f}%"


def calendar_parts(c: Column | str, prefix: str = "") -> dict[str, Column]:
    c = column(c)
    return {
        f"{prefix}year": F.year(c),
        f"{prefix}month": F.month(c),
        f"{prefix}quarter": F.quarter(c),
        f"{prefix}year_month": year_month(c),
    }


def period_label(latest_month: Column | str) -> Column:
    """"January-September"; "No data" without a latest month."""
    return F.coalesce(
        F.concat(F.lit("January-"), F.date_format(column(latest_month), "MMMM")), F.lit("No data")
    )
