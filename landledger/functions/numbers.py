"""Prices, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landledger.functions.text import column, trim_text

# The euro sign and its damaged form, and the thousands mark.
_CURRENCY_MARKS = "€|â‚¬|,"


def without_marks(c: Column | str) -> Column:
    """Currency text without its marks; the pattern is only used where the damaged sign may be."""
    c = column(c)
    none = F.lit("")
    plain = F.replace(F.replace(c, F.lit("€"), none), F.lit(","), none)
    return F.when(F.contains(c, F.lit("â")), F.regexp_replace(c, _CURRENCY_MARKS, "")).otherwise(plain)


def parse_number(c: Column | str, data_type: str = "double") -> Column:
    return trim_text(c).try_cast(data_type)


def parse_wide(c: Column | str) -> Column:
    """Text to decimal(38,10); digits after the tenth decimal are rounded.

    Unreadable text becomes null; a number that the type cannot hold raises, with its text.
    """
    # false for NaN and for text that is no number
    number = F.abs(parse_number(c)) <= F.lit(float("inf"))
    message = F.concat(F.lit("number out of range: "), column(c))
    return F.coalesce(parse_number(c, "decimal(38,10)"), F.when(number, F.raise_error(message)))


def parse_price(c: Column | str) -> Column:
    """Currency text to decimal(38,10); unreadable text becomes null."""
    return parse_wide(without_marks(c))


def holds_price(c: Column | str) -> Column:
    """Whether currency text is a number that ``parse_price`` reads; never raises, false for null."""
    return parse_number(without_marks(c), "decimal(38,10)").isNotNull()


def as_price(c: Column | str) -> Column:
    """Amount as decimal(18,6), unrounded; one with more digits raises, whatever the session's cast rules."""
    c = column(c)
    price = c.try_cast("decimal(18,6)")
    inexact = F.raise_error(F.concat(F.lit("amount does not fit decimal(18,6): "), c.cast("string")))
    return F.when(F.coalesce(price == c, c.isNull()), price).otherwise(inexact)


def as_money(c: Column | str) -> Column:
    """Amount as decimal(14,2), rounded half up; one that does not fit raises, whatever the session's cast rules."""
    c = column(c)
    large = F.raise_error(F.lit("amount does not fit decimal(14,2)"))
    return F.coalesce(F.round(c, 2).try_cast("decimal(14,2)"), F.when(c.isNotNull(), large))


def round_even(c: Column | str, digits: int) -> Column:
    """Binary half-even rounding of float columns, as NumPy rounds."""
    scale = float(10**digits)
    return F.rint(column(c).cast("double") * F.lit(scale)) / F.lit(scale)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as a float; a zero divisor gives null."""
    return F.try_divide(column(a).cast("double"), column(b).cast("double"))


def ratio_pct(a: Column | str, b: Column | str, digits: int | None = 2) -> Column:
    pct = ratio(a, b) * F.lit(100.0)
    return pct if digits is None else round_even(pct, digits)


def exact_mean(total: Column, rows: Column) -> Column:
    """Mean of a decimal(.,2) total, rounded once, halves away from zero."""
    cents = F.abs(total.cast("decimal(36,2)") * F.lit(100)).cast("decimal(36,0)")
    n = F.nullif(rows, F.lit(0)).cast("decimal(20,0)")
    whole = F.call_function("div", cents * F.lit(2) + n, n * F.lit(2))
    return (F.signum(total.cast("double")).cast("int") * whole.cast("decimal(16,0)") / F.lit(100)).cast(
        "decimal(14,2)"
    )


def float_mean(total: Column, rows: Column) -> Column:
    return F.try_divide(total.cast("double"), rows.cast("double"))


def plain_number(c: Column, places: int = 2) -> Column:
    """Text of a number with no exponent and at least one decimal."""
    return F.regexp_replace(c.cast(f"decimal(38,{places})").cast("string"), r"(\.\d+?)0+$", "$1")
