import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landledger.functions import dates, numbers, text


def values(spark, inputs, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_sale_dates(spark):
    got = values(spark, ["31/02/2020", "1/3/2020", "01/03/2020", "", None, "2020-01-01"], dates.parse_sale_date)
    assert got == [None, dt.date(2020, 3, 1), dt.date(2020, 3, 1), None, None, None]


def test_prices(spark):
    got = values(spark, ["€1,000.00", "â‚¬2,500.5", " 7 ", "abc", "0", "-5", None, ""], numbers.parse_price)
    assert got == [
        Decimal("1000.00"), Decimal("2500.50"), Decimal("7.00"), None, Decimal("0.00"), Decimal("-5.00"), None, None,
    ]


def test_title_case_equals_python(spark):
    words = [" dún laoghaire-rathdown ", "O'NEILL", "NATION_0", "a1b c", "ÉIRE", "", None, "x--y"]
    got = values(spark, words, text.title_case)
    assert got == [w if w is None else w.title() for w in words]


def test_trim_equals_python(spark):
    words = ["\t a b \n", " x ", "", None, "\x1cq\x1f", "plain"]
    assert values(spark, words, text.trim_text) == [w if w is None else w.strip() for w in words]


def test_missing_tokens(spark):
    got = values(spark, ["NA", "N/A", "null", "", "None", "nan", "Nan", "na", None], text.missing_to_null)
    assert got == [None, None, None, None, None, None, "Nan", "na", None]


SIZES = [
    "less than 38 sq metres",
    "Greater than or equal to 38 sq metres and less than 125 sq metres",
    "greater than orequal to 38 sq metres and less than 125 sq metres",
    "greater than or equal to 125 sq metres",
    "less than 38 and greater than orequal to 125",
    "greater than 125",
    "something",
    None,
]


def test_ingest_size_classes(spark):
    assert values(spark, SIZES, text.size_category_ingest) == [
        "Under 38 sq m", "38-124 sq m", "38-124 sq m", "125 sq m or more", "125 sq m or more",
        "Unknown", "Unknown", "Unknown",
    ]


def test_eda_size_classes(spark):
    assert values(spark, SIZES, text.size_category_eda) == [
        "Less than 38 sq m", "38–124 sq m", "38–124 sq m", "Other / Unclassified", "Less than 38 sq m",
        "125+ sq m", "Other / Unclassified", "Unknown",
    ]


def test_flags(spark):
    words = ["New Dwelling house /Apartment", "Second-Hand Dwelling house /Apartment", "SECOND-HAND flat", None]
    assert values(spark, words, lambda c: text.mentions(c, text.NEW_PHRASE)) == [True, False, False, False]
    assert values(spark, words, lambda c: text.mentions(c, text.SECOND_HAND_PHRASE_INGEST)) == [False, True, True, False]
    assert values(spark, words, lambda c: text.mentions(c, text.SECOND_HAND_PHRASE_EDA)) == [False, True, False, False]
    assert values(spark, ["Yes", "yes", "No", None], text.is_yes) == [True, False, False, None]
    assert values(spark, ["Yes", "yes", "No", None], text.is_yes_any_case) == [True, True, False, None]


def test_outcomes_are_not_exclusive(spark):
    words = ["Unconditional", "granted", "Refused", "REFUSED / GRANTED", None]
    assert values(spark, words, lambda c: text.contains_any(c, "grant", "conditional")) == [True, True, False, True, None]
    assert values(spark, words, lambda c: text.contains_any(c, "refus")) == [False, False, True, True, None]


def test_epoch_text(spark):
    got = values(spark, ["1577836800000", "1577836800000.0", "1577923199999", "-1", "", None], dates.epoch_ms_to_date)
    assert got == [dt.date(2020, 1, 1), dt.date(2020, 1, 1), dt.date(2020, 1, 1), dt.date(1969, 12, 31), None, None]


def test_index_month_and_labels(spark):
    assert values(spark, ["2005 January", "2005 Foo", None], dates.parse_index_month) == [dt.date(2005, 1, 1), None, None]
    assert values(spark, [1, 9, 12], dates.month_name, "int") == ["January", "September", "December"]
    assert [dates.quantile_label(q) for q in (0.01, 0.995)] == ["1.0%", "99.5%"]
    assert values(spark, [dt.date(2026, 9, 1), None], dates.period_label, "date") == ["January-September", "No data"]


def test_typed_raises_on_dirty_text_only(spark):
    assert values(spark, ["12", "", None], lambda c: text.typed(c, "int")) == [12, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["12x"], lambda c: text.typed(c, "int"))


def test_flag_text(spark):
    assert values(spark, ["True", "False", "Yes", "", None], text.flag_or_false) == [True, False, True, False, False]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(numbers.ratio_pct("a", "b")).collect()] == [33.33, None, None]


def test_rounding_follows_numpy(spark):
    import numpy as np

    numbers_in = [1.015, 2.675, 0.125, -0.125, 1234.565, None]
    got = values(spark, numbers_in, lambda c: numbers.round_even(c, 2), "double")
    assert got == [None if v is None else float(np.round(v, 2)) for v in numbers_in]


def test_plain_number(spark):
    got = values(spark, [34248.0, 27924379210.11, 0.5, 100.0], numbers.plain_number, "double")
    assert got == ["34248.0", "27924379210.11", "0.5", "100.0"]


def test_exact_mean_rounds_halves_away(spark):
    df = spark.createDataFrame([("0.01", 2), ("-0.01", 2), ("10.00", 3), ("1.00", 0)], "t string, n int")
    out = df.select(numbers.exact_mean(F.col("t").cast("decimal(36,2)"), F.col("n")).alias("m"))
    assert [r.m for r in out.collect()] == [Decimal("0.01"), Decimal("-0.01"), Decimal("3.33"), None]
