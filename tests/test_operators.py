import datetime as dt

import pytest
from pyspark.sql import functions as F

from landledger import storage
from landledger.operators import profile, series
from landledger.operators.row_ids import dense_row_id


def test_row_ids_equal_the_global_window(spark):
    rows = [(i % 7 if i % 11 else None, f"n{i % 50}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(5)
    got = dense_row_id(df, ["a", "b", "c"], "id").collect()
    expected = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert [(r.a, r.b, r.c) for r in sorted(got, key=lambda r: r.id)] == expected
    assert sorted(r.id for r in got) == list(range(1, 1001))


def test_row_ids_split_a_run_of_copies(spark):
    df = spark.range(2000).select(F.lit("same").alias("a"))
    numbered = dense_row_id(df, ["a"], "id")
    assert sorted(r.id for r in numbered.collect()) == list(range(1, 2001))


def test_row_ids_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    assert dense_row_id(df, ["a"], "id").collect() == []


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (1, "x "), (2, "y"), (2, "y"), (2, "y")], "a int, b string")
    assert profile.duplicate_count(df).first().asDict() == {"row_count": 7, "unique_rows": 4, "duplicate_rows": 3}
    # nulls come last, as in the other layers
    assert [tuple(r) for r in profile.duplicate_rows(df, 4).collect()] == [(1, None), (1, None), (2, "y"), (2, "y")]
    assert profile.drop_exact_duplicates(df).count() == 4


def test_missing_summary_order(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (3, None, None)], "x int, y string, z string")
    got = [tuple(r) for r in profile.missing_summary(df, 2).collect()]
    assert got == [("y", 3, 100.0), ("x", 1, 33.33), ("z", 1, 33.33)]


def test_value_counts_with_and_without_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "c string")
    assert [tuple(r) for r in profile.value_counts(df, "c").collect()] == [("a", 2), ("b", 1), (None, 1)]
    assert [tuple(r) for r in profile.value_counts(df, "c", False).collect()] == [("a", 2), ("b", 1)]


def test_guard(spark):
    df = spark.createDataFrame([(1,), (-1,)], "p int")
    rules = {"non-positive": F.col("p") <= 0}
    with pytest.raises(ValueError, match="non-positive"):
        profile.guard(df, rules)
    assert profile.guard(df.filter("p > 0"), rules).count() == 1
    with pytest.raises(ValueError, match="empty"):
        profile.guard(df.filter("p > 5"), rules)
    profile.guard(df.filter("p > 5"), rules, allow_empty=True)
    with pytest.raises(ValueError, match="missing expected columns"):
        profile.require_columns(df, ["p", "q"])


def test_growth_is_positional(spark):
    df = spark.createDataFrame([(2001, 10.0), (2003, 15.0), (2004, None), (2005, 5.0), (2006, 0.0), (2007, 1.0)], "y int, v double")
    got = {r.y: r.g for r in series.growth_pct(df, {"v": "g"}, ["y"]).collect()}
    assert got == {2001: None, 2003: 50.0, 2004: None, 2005: None, 2006: -100.0, 2007: None}


def test_correlation_table(spark):
    rows = [(dt.date(2020, m, 1), m, 5, (m * 2 if m > 2 else None)) for m in range(1, 7)]
    df = spark.createDataFrame(rows, "month date, a int, constant int, b int")
    got = {(r.market_metric, r.planning_metric): r for r in series.correlation_table(df, ["a", "constant"], ["b"], "month").collect()}
    assert (got["a", "b"].pearson_correlation, got["a", "b"].observations) == (1.0, 4)
    assert got["constant", "b"].pearson_correlation is None
    assert got["a", "b"].period_start == dt.date(2020, 1, 1)
    two = series.correlation_table(df.filter("b is null or a > 4"), ["a"], ["b"], "month").first()
    assert (two.pearson_correlation, two.observations) == (None, 2)


def test_set_coverage(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    b = spark.createDataFrame([("y",), ("z",)], "c string")
    assert sorted(tuple(r) for r in series.set_coverage(a, b, "c").collect()) == [("extra", "z"), ("missing", "x")]


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = spark.range(10)
    assert storage.materialise(df, "t").count() == 10
