import pytest
from pyspark.sql import functions as F

from landledger import schemas
from landledger.operators import copies
from landledger.plans import cleaning


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i % 70, f"t{i % 70}" if i % 5 else None, -0.0 if i % 2 else 0.0) for i in range(100)]
    return spark.createDataFrame(data, "`a.b` int, text string, x double").repartition(5)


def plain(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("digest, marks", [(None, copies.MARKS), (7, copies.MARKS), (None, 64), (-3, 1)])
def test_equal_to_one_shuffle_whatever_collides(spark, rows, digest, marks):
    digest = None if digest is None else F.lit(digest).cast("long")
    got = copies.drop_copies(rows, digest, marks)
    expected = rows.dropDuplicates()
    assert got.columns == rows.columns and got.count() == expected.count()
    assert got.exceptAll(expected).isEmpty()
    n = expected.count()
    assert copies.copy_count(rows, digest, marks).first() == (100, n, 100 - n)


def test_rows_without_a_copy_are_not_suspect(rows):
    single, suspect = copies.split_repeated(rows)
    assert suspect.count() == 60 and single.count() == 40
    assert single.dropDuplicates().count() == 40 and single.intersect(suspect).isEmpty()


def test_empty_nulls_and_one_hot_row(spark):
    empty = spark.createDataFrame([], "a int, _digest string")
    assert copies.drop_copies(empty).isEmpty() and copies.copy_count(empty).first() == (0, 0, 0)
    hot = spark.createDataFrame([(None, None)] * 50 + [(1, "x" * 100_000)], "a int, _digest string")
    assert copies.drop_copies(hot).count() == 2 and copies.copy_count(hot).first() == (51, 2, 49)


def test_nested_columns(spark):
    df = spark.sql("SELECT array(named_struct('n', id % 3)) AS s, CAST('NaN' AS double) AS x FROM range(9)")
    assert copies.drop_copies(df).count() == 3


def test_cleaning_takes_either_way(spark):
    given = [("01/03/2020", f"a{i % 3}", "CORK", None, "€1,000.00", "No", "Yes", None, None) for i in range(8)]
    raw = spark.createDataFrame(given, schemas.text_schema(schemas.REGISTER_SOURCE_COLUMNS))
    assert plain(cleaning.clean_tx(raw, copies.drop_copies)) == plain(cleaning.clean_tx(raw))
    assert cleaning.clean_planning(raw, copies.drop_copies).count() == 3
