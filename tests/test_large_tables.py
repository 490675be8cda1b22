"""What keeps exchanges, written bytes and work per row low on large tables."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from catalogue import bindings as b
from landledger.functions import numbers, text
from landledger.operators import clustering, copies
from landledger.plans import exploration
from landledger.plans.rebuild import rebuild
from landledger.session import pin_settings
from landledger.sources import readers, snapshots, writers

SF_DIR = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rank_is_the_number_of_points_reached(spark):
    points = [-1.0, 0.0, 0.0, 2.5, 7.0]
    values = [None, -2.0, -1.0, 0.0, 1.0, 2.5, 6.9, 7.0, 99.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(clustering.rank(F.col("v"), points)).collect()]
    assert got == [0, 0, 1, 3, 3, 4, 4, 5, 5, 5]


def test_layout_ranks_without_a_loop_over_splitters(spark):
    """Splitters were filtered in a lambda that worked the value out once for each of them."""
    df = spark.range(100).select(F.concat(F.lit("c"), F.col("id")).alias("c"), F.expr("date_add(DATE '2020-01-01', CAST(id AS INT))").alias("d"))
    assert "lambda" not in _plan(clustering.z_ordered(df, ["c", "d"]))


def test_wide_rows_meet_one_table_of_places(spark):
    """The register joins places and sizes; orders, customers and nations join each other before."""
    plan = _plan(b.tx_raw(spark, SF_DIR))
    joins = [len(m) for m in re.findall(r"^([ :+-]*)Join", plan, re.M)]
    wide = next(len(m) for m in re.findall(r"^([ :+-]*)(?=.*l_orderkey.*parquet)", plan, re.M))
    assert len(joins) == 4 and sum(j < wide for j in joins) == 2


@pytest.mark.parametrize("rows", [[], [(1, None), (1, None), (2, "x"), (None, None), (2, "x"), (3, "y")]])
def test_stored_copies(spark, rows):
    df = spark.createDataFrame(rows, "a long, `b (x)` string")
    found = copies.drop_copies_stored(df)
    assert sorted(map(str, found.collect())) == sorted(map(str, df.dropDuplicates().collect()))


def test_jobs_shuffle_no_rows_without_a_copy():
    assert rebuild.__defaults__[-1] is copies.drop_copies_stored


def test_exploration_takes_its_way_to_drop_copies(spark):
    row = ("2020-01-02", "1 Main St", "Cork", "100", "New Dwelling")
    df = spark.createDataFrame([row, row], "sale_date string, address string, county string, price_eur string, property_description string")
    seen = []

    def distinct(df):
        seen.append(df)
        return df.dropDuplicates()

    assert exploration.load_tx_eda(df, lambda df: df, distinct).count() == 1 and len(seen) == 1


def test_ends_are_stripped_of_every_blank(spark):
    values = ["", " ", "a", " a", "a\n", " a b　", "é ", "\té", "a ", "!~", "~", "~ x~", "\x7fa", "a\x1f", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in df.select(text.trim_text("v")).collect()] == [v and v.strip() for v in values]


def test_ascii_text_is_not_translated(spark):
    values = ["plain", "€ 1", "\x80 1", "é", "", None, "’x"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = df.select(text.cp1252_to_latin1("v").alias("v"))
    assert [r[0] for r in out.collect()] == ["plain", "\x80 1", "\x80 1", "é", "", None, "\x92x"]
    assert [r[0] for r in out.select(text.latin1_to_cp1252("v")).collect()] == ["plain", "€ 1", "€ 1", "é", "", None, "’x"]
    assert "CASE WHEN" in _plan(out)


def test_clean_text_may_be_compressed(spark, tmp_path):
    rows = [(f'a, "{i}"', i % 2 == 0) for i in range(50)]
    df = spark.createDataFrame(rows, "t string, f boolean")
    path = writers.sink_clean(df, str(tmp_path / "clean"), "csv", "gzip")
    assert all(name.endswith(".csv.gz") for name in os.listdir(path) if name.startswith("part-"))
    from landledger.schemas import text_schema

    found = {tuple(r) for r in readers.scan_text_raw(spark, path, text_schema(["t", "f"])).collect()}
    assert found == {(t, str(f)) for t, f in rows}


def test_url_words_of_labelled_hosts_reach_hosts_without_a_rule(spark):
    """Pages that differ by their first segment alone, of the same letters, so by no lexical feature."""
    from landledger.llm.url_filter import url_filter

    urls = [f"https://h{i}.{end}/{word}/{i}" for i in range(100, 250) for end in ("test", "new") for word in ("zq", "qz")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_filter(pages, [("test/", "allow"), ("test/zq/", "block")]).filter("rule IS NULL").collect()
    assert len(found) == 300 and all((r.verdict == "block") == r.path.startswith("/zq/") for r in found)


def test_texts_are_ranked_by_their_bytes_as_by_their_positions(spark):
    rng = random.Random(3)
    values = [None, "", "sh", "sh\0", "sha", "shé", *["sh" + "".join(rng.choice("\0ab~é€") for _ in range(rng.randint(0, 9))) for _ in range(400)]]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    spot = clustering.position("v", df.schema["v"].dataType, 2)
    points = sorted(r[0] for r in df.select(spot).dropna().sample(0.1, 5).collect())
    by_bytes = clustering.rank(clustering.first_bytes("v", 2), [clustering._as_bytes(p) for p in points])
    found = df.withColumn("spot", spot).select(clustering.rank(F.col("spot"), points), by_bytes).collect()
    assert len(points) > 20 and all(a == b for a, b in found)
    own = clustering.z_ordered(df, ["v"])
    assert own.count() == len(values) and "conv(" not in _plan(own)


def test_words_with_digits_and_signs_take_no_lambda(spark):
    """Every word with a sign other than letters and blanks was taken to pieces."""
    rng = random.Random(8)
    words = ["YES", "Yes", "No", "", " ", "NATION_12", "o'neill", "a-b", "x1y", "dun laoghaire", "ÉIRE 1", "a\n", "ßa b", "1st X", "A.B", None]
    words += ["".join(rng.choice("aZ b1_'-.é\t") for _ in range(rng.randint(1, 8))) for _ in range(500)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    pieces = F.regexp_extract_all("w", F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    raised = F.transform(pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substring(p, 2, 2**31 - 1))))
    plain = ~F.col("w").rlike(text._NOT_PLAIN_WORDS)
    got = df.select("w", text.title_case("w"), F.array_join(raised, ""), plain).collect()
    assert [a for _, a, _, _ in got] == [b for _, _, b, _ in got]
    assert {w for w, _, _, plain in got if plain} >= {"NATION_12", "YES", "dun laoghaire"}


def test_marks_of_prices_go_as_by_the_pattern(spark):
    rng = random.Random(9)
    values = ["€1,000.5", "â‚¬2", "â‚€¬3", "â‚,¬4", "€€,,5", "", ",", None]
    values += ["".join(rng.choice("€â‚¬,1.") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(numbers.without_marks("v")).collect()]
    assert got == [v and re.sub(numbers._CURRENCY_MARKS, "", v) for v in values]


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    """Many columns made one method of more bytecode than HotSpot compiles."""
    assert pin_settings(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_figures_hash_outside_of_the_observation(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (None, "b", 2.5)], "`x.y` int, t string, z double")
    seen = snapshots.write_observed(df, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.columns == df.columns and seen == snapshots.figures_of(stored)
    assert seen.rows == 2 and seen.nulls == {"x.y": 1, "t": 0, "z": 1}
    cells = [F.col(f"`{c}`") for c in df.columns]
    one, two = (F.xxhash64(F.lit(seed), *cells, *[c.isNull() for c in cells]) for seed in (1, 2))
    plain = df.agg(F.sum(one.cast("decimal(38,0)")).cast("string"), F.bit_xor(two)).first()
    assert seen.digest == f"{plain[0]}:{plain[1]}"
