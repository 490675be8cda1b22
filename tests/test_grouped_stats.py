import random
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from landledger.operators.grouped_stats import (
    float_stats,
    grouped_stats,
    histogram,
    masked_stats,
    money_stats,
    quantile_rows,
    split_at_quantile,
)

QS = {"q01": 0.01, "q25": 0.25, "q50": 0.5, "q995": 0.995, "q0": 0.0, "q1": 1.0}


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v decimal(14,2)")


def skewed_rows(seed, n=3000):
    """One key holds a third of the rows, and one price a third of those."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None, "c"])
        if key == "hot" and i % 9 == 0:
            cents = 12_345_600
        else:
            cents = rnd.choice([rnd.randint(-50_000, 90_000_000), rnd.randint(100, 200) * 10_000])
        rows.append((key, None if rnd.random() < 0.02 else Decimal(cents) / 100))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_numpy_on_a_skewed_table(spark, seed):
    rows = skewed_rows(seed)
    groups = defaultdict(list)
    for k, v in rows:
        groups[k].append(v)
    got = {r.k: r for r in grouped_stats(frame(spark, rows), ["k"], "v", QS).collect()}
    assert set(got) == set(groups)
    for key, members in groups.items():
        known = sorted(int(v * 100) for v in members if v is not None)
        row = got[key]
        assert (row.rows, row.value_rows) == (len(members), len(known))
        assert row.total == sum(v for v in members if v is not None)
        for name, q in QS.items():
            assert row[name] == pytest.approx(np.quantile(known, q), abs=1e-6)


def test_whole_table_statistics(spark):
    rows = skewed_rows(3)
    known = [int(v * 100) for _, v in rows if v is not None]
    row = grouped_stats(frame(spark, rows), [], "v", QS).first()
    assert row.rows == len(rows)
    assert row.q50 == np.quantile(known, 0.5)
    labels = quantile_rows(frame(spark, rows), "v", [0.5, 0.995], with_range=True).collect()
    assert [r.percentile for r in labels] == ["min", "50.0%", "99.5%", "max"]
    assert labels[0].v == min(known) / 100 and labels[3].v == max(known) / 100


def test_null_groups_and_groups_without_values(spark):
    rows = [("a", Decimal("1.00")), ("a", Decimal("2.01")), (None, Decimal("3.00")), (None, None), ("c", None)]
    got = {r.k: r for r in money_stats(frame(spark, rows), ["k"], "v").collect()}
    # halves away from zero, as in 1.505 -> 1.51
    assert (got["a"].mean_price, got["a"].median_price) == (Decimal("1.51"), Decimal("1.51"))
    assert (got[None].transactions, got[None].median_price) == (2, Decimal("3.00"))
    assert (got["c"].transactions, got["c"].total_value, got["c"].median_price) == (1, None, None)
    floats = {r.k: r for r in float_stats(frame(spark, rows), ["k"], "v").collect()}
    assert floats["c"].total_value == 0 and floats["a"].median_price == pytest.approx(1.505)


def test_empty_table(spark):
    assert money_stats(frame(spark, []), ["k"], "v").collect() == []


def test_totals_without_quantiles(spark):
    rows = skewed_rows(4)
    tallies = {"dear": F.col("v") > 1000}
    row = grouped_stats(frame(spark, rows), [], "v", tallies=tallies).first()
    assert row.dear == sum(1 for _, v in rows if v is not None and v > 1000)


def test_only_exact_decimals(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    with pytest.raises(TypeError):
        grouped_stats(df, ["k"], "v", {"m": 0.5})


def test_masks_overlap_and_may_be_empty(spark):
    rows = [("a", Decimal(1)), ("a", Decimal(5)), ("b", Decimal(9)), (None, Decimal(3))]
    masks = [("a", F.col("k") == "a"), ("big", F.col("v") > 4), ("none", F.col("v") > 100)]
    got = [tuple(r) for r in masked_stats(frame(spark, rows), "v", masks, "label").collect()]
    assert got == [
        ("a", 2, 50.0, 3.0, 3.0, Decimal("6.00")),
        ("big", 2, 50.0, 7.0, 7.0, Decimal("14.00")),
        ("none", 0, 0.0, None, None, Decimal("0.00")),
    ]


def test_histogram_matches_numpy(spark):
    rnd = random.Random(5)
    cents = [rnd.randint(10_000, 5_000_000) for _ in range(2000)] + [90_000_000] * 10
    df = frame(spark, [("x", Decimal(c) / 100) for c in cents])
    got = histogram(df, "v", bins=50).collect()
    kept = [c for c in cents if c <= np.quantile(cents, 0.99)]
    counts, edges = np.histogram(kept, bins=50)
    assert [r.transactions for r in got] == counts.tolist()
    assert got[0].bin_start == pytest.approx(edges[0] / 100)
    assert got[-1].bin_end == pytest.approx(edges[-1] / 100)


def test_plan_keeps_groups_apart(spark):
    plan = money_stats(frame(spark, skewed_rows(6, 50)), ["k"], "v")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
    assert "percentile" not in plan and "collect_list" not in plan


def scans(df):
    """Table scans left in the executed plan, reused exchanges aside."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("FileScan parquet")


def test_each_statistic_scans_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, skewed_rows(7, 600)).write.parquet(path)
    df = spark.read.parquet(path)
    assert scans(money_stats(df, ["k"], "v")) == 1
    assert scans(money_stats(df, ["k"], "v", {"dear": F.col("v") > 9})) == 1
    names = ("all", "below", "above")
    assert scans(split_at_quantile(df, "v", 0.9, names, "view")) == 1
    masks = [("a", F.col("k") == "a"), ("big", F.col("v") > 4)]
    assert scans(masked_stats(df, "v", masks, "label")) == 1
    assert scans(quantile_rows(df, "v", [0.5])) == 1
