"""What scratch and shuffles leave on disk, and when they go."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from catalogue import bindings as b
from catalogue import checks, layers
from landledger import storage
from landledger.operators import copies
from landledger.operators.row_ids import dense_row_id
from landledger.sources.snapshots import write_observed
from landledger.sources.writers import sink_clean, write_csv


def shuffle_files(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def scratch_folders(spark) -> set[str]:
    return set(os.listdir(storage.shared_folder(spark).removeprefix("file:")))


def rows(spark):
    return spark.range(2_000).withColumn("t", F.concat(F.lit("x"), F.col("id") % 900)).repartition(3, "t")


WRITES = {
    "materialise": lambda df, to: storage.materialise(df, "rows"),
    "built": lambda df, to: storage.materialise_built(df.sparkSession, lambda: df, "rows"),
    "observed": lambda df, to: write_observed(df, to),
    "csv": lambda df, to: write_csv(df, to),
    "clean": lambda df, to: sink_clean(df, to),
}


@pytest.mark.parametrize("way", WRITES)
def test_a_write_leaves_no_shuffle_files(spark, tmp_path, way):
    before, setting = shuffle_files(spark), spark.conf.get(storage.CLEANUP_SETTING)
    WRITES[way](rows(spark), str(tmp_path / "out"))
    for _ in range(100):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(storage.CLEANUP_SETTING) == setting


def test_a_lazy_result_keeps_its_shuffle(spark):
    df, before = rows(spark).groupBy("t").count(), shuffle_files(spark)
    with storage.shuffles_cleaned(spark), storage.shuffles_cleaned(spark):
        pass
    assert len(df.collect()) == 900
    time.sleep(0.5)
    assert shuffle_files(spark) - before and len(df.collect()) == 900


def test_a_failed_write_puts_the_setting_back(spark, tmp_path):
    setting = spark.conf.get(storage.CLEANUP_SETTING)
    with pytest.raises(Exception, match="broken"):
        storage.materialise(spark.range(1).select(F.raise_error(F.lit("broken")).cast("int").alias("x")), "rows")
    assert spark.conf.get(storage.CLEANUP_SETTING) == setting


def test_a_staged_table_leaves_only_its_own_rows(spark):
    """The delivered rows, the copy marks and the raw layer lay on disk until the end of the query."""
    before = scratch_folders(spark)
    df = spark.createDataFrame([(3, "c"), (1, "a"), (1, "a"), (2, None)], "n int, t string")

    def raw(spark, d):
        return storage.materialise_built(spark, lambda: copies.drop_copies_stored(df), "raw")

    staged = layers._staged(spark, None, raw, lambda layer: dense_row_id(layer, ["n"], "id"))
    left = scratch_folders(spark) - before
    assert len(left) == 1 and next(iter(left)).startswith("row-ids-")
    assert sorted(staged.collect()) == [(1, 1, "a"), (2, 2, None), (3, 3, "c")]


def test_own_scratch_of_threads_side_by_side(spark):
    def job(n):
        def run():
            with storage.own_scratch(spark):
                storage.materialise(spark.range(n), "lost")
                with storage.surviving():
                    return storage.materialise(spark.range(n), "kept")

        return run

    before = scratch_folders(spark)
    found = storage.run_together([job(n) for n in range(1, 5)])
    assert [df.count() for df in found] == [1, 2, 3, 4]
    assert all(name.startswith("kept-") for name in scratch_folders(spark) - before)
    with pytest.raises(ValueError), storage.own_scratch(spark):
        storage.materialise(spark.range(1), "lost")
        raise ValueError
    assert not any(name.startswith("lost-") for name in scratch_folders(spark) - before)


def test_tables_under_test_are_built_one_after_another(spark, monkeypatch):
    running, most = [], []

    def build(*_):
        running.append(1)
        most.append(len(running))
        time.sleep(0.05)
        running.pop()

    for name in ("stg_tx", "stg_index", "stg_planning", "materialise", "summary_mart"):
        monkeypatch.setattr(checks, name, build)
    for name in ("monthly", "stored_county", "stored_planning"):
        monkeypatch.setattr(b, name, build)
    assert len(checks._tables(spark, None)) == 7 and max(most) == 1


def test_lines_are_narrowed_before_their_lookups(spark):
    """Tax, supplier and the time of day were exchanged with every line."""
    plan = b.tx_raw(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = max(i for i, line in enumerate(plan) if "Join LeftOuter, (l_" in line)
    above = [i for i, line in enumerate(plan) if "l_tax" in line or "l_suppkey" in line]
    assert above and all(i > joins for i in above) and sum("vat_flag" in line for line in plan) >= 2
