"""Stages of the corpus pipeline against brute force."""

import os
import re

import duckdb
import pytest
from brute_force import brute_contamination, components, docs_of, prose, shingle_set

import corpus_pipeline as pipeline

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    after = []
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).cache()
        after.append((name, docs.columns, docs.collect()))
    assert [name for name, _, _ in after] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    assert all(columns == pipeline.COLUMNS for _, columns, _ in after[:-1])
    clean, unique, unleaked, mixed, placed = (rows for _, _, rows in after)

    wanted = components({r.doc_id: shingle_set(r.text, 5) for r in clean}, 80)
    assert {r.doc_id for r in unique} == {i for i, c in wanted.items() if i == c}

    hits = {d for d, _, n, _ in brute_contamination([(r.doc_id, r.text) for r in unique], items, 10) if n}
    assert {r.doc_id for r in unleaked} == {r.doc_id for r in unique} - hits

    tokens = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in unleaked}
    assert tokens(mixed) >= tokens(unleaked) * 4 // 5
    assert sorted(r.doc_id for r in placed) == sorted(r.doc_id for r in mixed)

    again = pipeline.run(spark, SF_DIR)
    assert sorted(again.collect()) == sorted(placed)


def test_odd_rows(spark, tmp_path):
    """Nulls in any column, repeated rows and ids, empty tables."""
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(1, "a b", "s"), (1, "a b", "s"), (1, "other words here", "s"), (None, "a b", None), (None, None, None), (2, "", "s")]
    rows += [(10 + i, prose(30, i), "src1") for i in range(20)]
    docs = docs_of(spark, rows)
    counts = []
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        counts.append(docs.count())
    # "a b" stands three times: one row of it stays, the other text of id 1 does
    assert counts[0] == 26 and counts[1] == counts[2] == 24
    assert counts[3] <= 24 and pipeline.STAGES[-1][1](spark, docs, folder).count() == counts[3]
    docs = docs.filter("false")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_each_row_gets_its_own_decision(spark, tmp_path):
    """Rows that share an id, or have none, are judged by their own texts."""
    folder = str(tmp_path)
    passage = prose(30, 500)
    spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    clean, other, copied = prose(60, 1), prose(60, 2), prose(60, 3)
    rows = [(1, f"{prose(20, 4)} {passage}", "s"), (1, clean, "s"), (None, f"{passage} {prose(20, 6)}", "s"), (None, other, None)]
    kept = pipeline.drop_leaks(spark, docs_of(spark, rows), folder).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, clean), (0, other)])

    rows = [(5, clean, "s"), (5, other, "s"), (9, copied, "s"), (3, copied, "s"), (None, copied, "s"), (None, clean, "s"), (None, prose(60, 9), "s")]
    kept = pipeline.drop_near_copies(spark, docs_of(spark, rows), folder).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(5, clean), (5, other), (3, copied), (0, prose(60, 9))])

    bad = "vile awful slur"
    docs = docs_of(spark, [(i, f"{prose(20, i)} {bad if i % 2 else ''}", "s") for i in range(400)])
    spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    rows = docs_of(spark, [(1001, prose(20, 901), "s"), (1001, f"{bad} {prose(20, 902)}", "s"), (None, f"{bad} {bad} x", "s"), (None, prose(20, 903), "s")])
    kept = pipeline.drop_toxic(spark, docs.union(rows), folder).collect()
    texts = {r.text for r in kept}
    assert {prose(20, 901), prose(20, 903)} <= texts and not any(bad in t for t in texts)

    many = docs_of(spark, [(None if i % 2 else 4, prose(20 + i % 5, i), "src1") for i in range(200)])
    mixed = pipeline.mix_sources(spark, many, folder).collect()
    assert 120 < len(mixed) < 200 and len({r.text for r in mixed}) == len(mixed)
    assert pipeline.place_in_shards(spark, many, folder).count() == 200
