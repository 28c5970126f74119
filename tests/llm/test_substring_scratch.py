"""Substring dedup leaves nothing but its result behind."""

import os

from apronlake.llm import shared, substring_dedup


def test_catalog_and_scratch_hold_the_result_only(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(shared, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(shared, "BUCKET_BYTES", 1 << 10)
    tables = {t.name for t in spark.catalog.listTables()}
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(i, f"{'a b c ' * i}{passage} end {i}") for i in range(40)] + [(None, passage), (50, None)]
    got = {r.doc_id: r.n_removed for r in substring_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == 0 and got[None] == 0 and got[50] == 0 and all(got[i] >= 20 for i in range(1, 40))
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert os.listdir(tmp_path) == ["substring-result"]
