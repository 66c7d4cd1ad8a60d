"""Scratch tables go when the work that made them is written."""

import os

from raillark.llm import near_dedup, workspace


def test_stored_tables_go_after_the_write(spark, edge_docs, tmp_path):
    kept = workspace.stored(spark.range(3), "kept")
    had = len(workspace._named)
    with workspace.passing(spark):
        near_dedup.near_components(edge_docs).write.parquet(f"file://{tmp_path}/out")
        made = list(workspace._named[had:])
    assert len(made) > 3 and not any(os.path.exists(p.removeprefix("file:")) for p in made)
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 10 and kept.count() == 3
