from __future__ import annotations

import os

import pytest

from holdfast.sources.staging import release_staged, stage, staging_path
from holdfast.sources.tables import read_table, write_table

DDL = "customer_id BIGINT, snapshot_month STRING, score DOUBLE"
ROWS = [(i, f"2024-0{i % 3 + 1}", i / 7) for i in range(30)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("partition", [None, "snapshot_month"])
def test_roundtrip(spark, tmp_path, fmt, partition):
    frame = spark.createDataFrame(ROWS, DDL)
    path = write_table(frame, str(tmp_path / "t"), fmt, partition)
    back = read_table(spark, path, DDL, fmt)
    assert back.columns == frame.columns and back.dtypes == frame.dtypes
    assert sorted(map(tuple, back.collect())) == ROWS
    if partition:
        assert {n for n in os.listdir(path) if "=" in n} == {f"snapshot_month=2024-0{i}" for i in (1, 2, 3)}


def test_month_filter_prunes_partitions(spark, tmp_path):
    path = write_table(spark.createDataFrame(ROWS, DDL), str(tmp_path / "t"), "parquet", "snapshot_month")
    pruned = read_table(spark, path, DDL).where("snapshot_month = '2024-02'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_month" in plan


def test_overwrite_and_single_file(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame(ROWS, DDL), path)
    write_table(spark.createDataFrame(ROWS[:4], DDL).repartition(4), path, "csv", single_file=True)
    assert len([n for n in os.listdir(path) if n.endswith(".csv")]) == 1


def test_unknown_format_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown table format"):
        write_table(spark.range(1), str(tmp_path / "t"), "xml")
    with pytest.raises(ValueError, match="unknown table format"):
        read_table(spark, str(tmp_path / "t"), DDL, "xml")


def test_staged_copy_is_a_scan_below_the_checkpoint_folder(spark):
    copy = stage(spark.createDataFrame(ROWS, DDL).selectExpr("*", "score * 2 AS twice"), "copy")
    assert sorted(r["twice"] for r in copy.collect()) == sorted(2 * s for _, _, s in ROWS)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert staging_path(spark, "x").startswith(root.rstrip("/"))
    plan = copy.select("twice")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:double>" in plan


def test_release_deletes_the_copies(spark):
    release_staged(spark)
    copy = stage(spark.range(3), "gone")
    assert release_staged(spark) == 1
    with pytest.raises(Exception):
        copy.collect()
