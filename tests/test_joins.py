from __future__ import annotations

import pytest
from compare import plan_of
from pyspark.sql import functions as F

from holdfast.operators import learning, policy
from holdfast.operators.joins import RepeatedKeys, checked_left_join
from holdfast.schema import FEATURES

KEYS = ["a", "b"]
LEFT = [(1, "x", 10), (1, "y", 11), (2, None, 12), (None, "x", 13), (3, "z", 14), (1, "x", 15)]


def frames(spark, right):
    return (
        spark.createDataFrame(LEFT, "a long, b string, own int"),
        spark.createDataFrame(right, "a long, b string, own int, other string, `dotted.name` double"),
    )


def test_each_left_row_has_its_only_match_or_nulls(spark):
    right = [(1, "x", 0, "one", 1.5), (2, None, 0, "null key", 2.0), (None, "x", 0, "null key", 2.0),
             (9, "q", 0, "unmatched", 3.0), (9, "q", 0, "unmatched", 3.0), (3, "z", 0, None, None)]
    found = checked_left_join(*frames(spark, right), KEYS)
    assert found.columns == ["a", "b", "own", "other", "dotted.name"]
    got = {r["own"]: (r["other"], r["dotted.name"]) for r in found.collect()}
    none = (None, None)
    assert got == {10: ("one", 1.5), 15: ("one", 1.5), 11: none, 12: none, 13: none, 14: none}


@pytest.mark.parametrize("surplus", [1, 7])
def test_a_repeated_key_raises_with_the_number_of_surplus_rows(spark, surplus):
    right = [(1, "y", 0, "same", 1.0)] + [(1, "y", 0, f"{k}", 1.0) for k in range(surplus)]
    with pytest.raises(RepeatedKeys, match=f"traits repeats its keys .* add {surplus} rows") as failed:
        checked_left_join(*frames(spark, right), KEYS, "traits")
    assert failed.value.surplus == surplus and isinstance(failed.value, ValueError)


def test_empty_sides_and_a_right_side_of_keys_only(spark):
    left, right = frames(spark, [(1, "x", 0, "one", 1.0)])
    assert checked_left_join(left.limit(0), right, KEYS).count() == 0
    assert checked_left_join(left, right.limit(0), KEYS).where("other IS NULL").count() == 6
    assert checked_left_join(left, right.select(*KEYS), KEYS).columns == left.columns
    with pytest.raises(ValueError, match="right side lacks required columns"):
        checked_left_join(left, right.drop("a"), KEYS)


def test_the_check_reads_nothing_again(spark, tmp_path, monkeypatch):
    left, right = frames(spark, [(1, "x", 0, "one", 1.0)])
    left.write.parquet(f"{tmp_path}/left")
    right.write.parquet(f"{tmp_path}/right")
    left, right = spark.read.parquet(f"{tmp_path}/left"), spark.read.parquet(f"{tmp_path}/right")
    from holdfast.operators import joins

    plans, stage = [], joins.stage

    def watched(df, label):
        plans.append(plan_of(df))
        return stage(df, label)

    monkeypatch.setattr(joins, "stage", watched)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checked", "")
    checked_left_join(left, right, KEYS)
    jobs = len(tracker.getJobIdsForGroup("checked"))
    spark.sparkContext.setJobGroup("plain", "")
    plain = left.join(right.drop("own").join(left.select(*KEYS), KEYS, "left_semi"), KEYS, "left")
    stage(plain, "plain")
    spark.sparkContext.setJobGroup("rest", "")
    (plan,) = plans
    assert plan.count("FileScan") == plan_of(plain).count("FileScan") == 3
    assert "CollectMetrics" in plan and jobs <= len(tracker.getJobIdsForGroup("plain")) + 1


def test_both_joins_of_the_workload_are_checked(spark):
    row = {"customer_id": 1, "snapshot_month": "2001-04"}
    traits = spark.createDataFrame([row]).withColumns({c: F.lit(1.0) for c in FEATURES})
    scores = spark.createDataFrame([{**row, "score": 0.5}])
    assert policy.join_candidates(scores, traits).count() == 1
    part = spark.createDataFrame([row]).withColumns(
        {c: F.lit("treatment") for c in learning.LEDGER_PART if c not in row}
    )
    assert learning.join_ledger(traits, part).count() == 1
    for twice in (traits.union(traits), traits.union(traits.withColumn(FEATURES[0], F.lit(2.0)))):
        with pytest.raises(RepeatedKeys, match="add 1 rows"):
            policy.join_candidates(scores, twice)
        with pytest.raises(RepeatedKeys, match="add 1 rows"):
            learning.join_ledger(twice, part)
