from __future__ import annotations

import math

import numpy as np
import pytest
from compare import plan_of
from pyspark.sql import functions as F

from holdfast.operators import features, quantiles

SHARES = (0.25, 0.5, 0.75)


def columns(spark, **values):
    names = list(values)
    rows = list(zip(*values.values(), strict=True))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)


def test_every_rank_of_small_intervals(spark, monkeypatch):
    # Ties, one value only, alternating ends, nulls: narrowed with tiny samples.
    monkeypatch.setattr(quantiles, "GATHER", 3)
    monkeypatch.setattr(quantiles, "SAMPLE", 20)
    rng = np.random.default_rng(5)
    data = {
        "ties": [float(v) for v in rng.integers(0, 4, 300)],
        "constant": [7.0] * 300,
        "wide": [float(v) for v in rng.normal(0, 1e6, 300)],
        "ends": [1e308 if i % 2 else -1e308 for i in range(300)],
        "gaps": [None if i % 3 else float(i) for i in range(300)],
    }
    table = columns(spark, **data)
    held = {n: sorted(v for v in values if v is not None) for n, values in data.items()}
    ranks = {n: {0, 1, 42, 74, 75, 99, 149, 150, 298, 299, 300, -1} for n in data}
    found = quantiles.order_statistics(table, ranks, {n: len(v) for n, v in held.items()})
    assert found == {
        n: {r: v[r] for r in ranks[n] if 0 <= r < len(v)} for n, v in held.items()
    }


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(9)
    data = {
        "skewed": [float(v) for v in rng.pareto(0.4, 20_000)],
        "hot": [0.0 if v < 0.4 else float(v) for v in rng.random(20_000)],
        "one": [None] * 19_999 + [3.5],
        "none": [None] * 20_000,
    }
    rows = {"skewed": 20_000, "hot": 20_000, "one": 1, "none": 0}
    found = quantiles.exact_quantiles(columns(spark, **data), SHARES, rows)
    for name in ("skewed", "hot"):
        assert found[name] == pytest.approx(np.quantile(data[name], SHARES).tolist(), rel=1e-12)
    assert found["one"] == [3.5] * 3 and found["none"] == [None] * 3


def test_nan_is_the_largest_and_infinities_count(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "GATHER", 2)
    inf, nan = math.inf, math.nan
    table = columns(spark, x=[nan, inf, nan, -inf, 2.0, 1.0, -inf, nan])
    found = quantiles.order_statistics(table, {"x": range(8)}, {"x": 8})["x"]
    assert [found[r] for r in range(5)] == [-inf, -inf, 1.0, 2.0, inf]
    assert all(math.isnan(found[r]) for r in range(5, 8))


def test_ten_million_distinct_values(spark):
    # Multiplication by an odd number permutes the residues, so every value occurs once.
    n = 10_000_000
    table = spark.range(n).select(
        ((F.col("id") * 6_364_137 % n) / 8).alias("x"), (F.col("id") % 1000).cast("double").alias("y")
    )
    found = quantiles.exact_quantiles(table, SHARES, {"x": n, "y": n})
    assert found["x"] == [(n - 1) * share / 8 for share in SHARES]
    assert found["y"] == [249.75, 499.5, 749.25]


def test_an_aggregate_a_round_and_no_row_per_column(spark, monkeypatch):
    seen = []
    agg = type(spark.range(0)).agg

    def watched(df, *asked):
        seen.append(plan_of(result := agg(df, *asked)))
        return result

    table = spark.range(50_000).select(*[(F.rand(i) * 100).alias(f"c{i}") for i in range(12)])
    monkeypatch.setattr(type(table), "agg", watched)
    profile = features.numeric_profile(table, table.columns)
    assert profile.count() == 12
    # Moments, then a sample and a count a round, then the rows that are left.
    assert 3 <= len(seen) <= 8
    for plan in seen:
        assert not any(word in plan for word in ("Expand", "Generate", "Window", "hashpartitioning"))


def test_profile_leaves_columns_without_values_out(spark):
    table = columns(spark, a=[1.0, None, 4.0], b=[None] * 3, c=[None, 2.0, None])
    found = {r["column_name"]: r for r in features.numeric_profile(table, ["a", "b", "c"]).collect()}
    assert set(found) == {"a", "c"}
    assert found["a"]["p50"] == 2.5 and found["a"]["count"] == 2
    assert found["c"]["std"] is None and found["c"]["p25"] == found["c"]["max"] == 2.0
    assert features.numeric_profile(table.limit(0), ["a", "b"]).count() == 0


def test_wide_aggregates_are_compiled_and_samples_filtered(spark, monkeypatch):
    seen = []
    collect = type(spark.range(0)).collect

    def watched(df):
        rows = collect(df)
        seen.append(plan_of(df).split("Initial Plan")[0])
        return rows

    table = spark.range(70_000).select(*[(F.rand(i) * 100).alias(f"c{i}") for i in range(31)])
    monkeypatch.setattr(type(table), "collect", watched)
    features.numeric_profile(table, table.columns)
    measured = [plan for plan in seen if "Aggregate" in plan]
    assert measured
    for plan in measured:
        for line in plan.splitlines():
            # Counts and moments are compiled with their scan; samples are cut down below.
            assert "HashAggregate" not in line or "ObjectHash" in line or "*(" in line
        assert "ObjectHashAggregate" not in plan or "Filter" in plan
