from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from holdfast.operators import audit, learning
from holdfast.plans import job
from holdfast.plans.catalog import users_of
from holdfast.plans.job import JobSpec, resume_job, run_job
from holdfast.sources.facts import read_fact
from holdfast.sources.manifest import Manifest, files_digest, rows_digest
from holdfast.sources.staging import release_staged
from holdfast.sources.tables import read_table

SPEC = JobSpec(
    capacity=25, treatment_share=0.6, v1_boosting=replace(learning.V1_BOOSTING, rounds=2),
    v2_boosting=replace(learning.V2_BOOSTING, rounds=2))
FIRST = ["customer_month_panel", "feature_table", "panel_summary", "feature_summary",
         "scored_customers_rules", "metrics_rules", "scored_customers_v1", "metrics_model_v1"]


@pytest.fixture(scope="module")
def users(spark, data):
    customers = read_fact(spark, data, "customer").selectExpr("c_custkey AS customer_id")
    return users_of(spark, data, customers)


def test_a_killed_job_goes_on_behind_its_last_table(spark, data, tmp_path, users, monkeypatch):
    release_staged(spark)
    write = job.write_table

    def dies(df, path, *rest):
        write(df.limit(3), path, *rest)
        raise KeyboardInterrupt

    # The list is half written when the driver is lost.
    monkeypatch.setattr(
        job, "write_table",
        lambda df, path, *rest: (dies if path.endswith("intervention_list_v1") else write)(df, path, *rest))
    with pytest.raises(KeyboardInterrupt):
        run_job(spark, data, str(tmp_path), users, SPEC)
    assert release_staged(spark) == 0
    monkeypatch.setattr(job, "write_table", write)

    done = resume_job(spark, data, str(tmp_path), users, SPEC)
    assert release_staged(spark) == 0
    paths = done.paths
    assert len(paths) == 24 and done.built == [n for n in paths if n not in FIRST]
    checks = read_table(spark, paths["governance_checks"], audit.CHECK_SCHEMA, "csv").collect()
    assert len(checks) == 19 and {r["status"] for r in checks} == {"pass"}
    comparison = read_table(spark, paths["model_comparison"], audit.COMPARISON_SCHEMA, "csv")
    assert comparison.count() == 6
    assert spark.read.parquet(paths["intervention_list_v1"]).count() == 25
    assert spark.read.parquet(paths["feature_table"]).count() == 150 * 65
    counts = {r["table_name"]: (r["state"], r["rows"]) for r in done.manifest.collect()}
    assert set(counts) == set(paths) and counts["intervention_list_v1"] == ("done", 25)
    assert counts["scored_customers_v1"] == counts["customer_month_panel"] == ("done", 150 * 65)

    assert resume_job(spark, data, str(tmp_path), users, SPEC).built == []
    # Another list size leaves the scores as they are.
    smaller = resume_job(spark, data, str(tmp_path), users, replace(SPEC, capacity=20))
    assert not set(smaller.built) & {*FIRST, "chart_score_distribution_v1"}
    assert "intervention_list_v1" in smaller.built and "governance_checks" in smaller.built
    assert spark.read.parquet(paths["scored_customers_v2"]).count() == 20


def test_digests_follow_files_and_rows(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(5).write.parquet(path)
    before = files_digest(spark, path)
    assert files_digest(spark, path) == before
    spark.range(1).write.mode("append").parquet(path)
    assert files_digest(spark, path) != before
    rows = spark.range(6).select("id", (F.col("id") % 3).alias("user_id"))
    assert rows_digest(rows) == rows_digest(rows.orderBy(F.desc("id")))
    assert rows_digest(rows) != rows_digest(rows.where("id > 0"))
    assert rows_digest(rows.limit(0)) != rows_digest(rows)


def test_manifest_knows_whole_tables_only(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path))
    assert manifest.records == {}
    manifest.put("a", "1", "writing", "csv", "{}", None)
    assert not Manifest(spark, str(tmp_path)).holds("a", "1")
    manifest.put("a", "1", "done", "csv", "{}", 4)
    again = Manifest(spark, str(tmp_path))
    assert again.holds("a", "1") and not again.holds("a", "2") and not again.holds("b", "1")
    assert again.table().select("table_name", "rows").collect() == [("a", 4)]
