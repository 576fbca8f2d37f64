"""Every query with a SQL equivalent gives the same columns, types, rows and values."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from holdfast.plans.catalog import QUERIES
from oracles import ORACLES

TRAINED = {"model_v1_scores", "model_v1_metrics", "model_v2_scores", "model_v2_metrics"}


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_only_trained_models_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == TRAINED
    assert set(ORACLES) <= set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, data, duck, name):
    got = QUERIES[name](spark, data).toPandas()
    assert differences(got, duck.execute(ORACLES[name]).df()) == []


def test_entry(spark):
    assert entry(spark).count() == 10
