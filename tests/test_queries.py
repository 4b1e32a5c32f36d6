"""Every registered query with SQL gives the SQL's rows."""

from __future__ import annotations

from pathlib import Path

import pytest

from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, database, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(got, database.execute(ORACLES[name]).df()) is None


def test_every_query_without_sql_is_a_model():
    assert set(QUERIES) - set(ORACLES) == {
        "rf_forecast",
        "gbt_forecast",
        "calendar_forest",
        "feature_importance",
        "model_comparison",
        "model_backtest",
        "final_evaluation",
        "forest_anomalies",
    }
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())
    assert entry(spark).count() == 15
