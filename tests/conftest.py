from __future__ import annotations

import datetime as dt

import pytest

from loadcast.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def hourly(spark):
    """``hourly(values, series)``: one row per hour from 2024-01-01 (a Monday)."""

    def build(values, series="all"):
        rows = [(series, START + dt.timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, y double")

    return build


@pytest.fixture(scope="session")
def pairs(spark):
    def build(actual, predicted, schema="y double, prediction double"):
        return spark.createDataFrame([(float(a), float(p)) for a, p in zip(actual, predicted)], schema)

    return build
