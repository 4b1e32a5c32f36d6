from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadcast.schema import BACKTEST_SCHEMA, SeriesColumns
from loadcast.sources import (
    load_predictions,
    load_record,
    load_series,
    optional_table,
    require_paths,
    save_record,
    write_table,
)

ENERGY = SeriesColumns(time="Datetime", target="Load_MW")


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_unsorted_csv_with_a_duplicate_becomes_unique_rows(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "Datetime,Load_MW",
        "2024-01-01 02:00:00,120",
        "2024-01-01 01:00:00,100",
        "2024-01-01 01:00:00,100",
    )
    rows = load_series(spark, path, ENERGY).orderBy("Datetime").collect()
    assert [(r["series_id"], r["Datetime"], r["Load_MW"]) for r in rows] == [
        ("all", dt.datetime(2024, 1, 1, 1), 100.0),
        ("all", dt.datetime(2024, 1, 1, 2), 120.0),
    ]


def test_columns_are_matched_by_name_and_extras_pass_through(spark, tmp_path):
    path = write(tmp_path / "a.csv", "note,Load_MW,Datetime", "x,1,2024-01-01 00:00:00", "y,NaN,2024-01-01 01:00:00")
    rows = load_series(spark, path, ENERGY).orderBy("Datetime").collect()
    assert [(r["note"], r["Load_MW"]) for r in rows] == [("x", 1.0), ("y", None)]


def test_files_of_one_folder_are_read_by_their_own_header(spark, tmp_path):
    folder = tmp_path / "mixed folder"
    folder.mkdir()
    write(folder / "a.csv", "Datetime,Load_MW,temp", "2024-01-01 00:00:00,100,1")
    write(folder / "b.csv", "Datetime,temp,Load_MW", "2024-01-01 01:00:00,4,900")
    write(folder / "c.csv", "Load_MW,Datetime", '"300",2024-01-01 02:00:00')
    write(folder / "d.csv", "Datetime,Load_MW,temp", "2024-01-01 03:00:00,5,6")
    (folder / "empty.csv").write_text("")
    with gzip.open(folder / "e.csv.gz", "wt") as out:
        out.write("temp,Load_MW,Datetime\n7,8,2024-01-01 04:00:00\n")
    rows = load_series(spark, str(folder), ENERGY).orderBy("Datetime").collect()
    assert [(r["Datetime"].hour, r["Load_MW"], r["temp"]) for r in rows] == [
        (0, 100.0, "1"), (1, 900.0, "4"), (2, 300.0, None), (3, 5.0, "6"), (4, 8.0, "7"),
    ]
    write(folder / "f.csv", "Datetime,Other", "2024-01-01 05:00:00,1")
    with pytest.raises(ValueError, match=r"f\.csv: \['Load_MW'\]"):
        load_series(spark, str(folder), ENERGY)


def test_predictions_of_differing_headers(spark, tmp_path):
    write(tmp_path / "a.csv", "ts,y,prediction,residual", "2024-01-01 00:00:00,10,7,3")
    write(tmp_path / "b.csv", "prediction,ts,y", "5,2024-01-01 01:00:00,1")
    rows = load_predictions(spark, str(tmp_path)).orderBy("ts").collect()
    assert [(r["y"], r["prediction"], r["residual"], r["absolute_error"]) for r in rows] == [(10, 7, 3, 3), (1, 5, -4, 4)]


def test_the_smallest_of_differing_duplicates_is_kept(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "Datetime,Load_MW,note",
        "2024-01-01 00:00:00,,gap",
        "2024-01-01 00:00:00,7,high",
        "2024-01-01 00:00:00,3,low",
    )
    row = load_series(spark, path, ENERGY).first()
    assert (row["Load_MW"], row["note"]) == (3.0, "low")


def test_missing_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        load_series(spark, str(tmp_path / "nowhere.csv"), ENERGY)


def test_missing_columns_are_listed_sorted(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Other,WrongColumn", "1,2")
    with pytest.raises(ValueError, match=r"Missing required columns: \['Datetime', 'Load_MW'\]"):
        load_series(spark, path, ENERGY)


def test_a_bad_timestamp_fails_the_load(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Datetime,Load_MW", "not a time,1")
    with pytest.raises(PySparkException):
        load_series(spark, path, ENERGY).collect()


def test_a_given_pattern_is_used(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Datetime,Load_MW", "31/12/2023 23:00,5")
    row = load_series(spark, path, ENERGY, pattern="dd/MM/yyyy HH:mm").first()
    assert row["Datetime"] == dt.datetime(2023, 12, 31, 23)


def test_predictions_survive_csv_and_errors_are_completed(spark, tmp_path):
    saved = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), 10.0, 12.5), ("a", dt.datetime(2024, 1, 2), 10.0, 7.25)],
        "series_id string, ts timestamp_ntz, y double, prediction double",
    )
    path = write_table(saved, str(tmp_path / "deep" / "er" / "predictions"), "csv")
    rows = load_predictions(spark, path).orderBy("ts").collect()
    assert [(r["residual"], r["absolute_error"]) for r in rows] == [(-2.5, 2.5), (2.75, 2.75)]
    with pytest.raises(FileNotFoundError, match="Final predictions"):
        load_predictions(spark, str(tmp_path / "none"))


def test_records_keep_maps_rows_and_nulls(spark, tmp_path):
    record = spark.sql(
        "SELECT map('high', 1L) AS severity_counts, array(struct(1.5D AS score)) AS top, false AS flag, "
        "CAST(NULL AS DOUBLE) AS train_seconds"
    )
    path = save_record(record, str(tmp_path / "record"))
    assert load_record(spark, path, record.schema).collect() == record.collect()
    with pytest.raises(FileNotFoundError, match="missing_record"):
        load_record(spark, str(tmp_path / "missing_record"))


def test_indented_records_and_bad_ones(spark, tmp_path):
    record = {"model": "forest", "counts": {"high": 1, "low": 2}, "top": [{"score": 1.5}], "n": 3}
    path = tmp_path / "indented.json"
    path.write_text(json.dumps(record, indent=4, sort_keys=True))
    schema = "model string, counts map<string, bigint>, top array<struct<score: double>>, n bigint"
    found = load_record(spark, str(path), schema).first()
    assert (found["model"], found["counts"], found["top"][0]["score"], found["n"]) == ("forest", {"high": 1, "low": 2}, 1.5, 3)
    assert load_record(spark, str(path)).count() == 1
    path.write_text('{"model": "forest", "n": ')
    with pytest.raises(ValueError, match="Malformed"):
        load_record(spark, str(path), schema)
    path.write_text("")
    with pytest.raises(ValueError, match="No record"):
        load_record(spark, str(path), schema)


def test_optional_and_required_artifacts(spark, tmp_path):
    empty = optional_table(spark, str(tmp_path / "backtest"), BACKTEST_SCHEMA)
    assert empty.columns == BACKTEST_SCHEMA.names and empty.count() == 0
    written = write_table(spark.range(3).select(F.col("id")), str(tmp_path / "ids"))
    require_paths(spark, [written])
    with pytest.raises(FileNotFoundError, match="absent_one.*absent_two"):
        require_paths(spark, [written, str(tmp_path / "absent_one"), str(tmp_path / "absent_two")])
