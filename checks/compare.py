"""Run registered queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from loadcast.session import build_session

from .oracles import ORACLES
from .queries import QUERIES


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted: the order of neither matters."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_float_dtype(column):
            frame[name] = column.map(lambda v: "null" if pd.isna(v) else repr(float(v) + 0.0))
        elif pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.map(str)
        else:
            frame[name] = column.map(lambda v: "null" if v is None or v is pd.NaT or v != v else str(v))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    left, right = canonical(got), canonical(want)
    wrong = (left != right).any(axis=1)
    if wrong.any():
        first = wrong.idxmax()
        return f"{int(wrong.sum())} rows differ, first {left.loc[first].to_dict()} != {right.loc[first].to_dict()}"
    return None


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "checks", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "10g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.perf_counter()
        got = QUERIES[name](spark, sf_dir).toPandas()
        seconds = time.perf_counter() - started
        if name not in ORACLES:
            print(f"{name:28s} {seconds:6.2f}s rows only: {len(got)}", flush=True)
            continue
        found = difference(got, connection.execute(ORACLES[name]).df())
        failed += found is not None
        print(f"{name:28s} {seconds:6.2f}s rows {len(got):6d} {'ok' if found is None else 'DIFF ' + found[:600]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
