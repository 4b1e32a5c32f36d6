"""``spark-submit``-able workflow: ``python -m loadcast SOURCE OUTPUT [step ...]``."""

from __future__ import annotations

import argparse

from .plans.run import STEPS, Run
from .schema import SeriesColumns
from .session import build_session, owned_staging


def main() -> None:
    parser = argparse.ArgumentParser(prog="loadcast", description=__doc__)
    parser.add_argument("source", help="demand table: one file or a folder")
    parser.add_argument("output", help="folder for models, metrics, predictions and anomalies")
    parser.add_argument("steps", nargs="*", default=STEPS, help=f"any of {', '.join(STEPS)}; all by default")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--series", default="series_id", help="series column; added when the table has none")
    parser.add_argument("--time", default="ts")
    parser.add_argument("--target", default="y")
    parser.add_argument("--parallelism", type=int, default=1, help="backtest fits submitted at once")
    given = parser.parse_args()
    unknown = [s for s in given.steps if s not in STEPS]
    if unknown:
        parser.error(f"unknown steps: {unknown}")
    cols = SeriesColumns(given.series, given.time, given.target)
    spark = build_session()
    run = Run(spark, given.source, given.output, cols, given.format, parallelism=given.parallelism)
    with owned_staging(spark):
        run.steps(given.steps)


if __name__ == "__main__":
    main()
