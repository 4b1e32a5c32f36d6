"""The stored workflow from a CSV file to graded anomalies."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import numpy as np
import pytest

from loadcast.plans import Run
from loadcast.schema import SeriesColumns
from loadcast.session import owned_staging, stage
from loadcast.sources import load_model

SMALL = {"numTrees": 3, "maxDepth": 4, "maxBins": 32}
BOOST = {"maxIter": 2, "maxDepth": 3, "maxBins": 32}


def record(path: Path) -> dict:
    (part,) = [p for p in path.glob("part-*") if p.stat().st_size]
    return json.loads(part.read_text())


def test_all_steps(spark, tmp_path):
    hours = np.arange(720)
    load = 1000 + 200 * np.sin(hours / 24 * 2 * np.pi) + np.random.default_rng(0).normal(0, 40, 720)
    lines = ["Datetime,Load_MW"]
    lines += [f"{dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h))},{v:.3f}" for h, v in zip(hours, load)]
    source = tmp_path / "demand.csv"
    source.write_text("\n".join(lines))
    cols = SeriesColumns(time="Datetime", target="Load_MW")
    out = tmp_path / "out"
    run = Run(spark, str(source), str(out), cols, forest=SMALL, boosting=BOOST, parallelism=2)

    with pytest.raises(FileNotFoundError, match="Model file not found"):
        run.compare()
    run.steps(["train", "compare", "backtest", "select"])
    chosen = record(out / "metrics" / "model_selection")
    assert chosen["selected_model"] in ("Random Forest", "HistGradientBoosting")
    assert record(out / "metrics" / "training_metadata")["train_rows"] == 370
    if chosen["selected_model"] != "Random Forest":
        # The final step is written for the forest, like the frozen protocol.
        with pytest.raises(ValueError, match="expected Random Forest"):
            run.final()
        chosen["selected_model"] = "Random Forest"
        (part,) = [p for p in (out / "metrics" / "model_selection").glob("part-*") if p.stat().st_size]
        part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
        part.write_text(json.dumps(chosen))
    run.steps(["final", "detect", "analyze"])

    final = record(out / "metrics" / "final_test_metrics")
    assert (final["development_rows"], final["test_rows"], final["test_set_evaluated"]) == (449, 80, True)
    summary = record(out / "metrics" / "anomaly_summary")
    assert summary["total_scored_rows"] == 80 and summary["threshold_fit_on_final_test"] is False
    files = sorted((out / "predictions" / "final_test").glob("*.csv"))
    assert files[0].read_text().startswith("series_id,Datetime,Load_MW,prediction,residual,absolute_error")
    assert record(out / "metrics" / "validation_diagnostics")["validation_rows"] == 79
    load_model(spark, str(out / "models" / "final"))


def test_staged_tables_go_with_their_owner(spark):
    with owned_staging(spark) as folder:
        assert stage(spark.range(3), "three").count() == 3
        assert len(list(Path(folder).iterdir())) == 1
    assert not Path(folder).exists()
    assert stage(spark.range(2), "two").count() == 2
