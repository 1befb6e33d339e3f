"""From report files to scores, and a run that dies midway."""

import pytest

from devicelife.operators import model
from devicelife.plans import pipeline, prep, training
from report_fixture import write_reports


def config():
    return pipeline.PipelineConfig(train=training.TrainConfig(
        keys=("device",), base=model.ModelParams(maxIter=5, maxDepth=3), grid={"stepSize": [0.1, 0.3], "maxDepth": [2]}))


def test_files_to_scores_and_resume(spark, tmp_path, monkeypatch):
    paths = write_reports(str(tmp_path))
    out = str(tmp_path / "out")
    calls = []
    real_prep, real_fit = prep.prepare_report, training.run_training
    monkeypatch.setattr(prep, "prepare_report", lambda *a, **k: calls.append("features") or real_prep(*a, **k))
    monkeypatch.setattr(training, "run_training", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        pipeline.run_pipeline(spark, paths, out, config())
    monkeypatch.setattr(training, "run_training", lambda *a, **k: calls.append("model") or real_fit(*a, **k))
    scores = pipeline.run_pipeline(spark, paths, out, config())
    assert calls == ["features", "model"]              # the finished stage was not run again
    rows = scores.toPandas()
    assert len(rows) > 500 and rows["p_end"].between(0, 1).all() and set(rows["device"]) == {"NG-A", "NG-B"}
    assert (rows["prediction_t"] == (rows["p_end"] > 0.005)).all()
    assert rows.loc[rows.Sensor_End == 1, "p_end"].mean() > rows.loc[rows.Sensor_End == 0, "p_end"].mean()
    # nothing changed: nothing runs; a changed setting redoes only what depends on it
    assert pipeline.run_pipeline(spark, paths, out, config()).count() == len(rows) and calls == ["features", "model"]
    other = config()
    other.train.threshold = 0.5
    again = pipeline.run_pipeline(spark, paths, out, other).toPandas()
    assert calls == ["features", "model", "model"] and (again["prediction_t"] == (again["p_end"] > 0.5)).all()
