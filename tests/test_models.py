"""Model half, session set-up and the report's width guard."""

from dataclasses import replace
from types import SimpleNamespace

import pytest

import __spark_entry__ as E
from devicelife import session
from devicelife.operators import boosting, model
from devicelife.sources import report
from small_tables import SF_SMALL


def test_a_configured_master_is_kept(spark):
    assert session.configured_master() == spark.sparkContext.master
    assert session.get_session().sparkContext.master == spark.sparkContext.master


def test_a_cluster_needs_a_shared_checkpoint_folder():
    context = SimpleNamespace(master="yarn", getConf=lambda: SimpleNamespace(get=lambda *a: None))
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(cluster)


def test_defaults():
    assert model.ModelParams().maxIter == 1000 and model.ModelParams().l1 == 0.25 and len(model.grid_points()) == 12
    with pytest.raises(ValueError, match="depth -1"):
        model.ModelParams(maxDepth=-1).boost()


def few_rounds(monkeypatch):
    """Fits of three rounds; returns the parameters that were asked for."""
    asked, real = [], boosting.fit_models
    def fit(df, features, label, jobs, *a, **k):
        asked.append([j["params"] for j in jobs])
        return real(df, features, label, [j | {"params": replace(j["params"], rounds=3)} for j in jobs], *a, **k)
    monkeypatch.setattr(boosting, "fit_models", fit)
    return asked


def test_registered_queries_ask_for_the_sources_rounds_and_grid(spark, monkeypatch):
    asked = few_rounds(monkeypatch)
    rows = E.queries()["search"](spark, SF_SMALL).collect()
    base, points = asked
    assert len(rows) == 24 and len({r.point for r in rows}) == 12
    assert base == [model.ModelParams().boost()] * 2 and len(points) == 24
    assert {p.rounds for p in points} == {1000} and {p.l1 for p in points} == {0.25}
    assert {(p.step, p.depth) for p in points} == {(0.01, 10), (0.01, 15), (0.1, 10), (0.1, 15)}
    assert {p.pos_weight for p in points} == {0.75, 1.0, 1.25}


def test_bundle_query_scores_alike_after_loading(spark, monkeypatch):
    few_rounds(monkeypatch)
    got = E.queries()["bundle_roundtrip"](spark, SF_SMALL).collect()
    assert got and all(r.same for r in got)


def test_a_row_with_too_many_cells_fails(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("a," * 54 + "z\n")
    with pytest.raises(Exception, match="more than 54 cells"):
        report.read_report_rows(spark, str(tmp_path / "wide.csv")).collect()
    (tmp_path / "fits.csv").write_text("a," * 53 + "z\n")
    assert report.read_report_rows(spark, str(tmp_path / "fits.csv")).first()["column_54"] == "z"
