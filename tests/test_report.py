"""Report ingest (S1-S13) and the preparation plan on written report files."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelife.plans import prep
from devicelife.sources import report as rp
from report_fixture import write_reports


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    return write_reports(str(tmp_path_factory.mktemp("reports")))


@pytest.fixture(scope="module")
def rep(spark, paths):
    return rp.read_report(spark, paths, device_key="Serial Number")


def test_sections_and_columns(rep):
    assert len(rep.tables) == 3
    pump, _, sensor = rep.tables
    assert pump.columns[:4] == ["device", "Index", "Date", "Time"]
    assert "Sensor Glucose (mg/dL)" in sensor.columns


def test_overlapping_exports_dedup(rep):
    counts = {r["device"]: r["count"] for r in rep.table(2).groupBy("device").count().collect()}
    assert counts == {"NG-A": 864, "NG-B": 864}


def test_metadata(rep):
    meta = {r["key"]: r["value"] for r in rep.file_meta.collect()}
    assert meta["Serial Number"] == "NG-A;NG-B"
    assert meta["Last Name"] == "Doe"
    assert meta["Firmware"] == "1.2"
    titles = {r["section_id"]: r["meta"] for r in rep.table_meta.collect()}
    assert titles[1] == ["MiniMed", "Pump"] and titles[3] == ["Guardian", "Sensor"]
    cat = rp.describe_report(rep)
    assert cat.where(F.col("table_index") == 2).count() == len(rep.table(2).columns)


def test_unchunked_rows_agree(spark, paths):
    a = rp.read_report(spark, paths, device_key="Serial Number", chunked=False).table(2)
    b = rp.read_report(spark, paths, device_key="Serial Number", chunked=True).table(2)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _prepared(rep, rows_per_chunk):
    cfg = prep.PrepConfig(keys=("device",), rows_per_chunk=rows_per_chunk)
    return prep.prepare_report(rep, cfg).toPandas().sort_values(["device", "Datetime"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def prepared(rep):
    return _prepared(rep, None)


def test_prepared_grid_and_columns(prepared):
    p = prepared
    assert len(p) > 0
    assert (p["Datetime"].dt.second == 0).all() and (p["Datetime"].dt.minute % 5 == 0).all()
    for c in ["GISIG_Ratio", "Sensor Glucose (mg/dL)_15m_delta", "Start_Time_Delta", "sensor_end_1h",
              "sensor_end_2h", "Hour", "Minute", "Month", "Sensor Exception_SENSOR_INIT_CODE"]:
        assert c in p.columns, c
    assert (p["Start_Time_Delta"].dropna() >= 0).all()


def test_labels_match_brute_force(prepared):
    p = prepared
    end = ((p["Sensor Exception_SENSOR_CHANGE_SENSOR_ERROR"] == 1) |
           (p["Sensor Exception_SENSOR_END_OF_LIFE"] == 1)).to_numpy()
    for dev, g in p.groupby("device"):
        idx = g.index.to_numpy()
        t = g["Datetime"].to_numpy()
        e = end[idx]
        exp = []
        for i, ti in enumerate(t):
            m = (t > ti) & (t <= ti + np.timedelta64(3600, "s"))
            v = (1 if e[m].any() else 0) if m.any() else np.nan
            exp.append(0 if e[i] else v)
        exp = pd.Series(exp).ffill().to_numpy()
        got = g["sensor_end_1h"].to_numpy(dtype=float)
        assert np.array_equal(np.nan_to_num(got, nan=-1), np.nan_to_num(exp, nan=-1)), dev


def test_chunked_prep_equals_unchunked(rep, prepared):
    small = _prepared(rep, 40)
    pd.testing.assert_frame_equal(prepared, small[prepared.columns], check_dtype=False)
