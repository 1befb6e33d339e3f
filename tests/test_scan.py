"""Ordered scans: chunked and plain windows both equal a pandas brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelife.operators import scan
from devicelife.operators import timeseries as ts_ops
from devicelife.series import Series, with_chunks


def make_frame(seed=7, n=400):
    rng = np.random.default_rng(seed)
    key = rng.choice([1, 2, 3], size=n, p=[0.7, 0.2, 0.1])          # key 1 is hot
    secs = rng.integers(0, 20_000, size=n)                           # ties in time happen
    ts = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=int(s)) for s in secs]
    v = rng.normal(size=n).round(3)
    v[rng.random(n) < 0.3] = np.nan
    flag = (rng.random(n) < 0.15).astype(int)
    return pd.DataFrame({"k": key, "ts": ts, "tb": np.arange(n), "v": v, "flag": flag})


@pytest.fixture(scope="module")
def data(spark):
    pdf = make_frame()
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn(
        "v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    return pdf.sort_values(["k", "ts", "tb"]).reset_index(drop=True), df


def variants(df):
    s = Series.of("k", "ts", "tb")
    yield df, s
    for rows in (3, 17):
        yield with_chunks(df, s, rows)


def collect(df, cols):
    return df.select("tb", *cols).toPandas().set_index("tb").sort_index()


def expect(pdf):
    g = pdf.groupby("k", sort=False)
    out = pd.DataFrame(index=pdf["tb"])
    out["rs"] = g["flag"].cumsum().to_numpy()
    out["ff"] = g["v"].ffill().to_numpy()
    out["bf"] = g["v"].bfill().to_numpy()
    out["l1"] = g["v"].shift(1).to_numpy()
    out["l4"] = g["v"].shift(4).to_numpy()
    out["rn"] = (g.cumcount() + 1).to_numpy()
    return out.sort_index()


def close(a, b):
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    assert np.allclose(np.nan_to_num(a, nan=1e300), np.nan_to_num(b, nan=1e300))


def test_running_fills_lags_rownumber(data):
    pdf, df = data
    exp = expect(pdf)
    for d, s in variants(df):
        out = scan.running_sums(d, s, {"rs": F.col("flag")})
        out = scan.fill_forward(out, s, {"ff": F.col("v")})
        out = scan.fill_backward(out, s, {"bf": F.col("v")})
        out = scan.lags(out, s, {"l1": (F.col("v"), 1), "l4": (F.col("v"), 4)})
        out = scan.row_index(out, s, "rn")
        got = collect(out, ["rs", "ff", "bf", "l1", "l4", "rn"])
        for c in exp.columns:
            close(got[c], exp[c])


def test_next_times_and_lookahead(data):
    pdf, df = data
    # brute force: max flag over rows with ts in (t, t + 1h], per key
    exp = {}
    for _, grp in pdf.groupby("k"):
        t = grp["ts"].to_numpy()
        f = grp["flag"].to_numpy()
        for tb, ti in zip(grp["tb"], t):
            m = (t > ti) & (t <= ti + np.timedelta64(3600, "s"))
            exp[tb] = f[m].max() if m.any() else np.nan
    exp = pd.Series(exp).sort_index()
    for d, s in variants(df):
        out = ts_ops.lookahead(d, s, F.col("flag") == 1, {"la": 3600})
        close(collect(out, ["la"])["la"], exp)


def test_interpolation_matches_pandas(data):
    pdf, df = data
    exp = pdf.groupby("k", sort=False)["v"].transform(
        lambda x: x.reset_index(drop=True).interpolate(limit_area="inside").to_numpy())
    exp = pd.Series(exp.to_numpy(), index=pdf["tb"]).sort_index()
    for d, s in variants(df):
        close(collect(ts_ops.interpolate_linear(d, s, ["v"]), ["v"])["v"], exp)


def test_session_ids_follow_rises(spark):
    # flag on the first row is not a rise; three sessions afterwards
    flags = [1, 1, 0, 1, 0, 0, 1, 1, 0, 1]
    rows = [(1, dt.datetime(2024, 1, 1, 0, 5 * i), i, f) for i, f in enumerate(flags)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, tb long, flag int")
    s = Series.of("k", "ts", "tb")
    for d, ss in [(df, s), with_chunks(df, s, 2)]:
        got = [r["g"] for r in ts_ops.session_id(d, ss, "flag", "g").orderBy("tb").collect()]
        assert got == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]


def dirty_frame():
    """One 1970 date, a burst on one timestamp, null times, ordinary readings; all in one series."""
    pdf = make_frame(seed=11, n=600)
    pdf["k"] = 1
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    pdf.loc[0, "ts"] = pd.Timestamp("1970-01-01")
    pdf.loc[100:299, "ts"] = pd.Timestamp("2024-01-01 02:00:00")
    pdf.loc[300:379, "ts"] = pd.NaT
    return pdf


def test_chunks_hold_bounded_rows_on_dirty_times(spark):
    pdf = dirty_frame()
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    rows = [(k, t.to_pydatetime() if t is not None else None, tb, v, f) for k, t, tb, v, f in rows]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, tb long, v double, flag int")
    pdf = pdf.sort_values(["k", "ts", "tb"], na_position="first").reset_index(drop=True)
    exp = expect(pdf)
    plain = collect(ts_ops.lookahead(df, Series.of("k", "ts", "tb"), F.col("flag") == 1, {"la": 3600}), ["la"])["la"]
    for keys in ("k", ()):
        d, s = with_chunks(df, Series.of(keys, "ts", "tb"), 10)
        sizes = [r["count"] for r in d.groupBy(s.chunk).count().collect()]
        assert sum(sizes) == 600 and max(sizes) <= 40
        out = scan.running_sums(d, s, {"rs": F.col("flag")})
        out = scan.fill_forward(out, s, {"ff": F.col("v")})
        out = scan.fill_backward(out, s, {"bf": F.col("v")})
        out = scan.lags(out, s, {"l1": (F.col("v"), 1), "l4": (F.col("v"), 4)})
        out = scan.row_index(out, s, "rn")
        got = collect(out, list(exp.columns))
        for c in exp.columns:
            close(got[c], exp[c])
        close(collect(ts_ops.lookahead(d, s, F.col("flag") == 1, {"la": 3600}), ["la"])["la"], plain)


def test_equal_times_are_cut_by_text_ties(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
                                 F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("tb"))
    d, s = with_chunks(df, Series.of("k", "ts", "tb"), 10)
    per = d.groupBy(s.chunk).agg(F.count("*").alias("n"), F.min("tb").alias("a"), F.max("tb").alias("z")).orderBy(s.chunk).collect()
    assert max(r["n"] for r in per) <= 40
    assert all(x["z"] < y["a"] for x, y in zip(per, per[1:]))


def test_chunks_split_a_hot_series(spark, data):
    _, df = data
    d, s = with_chunks(df, Series.of("k", "ts", "tb"), 10)
    per = d.groupBy("k").agg(F.countDistinct(s.chunk).alias("n")).collect()
    assert max(r["n"] for r in per) > 10
