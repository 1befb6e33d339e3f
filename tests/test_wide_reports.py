"""Correlations of many columns, header agreement over files, text order columns, sums and censoring."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from devicelife.operators import metrics, resample
from devicelife.operators import timeseries as ts_ops
from devicelife.plans import prep
from devicelife.series import Series, with_chunks
from devicelife.sources import report as rp


def test_three_hundred_columns_equal_duckdb(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 300)) + 1e6
    base[:, 1] = base[:, 0] * 2 + rng.normal(size=400)
    base[rng.random(base.shape) < 0.05] = np.nan
    pdf = pd.DataFrame(base, columns=[f"c{i}" for i in range(300)])
    nulls = {c: [None if math.isnan(v) else float(v) for v in pdf[c]] for c in pdf}
    rows = list(zip(*nulls.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf)).repartition(5)
    got = {(r[0], r[1]): r[2] for r in metrics.correlation_pairs(df, list(pdf)).collect()}
    assert len(got) == 300 * 299
    t = pd.DataFrame(nulls)  # noqa: F841
    some = [(0, 1), (0, 299), (63, 64), (7, 130), (250, 251)]
    want = duckdb.sql("SELECT " + ", ".join(f"abs(corr(c{a}, c{b}))" for a, b in some) +
                      " FROM (SELECT " + ", ".join(f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS {c}" for c in pdf) + " FROM t)").fetchall()[0]
    for (a, b), w in zip(some, want):
        assert abs(got[f"c{a}", f"c{b}"] - w) < 1e-8 and got[f"c{a}", f"c{b}"] == got[f"c{b}", f"c{a}"]


def test_nulls_constants_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, 1.0), (3.0, 6.5, 5.0, 4.0)], "a double, b double, k double, n double")
    skip = {(r[0], r[1]): r[2] for r in metrics.correlation_pairs(df, ["a", "b", "k", "n"]).collect()}
    nan = {(r[0], r[1]): r[2] for r in metrics.correlation_pairs(df, ["a", "b", "k", "n"], nulls="nan").collect()}
    assert skip["a", "b"] == nan["a", "b"] and skip["a", "b"] > 0.99 and abs(skip["a", "n"] - 1) < 1e-12
    assert skip["a", "k"] is None and math.isnan(nan["a", "k"]) and math.isnan(nan["n", "a"])
    empty = {(r[0], r[1]): r[2] for r in metrics.correlation_pairs(df.where("a > 9"), ["a", "b"]).collect()}
    assert empty == {("a", "b"): None, ("b", "a"): None}
    wide = {r["Feature"]: r for r in metrics.correlation_matrix(df, ["a", "b"]).collect()}
    assert wide["a"]["a"] == 1.0 and wide["a"]["b"] == skip["a", "b"]
    with pytest.raises(ValueError):
        metrics.correlation_pairs(df, ["a", "b"], nulls="zero")


def _headers(spark, n_files, odd=None):
    cells = [F.lit(None).cast("string").alias(c) for c in rp.CELLS[3:]]
    third = F.when(F.col("id") == odd, F.lit("Other")).otherwise(F.lit("Time")) if odd is not None else F.lit("Time")
    return spark.range(n_files).select(
        F.format_string("f%06d.csv", "id").alias("_file"), F.lit(1).cast("long").alias("section_id"), F.lit(True).alias("_is_header"),
        F.lit("Index").alias(rp.CELLS[0]), F.lit("Date").alias(rp.CELLS[1]), third.alias(rp.CELLS[2]), *cells)


def test_header_agreement_over_ten_thousand_files(spark):
    agreed = rp.header_agreement(_headers(spark, 10_000))
    assert [(r["file"], r["n_files"], r["other_file"]) for r in agreed.collect()] == [("f000000.csv", 10_000, None)]
    assert rp.header_names(_headers(spark, 50)) == {1: [(0, "Index"), (1, "Date"), (2, "Time")]}
    with pytest.raises(ValueError, match="f000041.csv"):
        rp.header_names(_headers(spark, 10_000, odd=41))


def test_text_order_with_a_long_common_prefix_is_cut(spark):
    df = spark.range(600).select(F.lit("a").alias("k"), F.lit(1).alias("t"), F.format_string("device-reading-%05d", "id").alias("name"), "id")
    out, s = with_chunks(df, Series.of("k", "t", "name"), 20)
    rows = out.select("id", F.col(s.chunk).alias("c")).collect()
    sizes = pd.Series([tuple(r["c"]) for r in rows]).value_counts()
    assert len(sizes) >= 8 and sizes.max() <= 80
    chunks = [tuple(r["c"]) for r in sorted(rows, key=lambda r: r["id"])]
    assert chunks == sorted(chunks)


def test_sum_once_in_the_preparation(spark):
    rows = [("2024-01-01 00:00:01", 5.0, None), ("2024-01-01 00:01:00", None, "a"), ("2024-01-01 00:02:00", None, "b"),
            ("2024-01-01 00:01:00", None, "a"), ("2024-01-01 00:05:00", 2.0, "a"), ("2024-01-01 00:06:00", 3.0, "b")]
    df = spark.createDataFrame(rows, "t string, dose double, other string").select(F.col("t").cast("timestamp_ntz").alias("Datetime"), "dose", "other")
    totals = {}
    for once in (False, True):
        cfg = prep.PrepConfig(sums=["dose"], categories=[], means=[], clip_k=100.0, sum_once=once)
        flat, _ = prep.clean(df, cfg)
        totals[once] = {(r["Datetime"].minute, r["other"]): r["dose"] for r in flat.collect()}
    # a dose of 5 reaches each of the bucket's three rows (null, a, b) unless it counts once
    assert {v for (m, _), v in totals[False].items() if m == 0} == {15.0}
    assert {v for (m, _), v in totals[True].items() if m == 0} == {5.0}
    assert {v for (m, _), v in totals[True].items() if m == 5} == {5.0}


def test_bucket_conflicts_name_their_columns(spark):
    df = spark.createDataFrame([(1, "a", 1, None), (1, "a", 2, None), (2, "a", 1, 1), (2, "b", 1, None), (3, "a", 1, 1), (3, "a", 1, 1)],
                               "bucket int, x string, y int, z int")
    found = resample.bucket_conflicts(df, [], "bucket")
    assert {(r["bucket"], r["n_rows"], tuple(r["columns"])) for r in found.collect()} == {(1, 2, ("y",)), (2, 2, ("x", "z"))}
    assert {tuple(r) for r in resample.conflict_columns(found).collect()} == {("y", 1, 1), ("x", 1, 0), ("z", 1, 0)}


def test_censoring_against_a_loop(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), int(t), int(i), bool(rng.random() < 0.1)) for i, (k, t) in enumerate(zip(rng.integers(0, 3, 300), np.cumsum(rng.choice([0, 60, 300, 2000], 300))))]
    df = spark.createDataFrame(rows, "k long, sec long, id long, f boolean").withColumn("ts", F.timestamp_seconds("sec"))
    want = {}
    for k, t, i, f in rows:
        mine = sorted({x for kk, x, _, _ in rows if kk == k and x >= t})
        reach = t
        for x in mine:
            if x - reach > 900:
                break
            reach = x
        hit = any(kk == k and t < x <= t + 1800 and ff for kk, x, _, ff in rows)
        want[i] = not (f or hit or reach >= t + 1800)
    assert 0 < sum(want.values()) < 300
    for rows_per_chunk in (None, 7):
        s = Series.of("k", "ts", "id")
        part, s = with_chunks(df, s, rows_per_chunk) if rows_per_chunk else (df, s)
        got = {r["id"]: r["y_is_censored"] for r in ts_ops.censoring(part, s, F.col("f"), {"y": 1800}, 900).collect()}
        assert got == want


def test_jitter_depends_on_keys_and_seed_only(spark):
    df = spark.createDataFrame([(k, i + 1, float(i * k)) for k in range(1, 6) for i in range(12)], "k long, rn long, v double")
    s = Series.of("k", "rn")
    runs = [{r["k"]: r["v"] for r in ts_ops.seed_slopes(df.repartition(n), s, ["v"], jitter=(0.5, 1.5), seed=seed).collect()}
            for n, seed in ((1, 7), (9, 7), (4, 8))]
    assert runs[0] == runs[1] != runs[2]
