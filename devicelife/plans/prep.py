"""Preparation plan: readings -> 5-minute feature rows with failure labels.

One lazy Spark plan per call, run for every device at once:

1. outlier clip of the timestamps (mean +- 3 sample std, per device);
2. 5-minute buckets, per-bucket harmonisation, one-hot categories,
   flattening (flags max, doses summed, other columns kept) + calendar;
3. back-cast seed rows ahead of each device's first readings, linear
   interpolation, glucose/ISIG ratio, 15/30/60-minute deltas, seed removal;
4. sensor sessions from the start flag, imputed start of the first one,
   minutes since session start;
5. "sensor ends within 1 h / 2 h" labels, zeroed on end rows and carried
   forward over gaps.

The only actions are the optional ones that fix the output schema (category
values when not given). Series order is ``(device, Datetime, row hash)``:
the hash breaks ties between rows of one bucket deterministically.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelife.functions import time as tf
from devicelife.functions import values as vf
from devicelife.operators import filters, quality, resample
from devicelife.operators import timeseries as ts_ops
from devicelife.series import Series, with_chunks
from devicelife.session import cut_lineage
from devicelife.sources.report import Report

# Fixed values from the device report format: table positions, filters,
# column groups and flag names.
PUMP_TABLE, SENSOR_TABLE = 0, 2
ALERT_COLS = ["Alert", "User Cleared Alerts"]
DAY_MARKERS = ["Start of the day", "End of the day"]
GLUCOSE, ISIG = "Sensor Glucose (mg/dL)", "ISIG Value"
RATIO = "GISIG_Ratio"
CATEGORY_COLS = [
    "Sensor Exception", "BG Source", "Basal Rate (U/h)", "Prime Type", "SmartGuard Correction Bolus Feature",
    "Suspend", "Rewind", "BWZ Status", "Bolus Cancellation Reason", "Sensor Calibration Rejected Reason",
    "Bolus Source",
]
SUM_COLS = [
    "Bolus Volume Selected (U)", "Bolus Volume Delivered (U)", "BWZ Estimate (U)", "BWZ Carb Input (grams)",
    "BWZ Correction Estimate (U)", "BWZ Food Estimate (U)", "Final Bolus Estimate",
]
MEAN_COLS = [
    "BWZ BG/SG Input (mg/dL)", "BWZ Active Insulin (U)", "Sensor Calibration BG (mg/dL)",
    "BWZ Unabsorbed Insulin Total (U)",
]
DROP_COLS = [
    "Date", "Time", "Prime Volume Delivered (U)", "Estimated Reservoir Volume after Fill (U)", "Bolus Type",
    "BWZ Target High BG (mg/dL)", "BWZ Target Low BG (mg/dL)", "BWZ Carb Ratio (g/U)",
    "BWZ Insulin Sensitivity (mg/dL/U)", "Bolus Number", "Scroll Step Size", "BLE Network Device",
    "BG Reading (mg/dL)", "BWZ BG/SG Input (mg/dL)", "BWZ Active Insulin (U)", "Sensor Calibration BG (mg/dL)",
    "BWZ Unabsorbed Insulin Total (U)", "New Device Time", "Insulin Action Curve Time",
]
START_FLAG = "Sensor Exception_SENSOR_INIT_CODE"
END_FLAGS = ["Sensor Exception_SENSOR_CHANGE_SENSOR_ERROR", "Sensor Exception_SENSOR_END_OF_LIFE"]
HORIZONS = {"sensor_end_1h": 3600, "sensor_end_2h": 7200}


@dataclass
class PrepConfig:
    keys: tuple[str, ...] = ()
    ts: str = "Datetime"
    measures: tuple[str, str] = (GLUCOSE, ISIG)
    ratio: str = RATIO
    categories: list[str] = field(default_factory=lambda: list(CATEGORY_COLS))
    category_values: dict | None = None
    sums: list[str] = field(default_factory=lambda: list(SUM_COLS))
    means: list[str] = field(default_factory=lambda: list(MEAN_COLS))
    start_flag: str = START_FLAG
    end_flags: list[str] = field(default_factory=lambda: list(END_FLAGS))
    horizons: dict = field(default_factory=lambda: dict(HORIZONS))
    bucket_seconds: int = 300
    clip_k: float = 3.0
    seed_rows: int = 12
    seed_offset_minutes: int = 60
    jitter: tuple[float, float] = (1.0, 1.0)
    lag_steps: tuple[int, ...] = (3, 6, 12)
    rows_per_chunk: int | None = None
    drop_seed_by_flag: bool = False
    sum_once: bool = False         # count each distinct source row once in the sums of a bucket
    censor_gap: int | None = None  # seconds; adds <label>_is_censored, see timeseries.censoring
    materialize: bool = True       # checkpoint between chunked stages


# ----------------------------------------------------------------------------
# joining the report tables


def readings_from_report(report: Report, keys=(), parse_keys_first: bool = False) -> DataFrame:
    """Sensor and pump tables, filtered, pruned and full-joined on the
    reading time (the first step of the source's preparation).

    ``keys`` are extra series columns present in both tables (a device id).
    ``parse_keys_first`` joins on parsed dates, so ``11/01/2024`` meets
    ``2024/11/01``; by default the raw date text is the key, as in the source.
    """
    pump = filters.where_all_null(report.table(PUMP_TABLE), [c for c in ALERT_COLS
                                                              if c in report.table(PUMP_TABLE).columns])
    pump = filters.drop_null_columns(pump)
    sensor = report.table(SENSOR_TABLE)
    if "Event Marker" in sensor.columns:
        sensor = filters.where_not_in_or_null(sensor, "Event Marker", DAY_MARKERS)
    sensor = filters.drop_null_columns(sensor)
    return join_readings(sensor, pump, keys, parse_keys_first)


def join_readings(sensor: DataFrame, pump: DataFrame, keys=(), parse_keys_first: bool = False) -> DataFrame:
    from devicelife.operators.joins import full_join_suffix
    on = [*keys, "Date", "Time"]
    if parse_keys_first:
        sensor = sensor.withColumn("Date", tf.parse_date_any("Date").cast("string"))
        pump = pump.withColumn("Date", tf.parse_date_any("Date").cast("string"))
    joined = full_join_suffix(sensor, pump, on, "_2")
    return filters.drop_strict(joined, ["Index", "Index_2"])


def typed_readings(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Blank cells to null, strict casts, ``Datetime`` from date and time text,
    then the unneeded columns dropped."""
    df = filters.blank_to_null(df)
    g, i = cfg.measures
    cols = []
    for c in df.columns:
        if c == g:
            cols.append(vf.cast_strict(c, "int", 0, 65535).cast("double").alias(c))
        elif c == i:
            cols.append(vf.cast_strict(c, "double").alias(c))
        else:
            cols.append(F.col(c))
    df = df.select(*cols)
    df = df.withColumn("Date", tf.parse_date_any("Date"))
    df = df.withColumn(cfg.ts, tf.combine_date_time("Date", "Time"))
    return filters.drop_lenient(df, DROP_COLS)


# ----------------------------------------------------------------------------
# clean + features + labels


def clean(df: DataFrame, cfg: PrepConfig) -> tuple[DataFrame, list[str]]:
    """Outlier clip, buckets, harmonise, one-hot, flatten (returns the flag names)."""
    keys = list(cfg.keys)
    df = quality.sigma_clip(df, cfg.ts, cfg.clip_k, keys)
    once = [c for c in cfg.sums if c in df.columns] if cfg.sum_once else []
    if once:
        df = df.distinct()
    df = resample.add_bucket(df, cfg.ts, cfg.bucket_seconds)
    df = resample.harmonise(df, keys, cfg.ts, once=once)
    cats = [c for c in cfg.categories if c in df.columns]
    df, flags = resample.one_hot(df, cats, cfg.category_values)
    sums = [c for c in cfg.sums if c in df.columns and c not in once]
    means = [c for c in cfg.means if c in df.columns]
    df = resample.flatten_buckets(df, keys, cfg.ts, resample.FlattenSpec(flags=flags, sums=sums, means=means, once=once))
    return df, flags


def engineer(flat: DataFrame, cfg: PrepConfig, flags: list[str]) -> DataFrame:
    """Seed rows, interpolation, ratio, deltas, sessions, labels.

    Each chunked scan joins a per-chunk summary of its own input, so a chain
    of them references its input plan twice per step. The chain is cut into
    stages by reliable checkpoints (shared ``spark.checkpoint.dir``), which
    keeps the plan linear and lets a lost executor resume from the last
    stage instead of from the raw scan. When no series needs cutting, the
    scans are plain windows by series that read their input once, share one
    shuffle and are not cut; only what a step reads twice is.
    """
    keys = list(cfg.keys)
    g, i = cfg.measures
    cut = cut_lineage if cfg.materialize else (lambda d: d)
    flat = flat.withColumn("_tb", F.xxhash64(*[F.col(c) for c in flat.columns]))
    flat = cut(flat)
    s0 = Series(tuple(keys), cfg.ts, ("_tb",))
    flat_c, s = with_chunks(flat, s0, cfg.rows_per_chunk)
    seeds = cut(ts_ops.backcast_seed(flat_c, s, g, [g, i], cfg.seed_rows, cfg.seed_offset_minutes, cfg.jitter))
    # seed rows sort before real rows of the same time (null tie-break)
    both = ts_ops.union_seed(flat, seeds.withColumn("_tb", F.lit(None).cast("long")))
    between = (lambda d: d)
    if s.chunk:                    # else no series is long, and a series has few seed rows
        both, s = with_chunks(both, s0, cfg.rows_per_chunk)
        between = cut
    both = between(both)

    both = between(ts_ops.interpolate_linear(both, s, [g, i]))
    both = both.withColumn(cfg.ratio, vf.safe_ratio(g, i))
    both = ts_ops.lag_deltas(both, s, [g, i, cfg.ratio], cfg.lag_steps)
    feats = between(ts_ops.drop_seed(both, seeds, s, by_flag=cfg.drop_seed_by_flag))

    start = cfg.start_flag
    if start not in feats.columns:
        feats = feats.withColumn(start, F.lit(0))
    feats = ts_ops.session_id(feats, s, start, "group")
    if not s.chunk:
        feats = cut(feats)         # the starts of the sessions are read from it too
    feats = between(ts_ops.session_age(feats, s.unchunked(), "group").drop("group"))

    ends = [c for c in cfg.end_flags if c in feats.columns]
    end = vf.any_flag(ends) if ends else F.lit(False)
    feats = feats.withColumn("_end", F.coalesce(end, F.lit(False)))
    if cfg.censor_gap is not None:
        feats = cut(ts_ops.censoring(feats, s, F.col("_end"), cfg.horizons, cfg.censor_gap))
    feats = ts_ops.lookahead(feats, s, F.col("_end"), cfg.horizons)
    feats = ts_ops.finish_labels(feats, s, list(cfg.horizons), F.col("_end"))
    return feats.drop("_end", "_tb", *s.helper_cols())


def prepare(readings: DataFrame, cfg: PrepConfig | None = None, typed: bool = False) -> DataFrame:
    """Typed readings (or raw joined text when ``typed`` is False) to features."""
    cfg = cfg or PrepConfig()
    if not typed:
        readings = typed_readings(readings, cfg)
    flat, flags = clean(readings, cfg)
    return engineer(flat, cfg, flags)


def prepare_report(report: Report, cfg: PrepConfig | None = None, parse_keys_first: bool = False) -> DataFrame:
    cfg = cfg or PrepConfig()
    return prepare(readings_from_report(report, cfg.keys, parse_keys_first), cfg)
