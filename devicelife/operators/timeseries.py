"""Time-series features and labels (T1-T14), built on the ordered scans.

All operators work per series (``Series.keys``) and accept a chunked
series, in which case no task ever holds more than one chunk of a series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicelife.functions.time import epoch_micros, minutes_between
from devicelife.operators import scan
from devicelife.series import Series, attach_aggregates, null_safe_join

STEP_MINUTES = 5


# --------------------------------------------------------------------------
# seed rows


def first_k_non_null(df: DataFrame, s: Series, value: str, k: int = 12, rn: str = "rn") -> DataFrame:
    """The first ``k`` rows of each series where ``value`` is not null."""
    base = df.where(F.col(value).isNotNull())
    return scan.row_index(base, s, rn).where(F.col(rn) <= k)


def _unit_hash(keys, seed: int) -> Column:
    """A number in [0, 1) from the 53 lower bits of a hash of the keys (null keys included) and the seed."""
    parts = [x for k in keys for x in (F.isnull(F.col(k)), F.col(k))]
    return F.pmod(F.xxhash64(F.lit(int(seed)), *parts), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def seed_slopes(first: DataFrame, s: Series, cols, k: int = 12, rn: str = "rn",
                jitter=(1.0, 1.0), seed: int = 0) -> DataFrame:
    """Per series: ``v0 + k * slope`` for each column, from the first rows.

    ``slope = mean over i in 0..5 of (v[i] - v[i+5]) / 6``: a five-step
    difference divided by six, kept as the source computes it. ``jitter``
    scales the slope by a uniform factor hashed from the series keys and the
    seed, the same in any partitioning and on any retry (the source's factor
    is unseeded, between 0.5 and 1.5); the default factor is exactly 1.
    """
    aggs = []
    for c in cols:
        aggs += [F.max(F.when(F.col(rn) == i + 1, F.col(c))).alias(f"_{c}_{i}") for i in range(k)]
    wide = first.groupBy(*s.keys).agg(*aggs)
    lo, hi = jitter
    factor = F.lit(float(lo)) if lo == hi else F.lit(float(lo)) + F.lit(float(hi - lo)) * _unit_hash(s.keys, seed)
    out = []
    for c in cols:
        v = [F.col(f"_{c}_{i}").cast("double") for i in range(k)]
        total = None
        for i in range(6):
            term = (v[i] - v[i + 5]) / F.lit(6.0)
            total = term if total is None else total + term
        slope = total / F.lit(6.0) * factor
        out.append((v[0] + F.lit(float(k)) * slope).alias(c))
    return wide.select(*s.keys, *out)


def backcast_seed(df: DataFrame, s: Series, value: str, cols, k: int = 12,
                  offset_minutes: int = 60, jitter=(1.0, 1.0), seed: int = 0) -> DataFrame:
    """Seed rows placed ``offset_minutes`` before each of the first ``k``
    non-null readings of every series.

    All seed values are null except on the earliest seed row, whose ``cols``
    hold the back-cast ``v0 + k * slope``. Columns: keys, ts, cols, is_seed.
    """
    first = first_k_non_null(df.select(*dict.fromkeys([*s.keys, *s.part_cols(), *s.order_cols(), *cols])),
                             s, value, k, "_srn")
    slopes = seed_slopes(first, s, cols, k, "_srn", jitter, seed)
    rows = attach_aggregates(first.select(*s.keys, s.ts, "_srn"), slopes, s.keys)
    ts_t = df.schema[s.ts].dataType.simpleString()
    shifted = (F.col(s.ts) - F.expr(f"INTERVAL {int(offset_minutes)} MINUTES")).cast(ts_t)
    return rows.select(*s.keys, shifted.alias(s.ts),
                       *[F.when(F.col("_srn") == 1, F.col(c)).alias(c) for c in cols],
                       F.lit(True).alias("is_seed"))


def union_seed(df: DataFrame, seeds: DataFrame) -> DataFrame:
    """Append seed rows; real rows get ``is_seed = false``."""
    return df.withColumn("is_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)


def drop_seed(df: DataFrame, seeds: DataFrame, s: Series, by_flag: bool = False) -> DataFrame:
    """Remove seed rows again.

    Default: anti-join on the seed timestamps (a real row that shares a seed's
    timestamp goes too, as in the source). ``by_flag`` removes only rows
    flagged ``is_seed``.
    """
    if by_flag:
        return df.where(~F.col("is_seed")).drop("is_seed")
    keys = [*s.keys, s.ts]
    out = null_safe_join(df, seeds.select(*keys).distinct().withColumn("_hit", F.lit(True)), keys, "left")
    return out.where(F.col("_hit").isNull() & F.col(s.ts).isNotNull()).drop("_hit", "is_seed")


# --------------------------------------------------------------------------
# interpolation, ratios, lags


def interpolate_linear(df: DataFrame, s: Series, cols) -> DataFrame:
    """Fill inner nulls linearly by row position; leading/trailing nulls stay.

    ``[null, 1, null, null, 4, null] -> [null, 1, 2, 3, 4, null]``.
    """
    out = scan.row_index(df, s, "_irn")
    rn = F.col("_irn")
    marks = {}
    for i, c in enumerate(cols):
        marks[f"_p{i}"] = F.when(F.col(c).isNotNull(), F.struct(rn.alias("r"), F.col(c).cast("double").alias("v")))
    out = scan.fill_forward(out, s, marks)
    out = scan.fill_backward(out, s, {f"_n{i}": e for i, e in enumerate(marks.values())})
    res = {}
    for i, c in enumerate(cols):
        p, n = F.col(f"_p{i}"), F.col(f"_n{i}")
        est = p["v"] + (rn - p["r"]) * (n["v"] - p["v"]) / (n["r"] - p["r"])
        res[c] = F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(
            p.isNotNull() & n.isNotNull(), est)
    out = out.select(*[res[c].alias(c) if c in res else F.col(c) for c in df.columns])
    return out


def forward_fill(df: DataFrame, s: Series, cols, default=None) -> DataFrame:
    """Carry the last non-null value forward; then fill what is left."""
    tmp = {f"_ff_{c}": F.col(c) for c in cols}
    out = scan.fill_forward(df, s, tmp)
    for c in cols:
        v = F.col(f"_ff_{c}")
        out = out.withColumn(c, v if default is None else F.coalesce(v, F.lit(default)))
    return out.drop(*tmp)


def lag_columns(df: DataFrame, s: Series, cols, steps=(3, 6, 12), step_minutes: int = STEP_MINUTES) -> DataFrame:
    """``<col>_<steps*step_minutes>m``: the value ``steps`` rows earlier."""
    return scan.lags(df, s, {f"{c}_{n * step_minutes}m": (F.col(c), n) for c in cols for n in steps})


def lag_deltas(df: DataFrame, s: Series, cols, steps=(3, 6, 12), step_minutes: int = STEP_MINUTES) -> DataFrame:
    """``<col>_<m>m_delta = col - lag(col, steps)``; the lag columns are not kept.

    Lags count rows, not minutes: the names assume a gap-free 5-minute grid.
    """
    out = lag_columns(df, s, cols, steps, step_minutes)
    names = [(c, f"{c}_{n * step_minutes}m") for c in cols for n in steps]
    out = out.select("*", *[(F.col(c) - F.col(lg)).alias(f"{lg}_delta") for c, lg in names])
    return out.drop(*[lg for _, lg in names])


def diff_cumsum(df: DataFrame, s: Series, col: str) -> DataFrame:
    """``<col>_diff = col - previous col`` and ``<col>_cumsum`` (running sum)."""
    out = scan.lags(df, s, {"_prev": (F.col(col), 1)})
    out = out.withColumn(f"{col}_diff", F.col(col) - F.col("_prev")).drop("_prev")
    return scan.running_sums(out, s, {f"{col}_cumsum": F.col(col)})


# --------------------------------------------------------------------------
# sessions (T8, T9)


def session_id(df: DataFrame, s: Series, flag: str, name: str = "group") -> DataFrame:
    """Number of 0-to-1 rises of ``flag`` so far in the series.

    Rows before the first rise are session 0; a flag already set on the first
    row is not a rise (it has no predecessor).
    """
    out = scan.lags(df, s, {"_pf": (F.col(flag), 1)})
    rise = F.when((F.col(flag) == 1) & (F.col("_pf") == 0), 1).otherwise(0).cast("long")
    out = scan.running_sums(out, s, {name: rise})
    return out.drop("_pf")


def session_starts(df: DataFrame, s: Series, group: str = "group", name: str = "Start_Time") -> DataFrame:
    return df.groupBy(*s.keys, group).agg(F.min(s.ts).alias(name))


def impute_first_start(starts: DataFrame, keys, group: str = "group", name: str = "Start_Time") -> DataFrame:
    """Session 0 is censored: its start becomes the earlier of its observed
    start and ``start of session 1 - mean gap between session starts``.
    Without a session 1 the observed start is kept.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    us = epoch_micros(name)
    per_key = starts.groupBy(*keys).agg(
        F.max(F.when(F.col(group) == 1, us)).alias("_s1"),
        F.try_divide((F.max(us) - F.min(us)).cast("double"), (F.count(us) - 1).cast("double")).alias("_gap"))
    t = starts.schema[name].dataType.simpleString()
    guess = F.timestamp_micros((F.col("_s1") - F.col("_gap")).cast("long")).cast(t)
    out = attach_aggregates(starts, per_key, keys)
    imputed = F.when((F.col(group) == 0) & guess.isNotNull(), F.least(F.col(name), guess)).otherwise(F.col(name))
    return out.select(*[imputed.alias(name) if c == name else F.col(c) for c in starts.columns])


def session_age(df: DataFrame, s: Series, group: str = "group", starts: DataFrame | None = None,
                name: str = "Start_Time_Delta", impute: bool = True) -> DataFrame:
    """Whole minutes since the start of the row's session."""
    if starts is None:
        starts = session_starts(df, s, group)
        if impute:
            starts = impute_first_start(starts, s.keys, group)
    out = null_safe_join(df, starts.select(*s.keys, group, "Start_Time"), [*s.keys, group], "left")
    return out.withColumn(name, minutes_between(s.ts, "Start_Time")).drop("Start_Time")


# --------------------------------------------------------------------------
# labels (T10, T11, T14)


def lookahead(df: DataFrame, s: Series, flag: Column, horizons: dict[str, int]) -> DataFrame:
    """``name -> seconds``: the max of ``flag`` (a boolean) over the rows whose
    time lies in ``(t, t + seconds]``, as 0/1; null when no row lies there.

    It reduces to two next-event times per row (next flagged row, next row of
    any kind), so the cost is one sort regardless of the horizon.
    """
    out = scan.next_times(df, s, {"_nf": flag, "_na": F.lit(True)})
    us = epoch_micros(s.ts)
    for name, secs in horizons.items():
        end = us + F.lit(int(secs) * 1_000_000)
        out = out.withColumn(name, F.when(F.col("_nf") <= end, 1).when(F.col("_na") <= end, 0).cast("int"))
    return out.drop("_nf", "_na")


def censoring(df: DataFrame, s: Series, flag: Column, horizons: dict[str, int], max_gap: int) -> DataFrame:
    """``<name>_is_censored`` for each label ``name -> seconds`` of :func:`lookahead`: true when the
    label was not observed to its end.

    A label counts as observed when the row itself is flagged (it is 0 by definition), when a flagged
    row lies in ``(t, t + seconds]``, or when the series has rows up to ``t + seconds`` with no step
    between neighbouring times over ``max_gap`` seconds. The end of the data and every long gap thus
    censor the rows before them. Two next-time scans, so chunked series stay chunked; rows without a
    time are censored.
    """
    us = epoch_micros(s.ts)
    gap = F.lit(int(max_gap) * 1_000_000)
    out = scan.next_times(df, s, {"_nf": flag, "_na": F.lit(True)})
    out = out.withColumn("_brk", F.col("_na").isNull() | (F.col("_na") - us > gap))
    out = scan.next_times(out, s, {"_nb": F.col("_brk")})
    reach = F.when(F.col("_brk"), us).otherwise(F.col("_nb"))       # the last time reached without a gap
    for name, secs in horizons.items():
        end = us + F.lit(int(secs) * 1_000_000)
        seen = F.coalesce(flag, F.lit(False)) | F.coalesce(F.col("_nf") <= end, F.lit(False)) | F.coalesce(reach >= end, F.lit(False))
        out = out.withColumn(f"{name}_is_censored", ~seen | us.isNull())
    return out.drop("_nf", "_na", "_brk", "_nb")


def finish_labels(df: DataFrame, s: Series, labels, flag: Column) -> DataFrame:
    """0 where the flag is already set; then carry labels forward over gaps."""
    tmp = {f"_fl_{c}": F.when(flag, F.lit(0)).otherwise(F.col(c)).cast("int") for c in labels}
    out = scan.fill_forward(df, s, tmp)
    for c in labels:
        out = out.withColumn(c, F.col(f"_fl_{c}"))
    return out.drop(*tmp)
