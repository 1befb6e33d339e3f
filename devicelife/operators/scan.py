"""Ordered scans over series: running sums, fills, lags, next-event times.

Each function takes a :class:`~devicelife.series.Series`. Unchunked, it is
one window expression per output and Catalyst shares one exchange and one
sort among all of them. Chunked (see :func:`devicelife.series.with_chunks`)
the same window runs inside each chunk, and a per-chunk summary table (one
row per chunk, so at most ``#series + #chunks`` rows) carries the state
across chunk borders: a prefix total, the last non-null value, the next
event time, or the edge rows a lag needs. The summaries are joined back on
``(keys, chunk)``, which the chunk windows already partition by, so the big
side is not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicelife.series import Series, null_safe_join


def epoch_micros(c) -> Column:
    """Microseconds since the epoch of a timestamp or timestamp_ntz column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def _pexprs(df: DataFrame, s: Series) -> list[Column]:
    """Window partition columns: keys, or (non-null key stand-ins, chunk)."""
    return [F.col(c) for c in s.part_cols()]


def _win(df: DataFrame, s: Series, desc: bool = False):
    return Window.partitionBy(*_pexprs(df, s)).orderBy(*(s.order_desc() if desc else s.order()))


def _running(df: DataFrame, s: Series):
    return _win(df, s).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _chunk_order(s: Series, desc: bool = False):
    w = Window.partitionBy(*s.key_cols())
    return w.orderBy(F.col(s.chunk).desc() if desc else F.col(s.chunk))


# --------------------------------------------------------------------------
# running sums


def running_sums(df: DataFrame, s: Series, exprs: dict[str, Column]) -> DataFrame:
    """Add running (inclusive) sums of each expression along the series."""
    out = df.select("*", *[F.sum(e).over(_running(df, s)).alias(n) for n, e in exprs.items()])
    if not s.chunk:
        return out
    tot = df.groupBy(*s.part_cols()).agg(*[F.sum(e).alias(f"_tot_{n}") for n, e in exprs.items()])
    prev = _chunk_order(s).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*s.part_cols(), *[
        F.coalesce(F.sum(f"_tot_{n}").over(prev), F.lit(0)).alias(f"_off_{n}") for n in exprs])
    out = null_safe_join(out, off, s.part_cols())
    for n in exprs:
        out = out.withColumn(n, F.col(n) + F.coalesce(F.col(f"_off_{n}"), F.lit(0)))
    return out.drop(*[f"_off_{n}" for n in exprs])


def row_index(df: DataFrame, s: Series, name: str = "_rn") -> DataFrame:
    """1-based position of each row in its series (row_number, chunk-safe)."""
    if not s.chunk:
        return df.withColumn(name, F.row_number().over(_win(df, s)).cast("long"))
    return running_sums(df, s, {name: F.lit(1).cast("long")})


# --------------------------------------------------------------------------
# fills


def fill_forward(df: DataFrame, s: Series, exprs: dict[str, Column]) -> DataFrame:
    """Last non-null value at or before each row (forward fill)."""
    out = df.select("*", *[F.last(e, ignorenulls=True).over(_running(df, s)).alias(n)
                           for n, e in exprs.items()])
    if not s.chunk:
        return out
    ords = s.order_cols()
    last = df.groupBy(*s.part_cols()).agg(*[
        F.max(F.when(e.isNotNull(), F.struct(*[F.col(c) for c in ords], e.alias("v")))).alias(f"_l_{n}")
        for n, e in exprs.items()])
    prev = _chunk_order(s).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*s.part_cols(), *[
        F.last(F.col(f"_l_{n}.v"), ignorenulls=True).over(prev).alias(f"_c_{n}") for n in exprs])
    out = null_safe_join(out, carry, s.part_cols())
    for n in exprs:
        out = out.withColumn(n, F.coalesce(F.col(n), F.col(f"_c_{n}")))
    return out.drop(*[f"_c_{n}" for n in exprs])


def fill_backward(df: DataFrame, s: Series, exprs: dict[str, Column]) -> DataFrame:
    """First non-null value at or after each row (backward fill)."""
    # A growing frame in reverse order; a "current row to unbounded
    # following" frame would be recomputed for every row.
    rev = _win(df, s, desc=True).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = df.select("*", *[F.last(e, ignorenulls=True).over(rev).alias(n) for n, e in exprs.items()])
    if not s.chunk:
        return out
    ords = s.order_cols()
    first = df.groupBy(*s.part_cols()).agg(*[
        F.min(F.when(e.isNotNull(), F.struct(*[F.col(c) for c in ords], e.alias("v")))).alias(f"_f_{n}")
        for n, e in exprs.items()])
    later = _chunk_order(s, desc=True).rowsBetween(Window.unboundedPreceding, -1)
    carry = first.select(*s.part_cols(), *[
        F.last(F.col(f"_f_{n}.v"), ignorenulls=True).over(later).alias(f"_c_{n}") for n in exprs])
    out = null_safe_join(out, carry, s.part_cols())
    for n in exprs:
        out = out.withColumn(n, F.coalesce(F.col(n), F.col(f"_c_{n}")))
    return out.drop(*[f"_c_{n}" for n in exprs])


# --------------------------------------------------------------------------
# lags


def lags(df: DataFrame, s: Series, specs: dict[str, tuple[Column, int]]) -> DataFrame:
    """``name -> (expr, n)``: value of ``expr`` n rows earlier in the series.

    Chunked: rows within ``max n`` of a chunk's start or end form a small
    edge table (at most ``2 * max n`` rows per chunk). Lags computed over the
    edge table, ordered across chunks, are exact for a chunk's first rows,
    because every row between such a row and its target is an edge row too.
    """
    out = df.select("*", *[F.lag(e, k).over(_win(df, s)).alias(n) for n, (e, k) in specs.items()])
    if not s.chunk:
        return out
    kmax = max(k for _, k in specs.values())
    w = _win(df, s)
    out = out.withColumn("_lrn", F.row_number().over(w)).withColumn(
        "_lcnt", F.count(F.lit(1)).over(Window.partitionBy(*_pexprs(df, s))))
    edge = out.where((F.col("_lrn") <= kmax) | (F.col("_lcnt") - F.col("_lrn") < kmax)).select(
        *s.part_cols(), *s.order_cols(), "_lrn", *[e.alias(f"_e_{n}") for n, (e, _) in specs.items()])
    across = Window.partitionBy(*s.key_cols()).orderBy(F.col(s.chunk), *s.order())
    fixed = edge.select(*s.part_cols(), "_lrn", *[
        F.lag(f"_e_{n}", k).over(across).alias(f"_x_{n}") for n, (_, k) in specs.items()]).where(
        F.col("_lrn") <= kmax)
    out = null_safe_join(out, fixed, [*s.part_cols(), "_lrn"])
    for n, (_, k) in specs.items():
        out = out.withColumn(n, F.when(F.col("_lrn") <= k, F.col(f"_x_{n}")).otherwise(F.col(n)))
    return out.drop("_lrn", "_lcnt", *[f"_x_{n}" for n in specs])


# --------------------------------------------------------------------------
# next event time (for look-ahead labels)


def next_times(df: DataFrame, s: Series, conds: dict[str, Column]) -> DataFrame:
    """``name -> cond``: epoch micros of the first row with a strictly later
    timestamp in the same series where ``cond`` holds (null if none).

    Computed as a running minimum in descending time order, a growing frame,
    so it costs one sort whatever the horizon; ``lit(True)`` gives the next
    timestamp of any row.
    """
    us = epoch_micros(s.ts)
    later = Window.partitionBy(*_pexprs(df, s)).orderBy(us.desc()).rangeBetween(Window.unboundedPreceding, -1)
    out = df.select("*", *[F.min(F.when(c, us)).over(later).alias(n) for n, c in conds.items()])
    if not s.chunk:
        return out
    # Rows of a later chunk are not earlier than this chunk's last time T, but a
    # burst on T may go on there: rows at T need the first hit after T, earlier
    # rows the first hit of any later chunk.
    lo = F.min(us).over(Window.partitionBy(*_pexprs(df, s)))
    first = df.withColumn("_lo", lo).groupBy(*s.part_cols()).agg(
        F.min(us).alias("_lo"), F.max(us).alias("_hi"),
        *[F.min(F.when(c, us)).alias(f"_m_{n}") for n, c in conds.items()],
        *[F.min(F.when(c & (us > F.col("_lo")), us)).alias(f"_m2_{n}") for n, c in conds.items()])
    nxt = _chunk_order(s, desc=True).rowsBetween(Window.unboundedPreceding, -1)
    carry = first.select(*s.part_cols(), "_hi", *[F.min(f"_m_{n}").over(nxt).alias(f"_c_{n}") for n in conds])
    # hits after each chunk's last time: all of chunks that begin later, and those after T of chunks that begin at T
    hits = first.select(*s.part_cols(), F.col("_lo").alias("_t"), F.lit(False).alias("_asks"), *[f"_m_{n}" for n in conds], *[f"_m2_{n}" for n in conds])
    asks = first.select(*s.part_cols(), F.col("_hi").alias("_t"), F.lit(True).alias("_asks"))
    both = hits.unionByName(asks, allowMissingColumns=True)
    at = Window.partitionBy(*s.key_cols()).orderBy(F.col("_t").desc())
    after, from_ = at.rangeBetween(Window.unboundedPreceding, -1), at.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    beyond = both.select(*s.part_cols(), "_asks", *[
        F.least(F.min(f"_m_{n}").over(after), F.min(f"_m2_{n}").over(from_)).alias(f"_d_{n}") for n in conds]).where("_asks").drop("_asks")
    out = null_safe_join(out, null_safe_join(carry, beyond, s.part_cols()), s.part_cols())
    for n in conds:
        out = out.withColumn(n, F.coalesce(F.col(n), F.when(us < F.col("_hi"), F.col(f"_c_{n}")).otherwise(F.col(f"_d_{n}"))))
    return out.drop("_hi", *[f"_{x}_{n}" for n in conds for x in "cd"])
