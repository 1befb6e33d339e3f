"""Resampling into fixed time buckets.

Per-bucket state is computed with a grouped aggregate (partial aggregation
map-side, so a hot bucket is pre-reduced) and attached back to the rows with
an equi-join on ``(keys, bucket)``. A window over the bucket would instead
send every row of a hot bucket to one task; the join lets adaptive execution
broadcast a small bucket table or split a skewed partition.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicelife.functions.time import calendar_features, time_bucket
from devicelife.series import null_safe_join


def add_bucket(df: DataFrame, ts: str, seconds: int = 300, name: str | None = None) -> DataFrame:
    """Truncate ``ts`` to ``seconds``-wide buckets (in place unless ``name``)."""
    return df.withColumn(name or ts, time_bucket(ts, seconds))


def harmonise(df: DataFrame, keys, bucket: str, cols=None, once=()) -> DataFrame:
    """Within each bucket, a column with at most one distinct non-null value
    takes that value on every row; other columns keep each row's own value.
    Exact duplicate rows are then removed.

    Columns named in ``once`` take their bucket's sum over the rows of ``df``
    instead (as double, 0 when all are null), so each source row counts once
    however many rows the bucket keeps; give them to :class:`FlattenSpec` as
    ``once`` too. Repeated source rows are the caller's to drop first.

    "At most one distinct non-null value" is ``min <=> max`` (both null when
    the bucket holds none).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = keys + [bucket]
    once = [c for c in once if c in df.columns]
    cols = [c for c in (cols or df.columns) if c not in by and c not in once]
    aggs = [F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(f"_once{i}") for i, c in enumerate(once)]
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"_mn{i}"), F.max(c).alias(f"_mx{i}")]
    stats = df.groupBy(*by).agg(*aggs)
    joined = null_safe_join(df, stats, by, "left")
    out = []
    for i, c in enumerate(cols):
        mn, mx = F.col(f"_mn{i}"), F.col(f"_mx{i}")
        out.append(F.when(mn.eqNullSafe(mx), mx).otherwise(F.col(c)).alias(c))
    out += [F.col(f"_once{i}").alias(c) for i, c in enumerate(once)]
    rest = [c for c in df.columns if c not in cols and c not in once]
    return joined.select(*rest, *out).select(*df.columns).distinct()


def bucket_conflicts(df: DataFrame, keys, bucket: str, cols=None) -> DataFrame:
    """Buckets that more than one distinct row is left of, and why:
    ``(*keys, bucket, n_rows, columns)`` with the names of the columns in which
    the bucket's rows differ (null counts as a value), in the order of ``cols``.

    One grouped aggregate of minima, maxima and counts, combined before the
    shuffle; no bucket's rows are brought together.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = keys + [bucket]
    cols = [c for c in (cols or df.columns) if c not in by]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"_mn{i}"), F.max(c).alias(f"_mx{i}"), F.count(c).alias(f"_n{i}")]
    stats = df.groupBy(*by).agg(*aggs)
    differs = [F.when((F.col(f"_mn{i}") != F.col(f"_mx{i}"))
                      | ((F.col(f"_n{i}") > 0) & (F.col(f"_n{i}") < F.col("n_rows"))), F.lit(c)) for i, c in enumerate(cols)]
    found = stats.select(*by, "n_rows", F.array_compact(F.array(*differs) if differs else F.array().cast("array<string>")).alias("columns"))
    return found.where(F.size("columns") > 0)


def conflict_columns(conflicts: DataFrame) -> DataFrame:
    """How many buckets each column keeps from being one row, and in how many it is the only
    reason: ``(column, n_buckets, n_alone)``, from :func:`bucket_conflicts`."""
    each = conflicts.select(F.explode("columns").alias("column"), (F.size("columns") == 1).cast("long").alias("alone"))
    return each.groupBy("column").agg(F.count(F.lit(1)).alias("n_buckets"), F.sum("alone").alias("n_alone"))


def categories(df: DataFrame, cols) -> dict[str, list]:
    """Observed non-null values of each category column (sorted); one small job per column.

    Every value comes to the driver and becomes a column of :func:`one_hot`: for columns of
    very many values give ``one_hot`` a fixed list, or use :func:`one_hot_long`.
    """
    return {c: [r[0] for r in df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c).collect()] for c in cols}


def one_hot_long(df: DataFrame, keys, cols) -> DataFrame:
    """The ones of :func:`one_hot` as rows ``(*keys, column, value)``, for any number of values
    (as text; null gives no row). ``keys`` name the row."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols if c in df.columns])
    return df.select(*keys, F.inline(cells)).where(F.col("value").isNotNull())


def one_hot(df: DataFrame, cols, cats: dict[str, list] | None = None, sep: str = "_",
            drop: bool = True) -> tuple[DataFrame, list[str]]:
    """Replace each category column with 0/1 int columns ``<col><sep><value>``.

    The null category gets no column (a null row is 0 everywhere). Dots in
    values become ``_`` in the names (``Basal Rate (U/h)_0_8``). Returns
    the frame and the list of generated column names. ``cats`` fixes the
    columns up front; otherwise they are read from the data.
    """
    cols = [c for c in cols if c in df.columns]
    if cats is None:
        cats = categories(df, cols)
    flags, names = [], []
    for c in cols:
        for v in cats.get(c, []):
            # a dot in a Spark column name reads as struct access: use "_"
            name = f"{c}{sep}{v}".replace(".", "_")
            names.append(name)
            flags.append(F.when(F.col(c) == F.lit(v), 1).otherwise(0).cast("int").alias(name))
    keep = [x for x in df.columns if not (drop and x in cols)]
    return df.select(*keep, *flags), names


@dataclass
class FlattenSpec:
    """How columns merge when a bucket holds several rows."""
    flags: list[str] = field(default_factory=list)   # max
    sums: list[str] = field(default_factory=list)    # sum, 0 when all null
    means: list[str] = field(default_factory=list)   # mean
    once: list[str] = field(default_factory=list)    # bucket totals made by harmonise(once=...)
    calendar: bool = True                            # add Hour, Minute, Month


def flatten_buckets(df: DataFrame, keys, bucket: str, spec: FlattenSpec) -> DataFrame:
    """Merge the rows of each bucket.

    Flags take the bucket max, sum columns the bucket sum (as double), mean
    columns the bucket mean; every other column keeps its row value, and
    duplicate rows are dropped (so a bucket keeps one row per distinct set
    of "other" values). With no other columns this is one grouped aggregate.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = keys + [bucket]
    flags = [c for c in spec.flags if c in df.columns]
    sums = [c for c in spec.sums if c in df.columns]
    means = [c for c in spec.means if c in df.columns]
    once = [c for c in spec.once if c in df.columns and c not in sums]
    merged = set(flags) | set(sums) | set(means) | set(once)
    rest = [c for c in df.columns if c not in merged and c not in by]
    aggs = ([F.max(c).cast("int").alias(c) for c in flags]
            + [F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in sums]
            + [F.avg(F.col(c).cast("double")).alias(c) for c in means]
            + [F.max(c).alias(c) for c in once])
    stats = df.groupBy(*by).agg(*aggs) if aggs else df.select(*by).distinct()
    if rest:
        out = null_safe_join(df.select(*by, *rest), stats, by, "left").distinct()
    else:
        out = stats
    out = out.select(*[c for c in df.columns if c in out.columns])
    if spec.calendar:
        out = out.select("*", *[e.alias(n) for n, e in calendar_features(bucket).items()])
    return out
