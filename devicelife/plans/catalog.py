"""Registered queries over the driver's tables, each with a DuckDB oracle.

The device semantics are mapped onto the ``events`` table: a series is a
``user_id`` (a device), ordered by ``ts`` with ``event_id`` breaking ties;
``value`` is the reading; ``event_type`` is the category, ``signup`` the
sensor-start flag and ``error`` the sensor-end flag. ``v`` is the reading
with the ``error`` rows blanked, which gives the fill operators real gaps.

Every query reads whole tables. Doubles are rounded to 6 places on both
sides, integers are ``bigint`` unless the operator defines ``int`` flags.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from devicelife.functions import time as tf
from devicelife.functions import values as vf
from devicelife.operators import aggregates, features, filters, joins, metrics, quality, resample, scan, split
from devicelife.operators import timeseries as ts_ops
from devicelife.series import Series, with_chunks
from devicelife.sources import report
from devicelife.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Run the series operators chunked: rows are range-partitioned so a hot
# device never lands in one task. Set False to run plain windows.
CHUNKED = True

# The event categories of the ``events`` table.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def events(spark, sf) -> DataFrame:
    ev = load(spark, sf, "events")
    return ev.withColumn("v", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")))


def series(df: DataFrame, chunked: bool | None = None) -> tuple[DataFrame, Series]:
    s = Series.of("user_id", "ts", "event_id")
    if CHUNKED if chunked is None else chunked:
        return with_chunks(df, s)
    return df, s


def done(df: DataFrame, s: Series) -> DataFrame:
    return rounded(df.drop(*s.helper_cols()))


EVV = ("SELECT event_id, user_id, ts, event_type, value, props, "
       "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events")
W_USER = "PARTITION BY user_id ORDER BY ts, event_id"
RUNNING = f"{W_USER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

# ----------------------------------------------------------------------------
# filters and projections


@register("drop_blank_rows", """
SELECT event_id, user_id, nullif(event_type, 'view') AS first_cell, value
FROM events WHERE nullif(event_type, 'view') IS NOT NULL""")
def q_drop_blank_rows(spark, sf):
    ev = load(spark, sf, "events").select(
        "event_id", "user_id", F.nullif("event_type", F.lit("view")).alias("first_cell"), "value")
    return filters.drop_blank_rows(ev, "first_cell")


@register("filter_all_null", """
SELECT event_id, nullif(event_type, 'view') AS a, CASE WHEN value > 50 THEN NULL ELSE value END AS b
FROM events WHERE nullif(event_type, 'view') IS NULL AND (CASE WHEN value > 50 THEN NULL ELSE value END) IS NULL""")
def q_filter_all_null(spark, sf):
    ev = load(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("a"),
        F.when(F.col("value") > 50, F.lit(None)).otherwise(F.col("value")).alias("b"))
    return filters.where_all_null(ev, ["a", "b"])


@register("filter_not_in_or_null", """
SELECT event_id, nullif(event_type, 'purchase') AS c FROM events
WHERE nullif(event_type, 'purchase') NOT IN ('click', 'view') OR nullif(event_type, 'purchase') IS NULL""")
def q_filter_not_in_or_null(spark, sf):
    ev = load(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("purchase")).alias("c"))
    return filters.where_not_in_or_null(ev, "c", ["click", "view"])


@register("blank_to_null", """
SELECT event_id, nullif(CASE WHEN event_type = 'view' THEN '' ELSE event_type END, '') AS s1,
       nullif(CASE WHEN value < 10 THEN '' ELSE props END, '') AS s2
FROM events""")
def q_blank_to_null(spark, sf):
    ev = load(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type")).alias("s1"),
        F.when(F.col("value") < 10, F.lit("")).otherwise(F.col("props")).alias("s2"))
    return filters.blank_to_null(ev)


def _profiled(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("a"),
        F.when(F.col("value") > 50, F.lit(None)).otherwise(F.col("value")).alias("b"), "props")


@register("null_profile", """
SELECT 'event_id' AS column_name, count(event_id) AS non_null, count(*) AS n_rows FROM events
UNION ALL SELECT 'a', count(nullif(event_type, 'view')), count(*) FROM events
UNION ALL SELECT 'b', count(CASE WHEN value > 50 THEN NULL ELSE value END), count(*) FROM events
UNION ALL SELECT 'props', count(props), count(*) FROM events""")
def q_null_profile(spark, sf):
    return quality.null_profile(_profiled(spark, sf))


@register("prune_null_columns", """
SELECT event_id, nullif(event_type, 'view') AS a, value FROM events""")
def q_prune_null_columns(spark, sf):
    ev = load(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("a"), "value",
        F.when(F.col("value") < 0, F.lit(1)).alias("z"))
    return filters.drop_null_columns(ev)


@register("drop_columns", """
SELECT event_id, ts, user_id, value FROM events""")
def q_drop_columns(spark, sf):
    ev = load(spark, sf, "events")
    ev = filters.drop_strict(ev, ["props"])
    return filters.drop_lenient(ev, ["event_type", "Bolus Number", "New Device Time"])


@register("select_rename", """
SELECT doc_id, quality AS Sensor_End FROM labels""")
def q_select_rename(spark, sf):
    return filters.select_rename(load(spark, sf, "labels"), {"doc_id": "doc_id", "quality": "Sensor_End"})


# ----------------------------------------------------------------------------
# report-shaped operators on events


@register("section_split", f"""
SELECT event_id, user_id,
       sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER ({RUNNING}) AS section_id
FROM events""")
def q_section_split(spark, sf):
    ev, s = series(load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type"))
    out = report.split_sections(ev, s, F.col("event_type") == "signup", "section_id")
    return done(out.select("event_id", "user_id", "section_id", *s.helper_cols()), s)


UNION_SQL = """
SELECT event_id, user_id, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
UNION ALL
SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'"""


def _two_exports(spark, sf):
    ev = load(spark, sf, "events")
    cols = ["event_id", "user_id", "event_type", "value"]
    a = ev.where(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")).select(*cols)
    b = ev.where(F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).select(*cols)
    return [a, b]


@register("union_all_tables", UNION_SQL)
def q_union_all_tables(spark, sf):
    return report.union_tables(_two_exports(spark, sf))


@register("dedup_rows", f"SELECT DISTINCT * FROM ({UNION_SQL}) u")
def q_dedup_rows(spark, sf):
    return report.union_tables(_two_exports(spark, sf), dedup=True)


@register("metadata_set_union", """
SELECT user_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS meta,
       count(DISTINCT event_type) AS n_values
FROM events GROUP BY user_id""")
def q_metadata_set_union(spark, sf):
    ev = load(spark, sf, "events")
    merged = report.merge_meta(ev, "user_id", "event_type")
    return merged.select("user_id", F.concat_ws(";", "meta").alias("meta"),
                         F.size("meta").cast("long").alias("n_values"))


@register("metadata_fold", """
SELECT key, string_agg(DISTINCT value, ';' ORDER BY value) AS value FROM (
  SELECT 'event_type' AS key, event_type AS value FROM events
  UNION ALL SELECT 'hour', CAST(hour(ts) AS VARCHAR) FROM events
  UNION ALL SELECT 'blank', CASE WHEN event_id < 0 THEN 'x' ELSE '' END FROM events
) t WHERE value IS NOT NULL AND value <> '' GROUP BY key""")
def q_metadata_fold(spark, sf):
    ev = load(spark, sf, "events").select(
        F.col("event_type"), F.hour("ts").cast("string").alias("hour"),
        F.when(F.col("event_id") < 0, F.lit("x")).otherwise(F.lit("")).alias("blank"))
    return report.fold_metadata(ev)


# ----------------------------------------------------------------------------
# casts and parsing


@register("cast_strict", """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS INTEGER) AS quantity,
       CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price
FROM lineitem""")
def q_cast_strict(spark, sf):
    li = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").cast("string").alias("q"),
        F.col("l_extendedprice").cast("string").alias("p"))
    return li.select("l_orderkey", "l_linenumber", vf.cast_strict("q", "int", 0, 65535).alias("quantity"),
                     vf.cast_strict("p", "double").alias("price"))


@register("parse_date_any", """
WITH t AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN strftime(o_orderdate, '%-m/%-d/%Y')
                          WHEN o_orderpriority = '5-LOW' THEN 'not a date'
                          ELSE strftime(o_orderdate, '%Y/%-m/%-d') END AS date_text
  FROM orders)
SELECT o_orderkey, date_text,
       CAST(coalesce(try_strptime(date_text, '%m/%d/%Y'), try_strptime(date_text, '%Y/%m/%d')) AS DATE) AS o_date
FROM t""")
def q_parse_date_any(spark, sf):
    o = load(spark, sf, "orders")
    text = (F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.date_format("o_orderdate", "M/d/yyyy"))
            .when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date"))
            .otherwise(F.date_format("o_orderdate", "yyyy/M/d")))
    o = o.select("o_orderkey", text.alias("date_text"))
    return o.select("o_orderkey", "date_text", tf.parse_date_any("date_text").alias("o_date"))


@register("combine_date_time", """
SELECT event_id, strptime(CAST(CAST(ts AS DATE) AS VARCHAR) || ' ' || strftime(ts, '%H:%M:%S'),
                          '%Y-%m-%d %H:%M:%S') AS Datetime
FROM events""")
def q_combine_date_time(spark, sf):
    ev = load(spark, sf, "events").select("event_id", F.to_date("ts").alias("d"),
                                          F.date_format("ts", "HH:mm:ss").alias("t"))
    return ev.select("event_id", tf.combine_date_time("d", "t").alias("Datetime"))


# ----------------------------------------------------------------------------
# outliers (P11, P12)

CLIP = "(SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)"


@register("sigma_clip", f"""
SELECT event_id, value FROM events, {CLIP} s WHERE value BETWEEN s.m - 3 * s.sd AND s.m + 3 * s.sd""")
def q_sigma_clip(spark, sf):
    return quality.sigma_clip(load(spark, sf, "events").select("event_id", "value"), "value", 3.0)


@register("sigma_clip_time", """
WITH s AS (SELECT avg(epoch_us(ts)) AS m, stddev_samp(epoch_us(ts)) AS sd FROM events),
b AS (SELECT make_timestamp(CAST(floor((m - 3 * sd) / 1e6) AS BIGINT) * 1000000) AS lo,
             make_timestamp(CAST(floor((m + 3 * sd) / 1e6) AS BIGINT) * 1000000) AS hi FROM s)
SELECT event_id, ts FROM events, b WHERE ts BETWEEN b.lo AND b.hi""")
def q_sigma_clip_time(spark, sf):
    return quality.sigma_clip(load(spark, sf, "events").select("event_id", "ts"), "ts", 3.0)


@register("sigma_clip_report", f"""
WITH s AS {CLIP},
o AS (SELECT value FROM events, s WHERE NOT (value BETWEEN s.m - 3 * s.sd AND s.m + 3 * s.sd)),
f AS (SELECT DISTINCT value FROM o ORDER BY value LIMIT 5)
SELECT (SELECT count(*) FROM o) AS n_removed, round(s.m - 3 * s.sd, 6) AS valid_start,
       round(s.m + 3 * s.sd, 6) AS valid_end,
       (SELECT string_agg(CAST(value AS VARCHAR), ', ' ORDER BY value) FILTER (WHERE rn <= 4)
               || CASE WHEN count(*) > 4 THEN ', ...' ELSE '' END
        FROM (SELECT value, row_number() OVER (ORDER BY value) AS rn FROM f) x) AS sample
FROM s""")
def q_sigma_clip_report(spark, sf):
    return rounded(quality.sigma_clip_report(load(spark, sf, "events").select("value"), "value", 3.0))


# ----------------------------------------------------------------------------
# joins (J1, J3, J4)


@register("full_join_coalesce", """
WITH a AS (SELECT strftime(ts, '%Y-%m-%d') AS Date, strftime(ts, '%H:%M:%S') AS Time, event_id, value
           FROM events WHERE event_type IN ('click', 'view')),
b AS (SELECT strftime(ts, '%Y-%m-%d') AS Date, strftime(ts, '%H:%M:%S') AS Time, event_id, value, event_type
      FROM events WHERE event_type IN ('purchase', 'signup', 'error'))
SELECT coalesce(a.Date, b.Date) AS Date, coalesce(a.Time, b.Time) AS Time, a.event_id, a.value,
       b.event_id AS event_id_2, b.value AS value_2, b.event_type
FROM a FULL OUTER JOIN b ON a.Date = b.Date AND a.Time = b.Time""")
def q_full_join_coalesce(spark, sf):
    ev = load(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("Date"), F.date_format("ts", "HH:mm:ss").alias("Time"),
        "event_id", "value", "event_type")
    sensor = ev.where(F.col("event_type").isin("click", "view")).drop("event_type")
    pump = ev.where(F.col("event_type").isin("purchase", "signup", "error"))
    return joins.full_join_suffix(sensor, pump, ["Date", "Time"], "_2")


FULL_JOIN_SQL = """
WITH a AS (SELECT strftime(ts, '%Y-%m-%d') AS Date, strftime(ts, '%H:%M:%S') AS Time, event_id, value
           FROM events WHERE event_type IN ('click', 'view')),
b AS (SELECT strftime(ts, '%Y-%m-%d') AS Date, strftime(ts, '%H:%M:%S') AS Time, event_id, value, event_type
      FROM events WHERE event_type IN ('purchase', 'signup', 'error'))
SELECT coalesce(a.Date, b.Date) AS Date, coalesce(a.Time, b.Time) AS Time, a.event_id, a.value,
       b.event_id AS event_id_2, b.value AS value_2, b.event_type
FROM a FULL OUTER JOIN b ON a.Date = b.Date AND a.Time = b.Time"""


@register("full_join_split", FULL_JOIN_SQL)
def q_full_join_split(spark, sf):
    ev = load(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("Date"), F.date_format("ts", "HH:mm:ss").alias("Time"),
        "event_id", "value", "event_type")
    sensor = ev.where(F.col("event_type").isin("click", "view")).drop("event_type")
    pump = ev.where(F.col("event_type").isin("purchase", "signup", "error"))
    return joins.full_join_suffix(sensor, pump, ["Date", "Time"], "_2", split_outer=True)


@register("anti_join_rows", """
SELECT e.event_id, e.user_id FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_type = 'error' AND x.user_id = e.user_id
                  AND date_trunc('hour', x.ts) = date_trunc('hour', e.ts))""")
def q_anti_join_rows(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "event_type",
                                          tf.time_bucket("ts", 3600).alias("hour"))
    errs = ev.where(F.col("event_type") == "error").select("user_id", "hour")
    return joins.anti_join(ev, errs, ["user_id", "hour"]).select("event_id", "user_id")


@register("left_join_window_target", """
WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hour,
                  max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS err
           FROM events GROUP BY 1, 2),
t AS (SELECT user_id, hour, max(err) OVER (PARTITION BY user_id ORDER BY hour
        RANGE BETWEEN INTERVAL 1 SECOND FOLLOWING AND INTERVAL 2 HOUR FOLLOWING) AS target FROM h)
SELECT e.event_id, t.hour, CAST(t.target AS INTEGER) AS target
FROM events e LEFT JOIN t ON e.user_id = t.user_id AND date_trunc('hour', e.ts) = t.hour""")
def q_left_join_window_target(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "user_id", "event_type",
                                          tf.time_bucket("ts", 3600).alias("hour"))
    h = ev.groupBy("user_id", "hour").agg(
        F.max(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("err"))
    h = h.withColumnRenamed("hour", "ts")
    by_user = Series.of("user_id", "ts")
    h, by_user = with_chunks(h, by_user) if CHUNKED else (h, by_user)
    t = ts_ops.lookahead(h, by_user, F.col("err") == 1, {"target": 7200})
    t = t.select("user_id", F.col("ts").alias("hour"), "target")
    return joins.attach(ev.select("event_id", "user_id", "hour"), t, ["user_id", "hour"]).select(
        "event_id", "hour", "target")


# ----------------------------------------------------------------------------
# resampling

BUCKET5 = "time_bucket(INTERVAL 5 MINUTE, ts)"


@register("time_bucket", f"SELECT event_id, {BUCKET5} AS bucket FROM events")
def q_time_bucket(spark, sf):
    return load(spark, sf, "events").select("event_id", tf.time_bucket("ts", 300).alias("bucket"))


@register("calendar_features", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS Hour, CAST(minute(ts) AS INTEGER) AS Minute,
       CAST(month(ts) AS INTEGER) AS Month FROM events""")
def q_calendar_features(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", *[e.alias(n) for n, e in tf.calendar_features("ts").items()])


@register("bucket_distinct_counts", """
SELECT date_trunc('hour', ts) AS bucket, count(DISTINCT event_type) AS n_event_type,
       count(DISTINCT user_id) AS n_user_id
FROM events GROUP BY 1""")
def q_bucket_distinct_counts(spark, sf):
    ev = load(spark, sf, "events").withColumn("bucket", tf.time_bucket("ts", 3600))
    return aggregates.distinct_counts(ev, "bucket", ["event_type", "user_id"])


HARMONISED = f"""
WITH b AS (SELECT {BUCKET5} AS bucket, event_type, user_id, v FROM ({EVV}) e),
s AS (SELECT bucket, min(event_type) AS mn1, max(event_type) AS mx1, min(user_id) AS mn2, max(user_id) AS mx2,
             min(v) AS mn3, max(v) AS mx3 FROM b GROUP BY bucket),
h AS (SELECT DISTINCT b.bucket,
        CASE WHEN s.mn1 IS NOT DISTINCT FROM s.mx1 THEN s.mx1 ELSE b.event_type END AS event_type,
        CASE WHEN s.mn2 IS NOT DISTINCT FROM s.mx2 THEN s.mx2 ELSE b.user_id END AS user_id,
        CASE WHEN s.mn3 IS NOT DISTINCT FROM s.mx3 THEN s.mx3 ELSE b.v END AS v
      FROM b JOIN s ON b.bucket = s.bucket)"""


def _harmonised(spark, sf):
    ev = events(spark, sf).select(tf.time_bucket("ts", 300).alias("bucket"), "event_type", "user_id", "v")
    return resample.harmonise(ev, [], "bucket", ["event_type", "user_id", "v"])


@register("harmonise_bucket", HARMONISED + " SELECT bucket, event_type, user_id, round(v, 6) AS v FROM h")
def q_harmonise_bucket(spark, sf):
    return rounded(_harmonised(spark, sf))


def _flag_sql(col="event_type", cats=EVENT_TYPES, agg=None):
    out = []
    for c in cats:
        e = f"CASE WHEN {col} = '{c}' THEN 1 ELSE 0 END"
        out.append(f"CAST({agg}({e}) AS INTEGER) AS {col}_{c}" if agg else f"CAST({e} AS INTEGER) AS {col}_{c}")
    return ", ".join(out)


@register("one_hot", f"""
SELECT event_id, {_flag_sql('c', ['click', 'error', 'purchase', 'signup'])}
FROM (SELECT event_id, nullif(event_type, 'view') AS c FROM events) t""")
def q_one_hot(spark, sf):
    ev = load(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("c"))
    out, _ = resample.one_hot(ev, ["c"])
    return out


@register("one_hot_long", """
SELECT event_id, 'event_type' AS "column", nullif(event_type, 'view') AS value FROM events WHERE event_type <> 'view'
UNION ALL SELECT event_id, 'user_id', CAST(user_id AS VARCHAR) FROM events WHERE user_id IS NOT NULL""")
def q_one_hot_long(spark, sf):
    ev = load(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("event_type"), "user_id")
    return resample.one_hot_long(ev, "event_id", ["event_type", "user_id"])


@register("bucket_mixed_agg", f"""
SELECT date_trunc('hour', ts) AS bucket, {_flag_sql(agg='max')},
       round(coalesce(sum(value), 0), 6) AS value, round(avg(value), 6) AS value_avg
FROM events GROUP BY 1""")
def q_bucket_mixed_agg(spark, sf):
    ev = load(spark, sf, "events").select(tf.time_bucket("ts", 3600).alias("bucket"), "event_type", "value",
                                          F.col("value").alias("value_avg"))
    ev, flags = resample.one_hot(ev, ["event_type"])
    spec = resample.FlattenSpec(flags=flags, sums=["value"], means=["value_avg"], calendar=False)
    return rounded(resample.flatten_buckets(ev, [], "bucket", spec))


@register("flatten_bucket", HARMONISED + f""",
o AS (SELECT bucket, user_id, v, {_flag_sql()} FROM h),
a AS (SELECT bucket, {', '.join(f'CAST(max(event_type_{c}) AS INTEGER) AS event_type_{c}' for c in EVENT_TYPES)},
             coalesce(sum(v), 0) AS v FROM o GROUP BY bucket)
SELECT DISTINCT o.bucket, o.user_id, {', '.join(f'a.event_type_{c}' for c in EVENT_TYPES)}, round(a.v, 6) AS v,
       CAST(hour(o.bucket) AS INTEGER) AS Hour, CAST(minute(o.bucket) AS INTEGER) AS Minute,
       CAST(month(o.bucket) AS INTEGER) AS Month
FROM o JOIN a ON o.bucket = a.bucket""")
def q_flatten_bucket(spark, sf):
    h = _harmonised(spark, sf)
    oh, flags = resample.one_hot(h, ["event_type"], {"event_type": EVENT_TYPES})
    spec = resample.FlattenSpec(flags=flags, sums=["v"])
    return rounded(resample.flatten_buckets(oh, [], "bucket", spec))


# ----------------------------------------------------------------------------
# seed rows

FIRSTK = f"""
WITH f AS (SELECT user_id, ts, event_id, v, row_number() OVER ({W_USER}) AS rn
           FROM ({EVV}) e WHERE v IS NOT NULL)"""


@register("flatten_bucket_sum_once", f"""
WITH src AS (SELECT DISTINCT * FROM (
       SELECT event_id, user_id, ts, event_type, v FROM ({EVV}) e WHERE ts < TIMESTAMP '2024-01-16 00:00:00'
       UNION ALL
       SELECT event_id, user_id, ts, event_type, v FROM ({EVV}) e WHERE ts >= TIMESTAMP '2024-01-10 00:00:00') u),
b AS (SELECT {BUCKET5} AS bucket, event_type, user_id, v FROM src),
s AS (SELECT bucket, min(event_type) AS mn1, max(event_type) AS mx1, min(user_id) AS mn2, max(user_id) AS mx2,
             coalesce(sum(v), 0) AS v FROM b GROUP BY bucket),
h AS (SELECT DISTINCT b.bucket,
        CASE WHEN s.mn1 IS NOT DISTINCT FROM s.mx1 THEN s.mx1 ELSE b.event_type END AS event_type,
        CASE WHEN s.mn2 IS NOT DISTINCT FROM s.mx2 THEN s.mx2 ELSE b.user_id END AS user_id, s.v
      FROM b JOIN s ON b.bucket = s.bucket),
o AS (SELECT bucket, user_id, v, {_flag_sql()} FROM h),
a AS (SELECT bucket, {', '.join(f'CAST(max(event_type_{c}) AS INTEGER) AS event_type_{c}' for c in EVENT_TYPES)}
      FROM o GROUP BY bucket)
SELECT DISTINCT o.bucket, o.user_id, {', '.join(f'a.event_type_{c}' for c in EVENT_TYPES)}, round(o.v, 6) AS v,
       CAST(hour(o.bucket) AS INTEGER) AS Hour, CAST(minute(o.bucket) AS INTEGER) AS Minute,
       CAST(month(o.bucket) AS INTEGER) AS Month
FROM o JOIN a ON o.bucket = a.bucket""")
def q_flatten_bucket_sum_once(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "v")
    a = ev.where(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    b = ev.where(F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    src = report.union_tables([a, b], dedup=True)
    rows = src.select(tf.time_bucket("ts", 300).alias("bucket"), "event_type", "user_id", "v")
    h = resample.harmonise(rows, [], "bucket", ["event_type", "user_id"], once=["v"])
    oh, flags = resample.one_hot(h, ["event_type"], {"event_type": EVENT_TYPES})
    return rounded(resample.flatten_buckets(oh, [], "bucket", resample.FlattenSpec(flags=flags, once=["v"])))


CONFLICTS = HARMONISED + """,
g AS (SELECT bucket, count(*) AS n_rows,
        min(event_type) <> max(event_type) OR (count(event_type) > 0 AND count(event_type) < count(*)) AS c1,
        min(user_id) <> max(user_id) OR (count(user_id) > 0 AND count(user_id) < count(*)) AS c2,
        min(v) <> max(v) OR (count(v) > 0 AND count(v) < count(*)) AS c3 FROM h GROUP BY bucket),
k AS (SELECT bucket, n_rows, concat_ws(';', CASE WHEN c1 THEN 'event_type' END, CASE WHEN c2 THEN 'user_id' END,
                                       CASE WHEN c3 THEN 'v' END) AS columns FROM g)"""


@register("bucket_conflicts", CONFLICTS + " SELECT bucket, n_rows, columns FROM k WHERE columns <> ''")
def q_bucket_conflicts(spark, sf):
    out = resample.bucket_conflicts(_harmonised(spark, sf), [], "bucket", ["event_type", "user_id", "v"])
    return out.withColumn("columns", F.concat_ws(";", "columns"))


@register("bucket_conflict_columns", CONFLICTS + """
SELECT c AS "column", count(*) AS n_buckets, CAST(sum(CASE WHEN columns = c THEN 1 ELSE 0 END) AS BIGINT) AS n_alone
FROM (SELECT columns, unnest(string_split(columns, ';')) AS c FROM k WHERE columns <> '') t GROUP BY 1""")
def q_bucket_conflict_columns(spark, sf):
    return resample.conflict_columns(
        resample.bucket_conflicts(_harmonised(spark, sf), [], "bucket", ["event_type", "user_id", "v"]))


@register("first_k_non_null", FIRSTK + " SELECT user_id, ts, event_id, v, rn FROM f WHERE rn <= 12")
def q_first_k_non_null(spark, sf):
    ev, s = series(events(spark, sf).select("user_id", "ts", "event_id", "v"))
    out = ts_ops.first_k_non_null(ev, s, "v", 12, "rn")
    return done(out, s)


SEED_SQL = FIRSTK + """,
w AS (SELECT user_id, """ + ", ".join(f"max(CASE WHEN rn = {i + 1} THEN v END) AS v{i}" for i in range(12)) + """
      FROM f WHERE rn <= 12 GROUP BY user_id),
sl AS (SELECT user_id, v0 + 12.0 * ((""" + " + ".join(f"(v{i} - v{i + 5}) / 6.0" for i in range(6)) + """) / 6.0 * 1.0) AS sv
       FROM w),
seeds AS (SELECT f.user_id, f.ts - INTERVAL 60 MINUTE AS ts, CASE WHEN f.rn = 1 THEN sl.sv END AS v, true AS is_seed
          FROM f JOIN sl ON f.user_id = sl.user_id WHERE f.rn <= 12)"""


@register("backcast_seed", SEED_SQL + " SELECT user_id, ts, round(v, 6) AS v, is_seed FROM seeds")
def q_backcast_seed(spark, sf):
    ev, s = series(events(spark, sf).select("user_id", "ts", "event_id", "v"))
    out = ts_ops.backcast_seed(ev, s, "v", ["v"])
    return rounded(out)


@register("union_seed", SEED_SQL + f"""
SELECT user_id, ts, event_id, round(v, 6) AS v, false AS is_seed FROM ({EVV}) e
UNION ALL SELECT user_id, ts, NULL, round(v, 6), true FROM seeds""")
def q_union_seed(spark, sf):
    ev, s = series(events(spark, sf).select("user_id", "ts", "event_id", "v"))
    seeds = ts_ops.backcast_seed(ev, s, "v", ["v"])
    base = ev.drop(*s.helper_cols())
    return rounded(ts_ops.union_seed(base, seeds).select("user_id", "ts", "event_id", "v", "is_seed"))


# ----------------------------------------------------------------------------
# fills, lags, ratios


@register("interpolate_linear", f"""
WITH r AS (SELECT event_id, user_id, ts, v, row_number() OVER ({W_USER}) AS rn FROM ({EVV}) e),
p AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r0,
               last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
               first_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r1,
               first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1 FROM r)
SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v
                            WHEN r0 IS NOT NULL AND r1 IS NOT NULL THEN v0 + (rn - r0) * (v1 - v0) / (r1 - r0) END, 6) AS v
FROM p""")
def q_interpolate_linear(spark, sf):
    ev, s = series(events(spark, sf).select("event_id", "user_id", "ts", "v"))
    out = ts_ops.interpolate_linear(ev, s, ["v"])
    return done(out.select("event_id", "v", *s.helper_cols()), s)


@register("forward_fill", f"""
SELECT event_id, round(coalesce(last_value(v IGNORE NULLS) OVER ({RUNNING}), 0), 6) AS v FROM ({EVV}) e""")
def q_forward_fill(spark, sf):
    ev, s = series(events(spark, sf).select("event_id", "user_id", "ts", "v"))
    out = ts_ops.forward_fill(ev, s, ["v"], default=0.0)
    return done(out.select("event_id", "v", *s.helper_cols()), s)


@register("lag_columns", f"""
SELECT event_id, lag(v, 3) OVER ({W_USER}) AS v_15m, lag(v, 6) OVER ({W_USER}) AS v_30m,
       lag(v, 12) OVER ({W_USER}) AS v_60m FROM ({EVV}) e""")
def q_lag_columns(spark, sf):
    ev, s = series(events(spark, sf).select("event_id", "user_id", "ts", "v"))
    out = ts_ops.lag_columns(ev, s, ["v"])
    return done(out.select("event_id", "v_15m", "v_30m", "v_60m", *s.helper_cols()), s)


@register("lag_deltas", f"""
SELECT event_id, round(value - lag(value, 3) OVER ({W_USER}), 6) AS value_15m_delta,
       round(value - lag(value, 6) OVER ({W_USER}), 6) AS value_30m_delta,
       round(value - lag(value, 12) OVER ({W_USER}), 6) AS value_60m_delta,
       round(v - lag(v, 3) OVER ({W_USER}), 6) AS v_15m_delta,
       round(v - lag(v, 6) OVER ({W_USER}), 6) AS v_30m_delta,
       round(v - lag(v, 12) OVER ({W_USER}), 6) AS v_60m_delta FROM ({EVV}) e""")
def q_lag_deltas(spark, sf):
    ev, s = series(events(spark, sf).select("event_id", "user_id", "ts", "value", "v"))
    out = ts_ops.lag_deltas(ev, s, ["value", "v"])
    return done(out.drop("user_id", "ts", "value", "v"), s)


@register("diff_cumsum", f"""
SELECT event_id, round(value - lag(value) OVER ({W_USER}), 6) AS value_diff,
       round(sum(value) OVER ({RUNNING}), 6) AS value_cumsum FROM events""")
def q_diff_cumsum(spark, sf):
    ev, s = series(load(spark, sf, "events").select("event_id", "user_id", "ts", "value"))
    out = ts_ops.diff_cumsum(ev, s, "value")
    return done(out.drop("user_id", "ts", "value"), s)


@register("safe_ratio", """
SELECT event_id, round(value / nullif(CAST(hour(ts) AS DOUBLE), 0), 6) AS ratio FROM events""")
def q_safe_ratio(spark, sf):
    ev = load(spark, sf, "events")
    return rounded(ev.select("event_id", vf.safe_ratio(F.col("value"), F.hour("ts")).alias("ratio")))


# ----------------------------------------------------------------------------
# sessions (T8, T9, A3, A6)

SESS = f"""
WITH g0 AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS flag FROM events),
g1 AS (SELECT *, CASE WHEN flag = 1 AND lag(flag) OVER ({W_USER}) = 0 THEN 1 ELSE 0 END AS rise FROM g0),
g AS (SELECT event_id, user_id, ts, sum(rise) OVER ({RUNNING}) AS "group" FROM g1),
st AS (SELECT user_id, "group", min(ts) AS Start_Time FROM g GROUP BY 1, 2),
pk AS (SELECT user_id, max(CASE WHEN "group" = 1 THEN epoch_us(Start_Time) END) AS s1,
              (max(epoch_us(Start_Time)) - min(epoch_us(Start_Time))) / nullif(count(*) - 1, 0) AS gap
       FROM st GROUP BY 1),
im AS (SELECT st.user_id, st."group",
              CASE WHEN st."group" = 0 AND pk.s1 IS NOT NULL AND pk.gap IS NOT NULL
                   THEN least(st.Start_Time, make_timestamp(CAST(trunc(pk.s1 - pk.gap) AS BIGINT)))
                   ELSE st.Start_Time END AS Start_Time
       FROM st JOIN pk ON st.user_id = pk.user_id)"""


def _sessions(spark, sf):
    ev, s = series(load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type"))
    ev = ev.withColumn("flag", F.when(F.col("event_type") == "signup", 1).otherwise(0))
    return ts_ops.session_id(ev, s, "flag", "group"), s


@register("session_id", SESS + ' SELECT event_id, user_id, "group" FROM g')
def q_session_id(spark, sf):
    g, s = _sessions(spark, sf)
    return done(g.select("event_id", "user_id", "group", *s.helper_cols()), s)


@register("group_first", SESS + ' SELECT user_id, "group", Start_Time FROM st')
def q_group_first(spark, sf):
    g, s = _sessions(spark, sf)
    return aggregates.group_first(g, ["user_id", "group"], "ts")


@register("mean_gap", SESS + " SELECT user_id, round(gap / 1e6, 6) AS mean_gap_s FROM pk")
def q_mean_gap(spark, sf):
    g, s = _sessions(spark, sf)
    gaps = aggregates.mean_gap(ts_ops.session_starts(g, s.unchunked()), "user_id")
    return rounded(gaps.select("user_id", (F.col("mean_gap_us") / 1e6).alias("mean_gap_s")))


@register("impute_first_start", SESS + ' SELECT user_id, "group", Start_Time FROM im')
def q_impute_first_start(spark, sf):
    g, s = _sessions(spark, sf)
    return ts_ops.impute_first_start(ts_ops.session_starts(g, s.unchunked()), ["user_id"])


@register("session_age", SESS + """
SELECT g.event_id, g."group", CAST(trunc((epoch_us(g.ts) - epoch_us(im.Start_Time)) / 60000000) AS BIGINT)
       AS Start_Time_Delta FROM g JOIN im ON g.user_id = im.user_id AND g."group" = im."group\"""")
def q_session_age(spark, sf):
    g, s = _sessions(spark, sf)
    out = ts_ops.session_age(g, s.unchunked())
    return out.select("event_id", "group", "Start_Time_Delta")


# ----------------------------------------------------------------------------
# labels (T10, T11, T14)

LOOK = """
SELECT event_id, user_id, ts, event_type,
       CAST(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
            RANGE BETWEEN 1 FOLLOWING AND {us} FOLLOWING) AS INTEGER) AS {name}
FROM events"""


def _lookahead(spark, sf, horizons):
    ev, s = series(load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type"))
    return ts_ops.lookahead(ev, s, F.col("event_type") == "error", horizons), s


@register("lookahead_1h", "SELECT event_id, sensor_end_1h FROM (" + LOOK.format(us=3600000000, name="sensor_end_1h") + ") t")
def q_lookahead_1h(spark, sf):
    out, s = _lookahead(spark, sf, {"sensor_end_1h": 3600})
    return out.select("event_id", "sensor_end_1h")


@register("lookahead_2h", "SELECT event_id, sensor_end_2h FROM (" + LOOK.format(us=7200000000, name="sensor_end_2h") + ") t")
def q_lookahead_2h(spark, sf):
    out, s = _lookahead(spark, sf, {"sensor_end_2h": 7200})
    return out.select("event_id", "sensor_end_2h")


@register("label_is_censored", """
WITH n AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us,
       min(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
            RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS na,
       min(CASE WHEN event_type = 'error' THEN epoch_us(ts) END) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
            RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nf FROM events),
r AS (SELECT *, min(CASE WHEN na IS NULL OR na - us > 21600000000 THEN us END) OVER (PARTITION BY user_id ORDER BY us
            RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reach FROM n)
SELECT event_id,
       NOT (event_type = 'error' OR coalesce(nf <= us + 3600000000, false) OR coalesce(reach >= us + 3600000000, false)) AS sensor_end_1h_is_censored,
       NOT (event_type = 'error' OR coalesce(nf <= us + 43200000000, false) OR coalesce(reach >= us + 43200000000, false)) AS sensor_end_12h_is_censored
FROM r""")
def q_label_is_censored(spark, sf):
    ev, s = series(load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type"))
    out = ts_ops.censoring(ev, s, F.col("event_type") == "error", {"sensor_end_1h": 3600, "sensor_end_12h": 43200}, 21600)
    return out.select("event_id", "sensor_end_1h_is_censored", "sensor_end_12h_is_censored")


@register("label_clean_ffill", f"""
WITH a AS (SELECT event_id, user_id, ts, event_type,
       max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
            RANGE BETWEEN 1 FOLLOWING AND 3600000000 FOLLOWING) AS l1,
       max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
            RANGE BETWEEN 1 FOLLOWING AND 7200000000 FOLLOWING) AS l2 FROM events),
b AS (SELECT *, CASE WHEN event_type = 'error' THEN 0 ELSE l1 END AS c1,
             CASE WHEN event_type = 'error' THEN 0 ELSE l2 END AS c2 FROM a)
SELECT event_id, CAST(last_value(c1 IGNORE NULLS) OVER ({RUNNING}) AS INTEGER) AS sensor_end_1h,
       CAST(last_value(c2 IGNORE NULLS) OVER ({RUNNING}) AS INTEGER) AS sensor_end_2h FROM b""")
def q_label_clean_ffill(spark, sf):
    out, s = _lookahead(spark, sf, {"sensor_end_1h": 3600, "sensor_end_2h": 7200})
    out = ts_ops.finish_labels(out, s, ["sensor_end_1h", "sensor_end_2h"], F.col("event_type") == "error")
    return out.select("event_id", "sensor_end_1h", "sensor_end_2h")


@register("any_flag", f"""
SELECT event_id, (event_type_error = 1) OR (event_type_purchase = 1) AS sensor_end
FROM (SELECT event_id, {_flag_sql()} FROM events) t""")
def q_any_flag(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type")
    oh, _ = resample.one_hot(ev, ["event_type"], {"event_type": EVENT_TYPES})
    return oh.select("event_id", vf.any_flag(["event_type_error", "event_type_purchase"]).alias("sensor_end"))


# ----------------------------------------------------------------------------
# flagship: which 5-minute readings of each device precede an end event

DEVICE_LABELS = f"""
WITH b AS (SELECT user_id, {BUCKET5} AS Datetime, event_type, value FROM events),
f AS (SELECT user_id, Datetime, {_flag_sql(agg='max')}, coalesce(sum(value), 0) AS value
      FROM b GROUP BY user_id, Datetime),
l AS (SELECT *,
       max(event_type_error) OVER (PARTITION BY user_id ORDER BY epoch_us(Datetime)
            RANGE BETWEEN 1 FOLLOWING AND 3600000000 FOLLOWING) AS l1,
       max(event_type_error) OVER (PARTITION BY user_id ORDER BY epoch_us(Datetime)
            RANGE BETWEEN 1 FOLLOWING AND 7200000000 FOLLOWING) AS l2 FROM f),
c AS (SELECT *, CASE WHEN event_type_error = 1 THEN 0 ELSE l1 END AS c1,
             CASE WHEN event_type_error = 1 THEN 0 ELSE l2 END AS c2 FROM l)
SELECT user_id, Datetime, {', '.join(f'event_type_{c}' for c in EVENT_TYPES)}, round(value, 6) AS value,
       CAST(hour(Datetime) AS INTEGER) AS Hour, CAST(minute(Datetime) AS INTEGER) AS Minute,
       CAST(month(Datetime) AS INTEGER) AS Month,
       CAST(last_value(c1 IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY Datetime
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS sensor_end_1h,
       CAST(last_value(c2 IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY Datetime
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS sensor_end_2h
FROM c"""


def device_labels_df(ev: DataFrame, chunked: bool | None = None) -> DataFrame:
    """R1 bucket -> R3 one-hot -> R4 flatten per device -> T14 end flag ->
    T10 look-ahead 1 h / 2 h -> T11 clean-up."""
    b = ev.select("user_id", tf.time_bucket("ts", 300).alias("Datetime"), "event_type", "value")
    oh, flags = resample.one_hot(b, ["event_type"], {"event_type": EVENT_TYPES})
    flat = resample.flatten_buckets(oh, ["user_id"], "Datetime", resample.FlattenSpec(flags=flags, sums=["value"]))
    s = Series.of("user_id", "Datetime")
    if CHUNKED if chunked is None else chunked:
        flat, s = with_chunks(flat, s)
    end = F.col("event_type_error") == 1
    out = ts_ops.lookahead(flat, s, end, {"sensor_end_1h": 3600, "sensor_end_2h": 7200})
    out = ts_ops.finish_labels(out, s, ["sensor_end_1h", "sensor_end_2h"], end)
    return done(out, s)


@register("device_labels", DEVICE_LABELS)
def q_device_labels(spark, sf):
    return device_labels_df(load(spark, sf, "events"))


# ----------------------------------------------------------------------------
# split, folds, scaling (M2, M4, M5)

GLOBAL = "ORDER BY ts, event_id"


@register("ordered_split", f"""
SELECT event_id, (row_number() OVER ({GLOBAL}) - 1) >= count(*) OVER () - CAST(ceil(0.25 * count(*) OVER ()) AS BIGINT)
       AS is_test FROM events""")
def q_ordered_split(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "ts")
    return split.ordered_split(ev, Series.of((), "ts", "event_id")).select("event_id", "is_test")


@register("walk_forward_folds", f"""
WITH p AS (SELECT event_id, row_number() OVER ({GLOBAL}) - 1 AS pos, count(*) OVER () AS n FROM events),
q AS (SELECT *, n // 3 AS size FROM p)
SELECT event_id,
       CASE WHEN pos < n - 2 * size THEN 'train' WHEN pos < n - 2 * size + size THEN 'test' END AS fold_0,
       CASE WHEN pos < n - size THEN 'train' WHEN pos < n THEN 'test' END AS fold_1
FROM q""")
def q_walk_forward_folds(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "ts")
    return split.walk_forward_folds(ev, Series.of((), "ts", "event_id"), 2).select("event_id", "fold_0", "fold_1")


LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("standardise", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 "
    f"ELSE stddev_pop({c}) END FROM lineitem), 6) AS {c}" for c in LI_COLS) + " FROM lineitem")
def q_standardise(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LI_COLS)
    return rounded(features.standardise(li, LI_COLS))


# ----------------------------------------------------------------------------
# counts and metrics


@register("value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def q_value_counts(spark, sf):
    return aggregates.value_counts(load(spark, sf, "events"), "event_type")


@register("class_weight", """
SELECT round(CAST(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS DOUBLE)
             / nullif(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 0), 6) AS pos_weight FROM labels""")
def q_class_weight(spark, sf):
    return rounded(aggregates.class_weight(load(spark, sf, "labels"), "quality"))


@register("threshold_predict", """
SELECT event_id, CAST(value / 1000.0 > 0.005 AS INTEGER) AS prediction FROM events""")
def q_threshold_predict(spark, sf):
    from devicelife.operators import model
    ev = load(spark, sf, "events").select("event_id", (F.col("value") / 1000.0).alias("p"))
    return ev.select("event_id", model.threshold_predict(F.col("p"), 0.005).alias("prediction"))


@register("confusion_matrix", """
SELECT CAST(quality AS INTEGER) AS y, CAST(toxic AS INTEGER) AS p, count(*) AS n FROM labels GROUP BY 1, 2""")
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(load(spark, sf, "labels"), "quality", "toxic")


_C = """(SELECT CAST(sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
                CAST(sum(CASE WHEN quality = 0 AND toxic = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
                CAST(sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
                CAST(sum(CASE WHEN quality = 0 AND toxic = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM labels)"""


@register("classification_report", f"""
WITH c AS {_C},
k AS (SELECT coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
             coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
             tp + fn AS s1, tn + fp AS s0, tp + fp + fn + tn AS n, tp + tn AS ok FROM c),
f AS (SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0
      FROM k)
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(coalesce(ok / nullif(n, 0), 0), 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6),
                 CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(coalesce((p0 * s0 + p1 * s1) / nullif(n, 0), 0), 6),
                 round(coalesce((r0 * s0 + r1 * s1) / nullif(n, 0), 0), 6),
                 round(coalesce((f0 * s0 + f1 * s1) / nullif(n, 0), 0), 6), CAST(n AS BIGINT) FROM f""")
def q_classification_report(spark, sf):
    return rounded(metrics.classification_report(load(spark, sf, "labels"), "quality", "toxic"))


@register("fbeta", f"""
WITH c AS {_C},
k AS (SELECT coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r FROM c)
SELECT round(coalesce((1 + 16.0) * p * r / nullif(16.0 * p + r, 0), 0), 6) AS fbeta FROM k""")
def q_fbeta(spark, sf):
    return rounded(metrics.fbeta(load(spark, sf, "labels"), "quality", "toxic", 4.0))


@register("roc_auc", """
WITH s AS (SELECT CAST(toxic AS DOUBLE) AS sc, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS neg FROM labels GROUP BY 1),
c AS (SELECT *, sum(neg) OVER (ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM s)
SELECT round(coalesce(sum(pos * (below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 0), 6) AS roc_auc FROM c""")
def q_roc_auc(spark, sf):
    return rounded(metrics.roc_auc(load(spark, sf, "labels"), "quality", "toxic"))


@register("roc_auc_score", """
WITH s AS (SELECT round(value / 500.0, 3) AS sc, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS neg FROM events GROUP BY 1),
c AS (SELECT *, sum(neg) OVER (ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM s)
SELECT round(coalesce(sum(pos * (below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 0), 6) AS roc_auc FROM c""")
def q_roc_auc_score(spark, sf):
    ev = load(spark, sf, "events").select(F.round(F.col("value") / 500.0, 3).alias("score"),
                                          (F.col("event_type") == "error").cast("int").alias("y"))
    return rounded(metrics.roc_auc(ev, "y", "score"))


CORR_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS Col1, '{b}' AS Col2, round(abs(corr({a}, {b})), 6) AS Correlation FROM lineitem"
    for a in LI_COLS for b in LI_COLS if a != b)


@register("correlation_pairs", CORR_PAIRS_SQL)
def q_correlation_pairs(spark, sf):
    return rounded(metrics.correlation_pairs(load(spark, sf, "lineitem"), LI_COLS))


@register("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS Feature, " + ", ".join(
        ("1.0" if a == b else f"round(abs(corr({a}, {b})), 6)") + f" AS {b}" for b in LI_COLS) + " FROM lineitem"
    for a in LI_COLS))
def q_correlation_matrix(spark, sf):
    return rounded(metrics.correlation_matrix(load(spark, sf, "lineitem"), LI_COLS))


@register("top_importance", """
WITH s AS (SELECT l_returnflag, 'l_quantity' AS Feature, abs(corr(l_quantity, l_extendedprice)) AS Importance
           FROM lineitem GROUP BY 1
           UNION ALL SELECT l_returnflag, 'l_discount', abs(corr(l_discount, l_extendedprice)) FROM lineitem GROUP BY 1
           UNION ALL SELECT l_returnflag, 'l_tax', abs(corr(l_tax, l_extendedprice)) FROM lineitem GROUP BY 1)
SELECT l_returnflag, Feature, round(Importance, 6) AS Importance,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY Importance DESC, Feature) AS rank
FROM s WHERE Importance > 0""")
def q_top_importance(spark, sf):
    li = load(spark, sf, "lineitem")
    feats = ["l_quantity", "l_discount", "l_tax"]
    wide = li.groupBy("l_returnflag").agg(*[F.abs(F.corr(c, "l_extendedprice")).alias(c) for c in feats])
    long = wide.select("l_returnflag", F.inline(F.array(*[
        F.struct(F.lit(c).alias("Feature"), F.col(c).alias("Importance")) for c in feats])))
    return rounded(metrics.importance_table(long, ["l_returnflag"]))
