"""Series description: which columns identify a series and order its rows.

Every time-series operator takes a :class:`Series`. ``keys`` partition the
data into independent series (device, file, user), ``ts`` orders them and
``tb`` breaks ties so that lags and fills are deterministic.

``chunk`` names an optional column that splits each series into ordered
chunks. It is added by :func:`with_chunks`, which cuts a hot series (one
device holding a third of all rows) into many contiguous pieces. The
operators in :mod:`devicelife.operators.scan` then run their windows per
chunk and stitch the pieces together with small per-chunk summaries, so no
task ever holds a whole series.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DateType, StringType, TimestampNTZType, TimestampType

from devicelife.session import cut_lineage

CHUNK_COL = "_chunk"
_CUT_COLS = ("_axis", "_skip", "_low", "_width")
#: A chunk has at most this many times the wanted rows.
CHUNK_SLACK = 4
#: Up to so many heavy pieces (counted first; some 60 bytes each) are broadcast to the rows.
BROADCAST_PIECES = 10_000
_DEFAULTS = {"bigint": 0, "int": 0, "smallint": 0, "tinyint": 0, "double": 0.0, "float": 0.0,
             "string": "", "boolean": False}
DEFAULT_CHUNK_ROWS = 2_000_000


@dataclass(frozen=True)
class Series:
    keys: tuple[str, ...] = ()
    ts: str = "Datetime"
    tb: tuple[str, ...] = ()
    chunk: str | None = None
    surrogates: tuple[str, ...] = ()   # non-null stand-ins for keys, set when chunked

    @staticmethod
    def of(keys=(), ts="Datetime", tb=()) -> "Series":
        as_tuple = lambda v: (v,) if isinstance(v, str) else tuple(v)
        return Series(as_tuple(keys), ts, as_tuple(tb))

    # -- ordering -------------------------------------------------------
    def order_cols(self) -> list[str]:
        return [self.ts, *self.tb]

    def order(self) -> list[Column]:
        return [F.col(c).asc_nulls_first() for c in self.order_cols()]

    def order_desc(self) -> list[Column]:
        return [F.col(c).desc_nulls_last() for c in self.order_cols()]

    # -- windows --------------------------------------------------------
    def part_cols(self) -> list[str]:
        return [*self.surrogates, self.chunk] if self.chunk else list(self.keys)

    def key_cols(self) -> list[str]:
        return list(self.surrogates) if self.chunk else list(self.keys)

    def helper_cols(self) -> list[str]:
        """Columns added by :func:`with_chunks` (drop them from results)."""
        return [self.chunk, *self.surrogates] if self.chunk else []

    def window(self):
        """Ordered window of one series (or of one chunk when chunked)."""
        return Window.partitionBy(*self.part_cols()).orderBy(*self.order())

    def running(self):
        return self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def whole(self):
        return Window.partitionBy(*self.part_cols())

    def key_window(self):
        """Window over whole series, ignoring chunks (for small tables)."""
        return Window.partitionBy(*self.keys)

    def unchunked(self) -> "Series":
        return replace(self, chunk=None, surrogates=())


def ordinal(df: DataFrame, col: str) -> Column:
    """A numeric image of an order column: epoch microseconds for times,
    days for dates, the value itself for numbers."""
    t = df.schema[col].dataType
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if isinstance(t, DateType):
        return F.unix_date(F.col(col)).cast("double")
    return F.col(col).cast("double")


def with_chunks(df: DataFrame, s: Series, rows_per_chunk: int | None = None) -> tuple[DataFrame, Series]:
    """Tag rows with ``_chunk``: contiguous pieces of each series in order.

    A chunk holds about ``rows_per_chunk`` rows and at most ``CHUNK_SLACK``
    times as many, unless all its rows have the same order columns. It is
    named by a path of slice numbers (an array, ordered like the rows): a
    piece with too many rows is cut into equal slices of the first order
    column that differs in it, between that column's own least and greatest
    value there, and slices with too many rows are cut again. So a stray
    1970 date only costs another cut, a burst on one timestamp is cut by the
    tie-breaks, and null times are a slice of their own that is cut likewise.

    The path is a pure function of the row and of minima, maxima and counts
    (no sampling, no partition ids), so the same row gets the same chunk in
    every branch of the plan and on every task retry. The piece table (a row
    per series or heavy slice) is computed here, one job a level; series
    short enough are one chunk and cost no join. If all are, the frame and the
    series come back as they are: windows over whole series need no summaries
    to be stitched.
    """
    if rows_per_chunk is None:
        rows_per_chunk = int(df.sparkSession.conf.get("spark.devicelife.chunkRows", str(DEFAULT_CHUNK_ROWS)))
    # Non-null stand-ins for the keys: chunk windows partition by them and
    # the per-chunk summaries join back on them with a plain equi-join, whose
    # required distribution the windows' shuffle already provides.
    out, sur = df, []
    for i, k in enumerate(s.keys):
        t = df.schema[k].dataType.simpleString()
        v = F.coalesce(F.col(k), F.lit(_DEFAULTS[t]).cast(t)) if t in _DEFAULTS else \
            F.coalesce(F.col(k).cast("string"), F.lit(""))
        out = out.withColumn(f"_sk{i}", v).withColumn(f"_sn{i}", F.isnull(F.col(k)))
        sur += [f"_sk{i}", f"_sn{i}"]
    out = out.withColumn(CHUNK_COL, F.array(F.lit(0).cast("long")))
    part = [*sur, CHUNK_COL]
    images = [partial(_image, df, c) for c in s.order_cols()]
    heavy = _heavy_pieces(out, s, part, images, rows_per_chunk)
    if s.keys and heavy.isEmpty():
        return df, s.unchunked()
    first = True
    while not heavy.isEmpty():
        if first and not sur:                       # one series without keys: its one row is constants
            at = heavy.first()
            cut = out.select("*", *[F.lit(at[c]).alias(c) for c in _CUT_COLS])
        else:
            small = heavy.limit(BROADCAST_PIECES + 1).count() <= BROADCAST_PIECES
            cut = out.join(F.broadcast(heavy) if small else heavy, part, "left")
        axis = F.lit(None).cast("double")
        for i, image in reversed(list(enumerate(images))):
            axis = F.when(F.col("_axis") == i, image(F.col("_skip"))).otherwise(axis)
        # nulls sort first: slice -1
        piece = F.coalesce(F.floor((axis - F.col("_low")) / F.col("_width")).cast("long"), F.lit(-1).cast("long"))
        path = F.concat(F.col(CHUNK_COL), F.array(F.when(F.col("_axis").isNull(), F.lit(0).cast("long")).otherwise(piece)))
        cut = cut.withColumn("_again", F.col("_axis").isNotNull()).withColumn(CHUNK_COL, path).drop(*_CUT_COLS)
        heavy = _heavy_pieces(cut.where("_again"), s, part, images, rows_per_chunk)
        out, first = cut.select(*df.columns, *part), False
    return out, replace(s, chunk=CHUNK_COL, surrogates=tuple(sur))


def _image(df: DataFrame, col: str, skip: Column, of: Column | None = None) -> Column:
    """A finite number that never decreases in the order of ``col`` (null for null); of texts that
    share their first ``skip`` bytes, the six bytes that follow. ``of`` is read instead of the column."""
    t = df.schema[col].dataType
    if _is_text(df, col):
        rest = F.hex(F.col(col).cast("binary") if of is None else of)
        head = F.rpad(F.substr(rest, skip * 2 + 1, F.lit(12)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(t, BooleanType):
        return F.col(col).cast("int").cast("double")
    o = ordinal(df, col)
    return F.when(o.isNotNull(), F.greatest(F.least(o, F.lit(1e300)), F.lit(-1e300)))


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (StringType, BinaryType))


def _shared_bytes(a: str, z: str) -> Column:
    """How many first bytes two binary columns share."""
    at = f"hex(substring({a}, k, 1)) <> hex(substring({z}, k, 1))"
    both = f"least(length({a}), length({z}))"
    first = f"array_min(filter(if({both} > 0, sequence(1, {both}), cast(array() as array<int>)), k -> {at}))"
    return F.expr(f"coalesce({first} - 1, {both}, 0)")


def _heavy_pieces(rows: DataFrame, s: Series, part: list[str], images: list, rows_per_chunk: int) -> DataFrame:
    """The pieces (``part``) with too many rows that can be cut: the order column to cut by, where the
    cuts start and how wide a slice is. A row per heavy piece, checkpointed."""
    cols = s.order_cols()
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (c, image) in enumerate(zip(cols, images)):
        v = F.col(c).cast("binary") if _is_text(rows, c) else image(F.lit(0))
        aggs += [F.count(c).alias(f"_n{i}"), F.min(v).alias(f"_a{i}"), F.max(v).alias(f"_z{i}"),
                 F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(f"_e{i}")]
    stats = rows.groupBy(*part).agg(*aggs).where(F.col("_n") > CHUNK_SLACK * rows_per_chunk)
    # texts become numbers once it is known where they begin to differ in the piece
    for i, (c, image) in enumerate(zip(cols, images)):
        stats = stats.withColumn(f"_s{i}", _shared_bytes(f"_a{i}", f"_z{i}") if _is_text(rows, c) else F.lit(0))
        if _is_text(rows, c):
            stats = stats.withColumns({f"_{x}{i}": image(F.col(f"_s{i}"), F.col(f"_{x}{i}")) for x in "az"})
    # the first order column that differs inside the piece; a later one would not follow the order
    axis = skip = low = high = F.lit(None)
    for i in reversed(range(len(cols))):
        same = F.col(f"_e{i}") & ((F.col(f"_n{i}") == 0) | (F.col(f"_n{i}") == F.col("_n")))
        axis = F.when(same, axis).otherwise(F.lit(i))
        skip = F.when(same, skip).otherwise(F.col(f"_s{i}"))
        low = F.when(same, low).otherwise(F.col(f"_a{i}"))
        high = F.when(same, high).otherwise(F.struct(F.col(f"_z{i}").alias("z"), (F.col(f"_n{i}") < F.col("_n")).alias("nulls")))
    found = stats.select(*part, "_n", axis.cast("int").alias("_axis"), skip.cast("int").alias("_skip"), low.cast("double").alias("_low"), high.alias("_high"))
    found = found.where(F.col("_axis").isNotNull() & ((F.col("_low") < F.col("_high.z")) | F.col("_high.nulls")))
    width = F.greatest((F.col("_high.z") - F.col("_low")) * (F.lit(float(rows_per_chunk)) / F.col("_n")), F.lit(1e-300))
    width = F.when(F.col("_low") < F.col("_high.z"), width).otherwise(F.lit(1.0))
    return cut_lineage(found.select(*part, "_axis", "_skip", "_low", width.alias("_width")))


def null_safe_join(left: DataFrame, right: DataFrame, cols: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``cols`` where null keys match null keys (series keys may be null)."""
    r = right
    renamed = {}
    for c in cols:
        renamed[c] = f"__r_{c}"
        r = r.withColumnRenamed(c, renamed[c])
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(r[renamed[c]])
        cond = e if cond is None else cond & e
    if not cols:
        raise ValueError("null_safe_join needs at least one key column")
    if all(not left.schema[c].nullable and not right.schema[c].nullable for c in cols):
        return left.join(right, on=list(cols), how=how)   # plain keys: no null handling needed
    return left.join(r, cond, how).drop(*renamed.values())


def attach_aggregates(df: DataFrame, agg: DataFrame, keys, how: str = "left") -> DataFrame:
    """Attach per-key aggregate columns to rows.

    With keys it is a null-safe equi-join. Without keys ``agg`` is a single
    row and each of its columns enters as a scalar subquery: computed once,
    no join at all.
    """
    keys = list(keys)
    if keys:
        return null_safe_join(df, agg, keys, how)
    return df.select("*", *[agg.select(c).scalar().alias(c) for c in agg.columns])
