"""Device report files: several tables stacked in one headerless CSV.

Layout of one file: a file-header section (names row over values row),
then sections that each open with a delimiter row (first cell ``-------``,
other cells are titles), a row of column names, and data rows.

The whole set of files is one CSV scan. The row order inside a file is
rebuilt from ``(_metadata.file_path, _metadata.file_block_start,
monotonically_increasing_id())`` (CSV has no row index). Sections are a
running count of delimiter rows per file; both that count and the "row
after the delimiter" test are chunked scans, so one enormous file is split
across tasks like any hot series. Only the header rows (one per file and
section) are collected, to name the columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from devicelife.operators import scan
from devicelife.operators.filters import drop_blank_rows
from devicelife.series import Series, with_chunks

# Fixed values of the report format.
DELIM = "-------"          # first cell of a row that opens a section
WIDTH = 54                 # cells scanned per row
HEADER_LAST = "End Date"   # last fixed name/value column of the file header

EMPTY = "\u0001"           # stands in for a quoted empty cell while reading
CELLS = [f"column_{i}" for i in range(1, WIDTH + 1)]
ROW_SERIES = Series(("_file",), "_blk", ("_row",))


def report_schema(width: int = WIDTH) -> StructType:
    return StructType([StructField(f"column_{i}", StringType(), True) for i in range(1, width + 1)])


def read_report_rows(spark: SparkSession, paths, width: int = WIDTH) -> DataFrame:
    """All rows of all files as ``width`` string cells plus position columns.

    A quoted empty cell stays ``""`` and a missing cell is null (the CSV
    reader would fold both to null, so empties pass through a sentinel).
    ``""`` quoting inside a cell is an escaped quote. A row with more cells
    fails: one cell more than ``width`` is scanned to see it.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    cells = [f"column_{i}" for i in range(1, width + 1)]
    raw = (spark.read.schema(report_schema(width + 1)).option("header", "false").option("sep", ",")
           .option("quote", '"').option("escape", '"').option("emptyValue", EMPTY)
           .option("mode", "PERMISSIVE").csv(paths))
    over = F.col(f"column_{width + 1}")
    first = F.when(over.isNotNull(), F.raise_error(F.lit(f"a report row has more than {width} cells")).cast("string")).otherwise(F.col(cells[0]))
    raw = raw.withColumn(cells[0], first)
    return raw.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_row"),
        *[F.when(F.col(c) == EMPTY, F.lit("")).otherwise(F.col(c)).alias(c) for c in cells])


def split_sections(df: DataFrame, s: Series, is_start: Column, name: str = "section_id") -> DataFrame:
    """Number sections: a row where ``is_start`` holds opens the next one;
    rows before the first start are section 0."""
    return scan.running_sums(df, s, {name: F.when(is_start, 1).otherwise(0).cast("long")})


def mark_sections(rows: DataFrame, chunked: bool = True) -> DataFrame:
    """Drop spacer rows, add ``section_id`` and ``_is_delim``/``_is_header``."""
    rows = drop_blank_rows(rows, "column_1")
    s = ROW_SERIES
    if chunked:
        rows, s = with_chunks(rows, s)
    is_delim = F.col("column_1") == DELIM
    rows = rows.withColumn("_is_delim", is_delim)
    rows = split_sections(rows, s, F.col("_is_delim"))
    rows = scan.lags(rows, s, {"_after_delim": (F.col("_is_delim"), 1)})
    rows = rows.withColumn("_is_header", F.coalesce(F.col("_after_delim"), F.lit(False)) & (F.col("section_id") > 0))
    return rows.drop("_after_delim", *s.helper_cols())


def file_header(rows: DataFrame, last_fixed: str = HEADER_LAST) -> DataFrame:
    """Unfold each file's header section into ``(file, key, value)``.

    Cells up to ``last_fixed`` pair the names row with the values row; after
    it, each of the two rows holds alternating name, value cells (a null
    name is skipped).
    """
    h = rows.where(F.col("section_id") == 0)
    # the header section is two rows per file: a plain window is cheap here
    rn = F.row_number().over(Window.partitionBy("_file").orderBy("_blk", "_row"))
    h = h.withColumn("_hr", rn).where(F.col("_hr") <= 2)
    arr = F.array(*[F.col(c) for c in CELLS])
    two = h.groupBy("_file").agg(F.max(F.when(F.col("_hr") == 1, arr)).alias("r0"),
                                 F.max(F.when(F.col("_hr") == 2, arr)).alias("r1"))
    end = (F.array_position("r0", F.lit(last_fixed)) - 1).cast("int")   # 0-based index of last fixed
    two = two.withColumn("_end", end)
    cell = two.select("_file", "_end", "r0", "r1", F.posexplode("r0").alias("i", "name"))
    fixed = cell.where(F.col("i") <= F.col("_end")).select(
        "_file", "i", F.lit(0).alias("src"), F.col("name").alias("key"),
        F.element_at("r1", F.col("i") + 1).alias("value"))
    pairs = []
    for src, row in ((1, "r0"), (2, "r1")):
        c2 = two.select("_file", "_end", row, F.posexplode(row).alias("i", "name"))
        pairs.append(c2.where((F.col("i") > F.col("_end")) & ((F.col("i") - F.col("_end") - 1) % 2 == 0)
                              & F.col("name").isNotNull())
                     .select("_file", "i", F.lit(src).alias("src"), F.col("name").alias("key"),
                             F.element_at(row, F.col("i") + 2).alias("value")))
    out = fixed.unionByName(pairs[0]).unionByName(pairs[1])
    return out.select(F.col("_file").alias("file"), "src", "i", "key", "value")


def section_meta(rows: DataFrame) -> DataFrame:
    """Titles of each section: non-null cells of its delimiter row that are
    not the delimiter itself (after trimming). ``(file, section_id, value)``."""
    d = rows.where(F.col("_is_delim"))
    cells = F.array(*[F.col(c) for c in CELLS])
    out = d.select(F.col("_file").alias("file"), "section_id", F.explode(cells).alias("value"))
    return out.where(F.col("value").isNotNull() & (F.trim("value") != DELIM))


def merge_meta(meta: DataFrame, section: str = "section_id", value: str = "value") -> DataFrame:
    """Set union of metadata values per section, sorted (``meta`` array)."""
    return meta.groupBy(section).agg(F.array_sort(F.collect_set(value)).alias("meta"))


def fold_metadata_long(kv: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Per key, the distinct non-null values joined by ``;`` in sorted order;
    keys whose joined text is empty are left out."""
    out = kv.where(F.col(value).isNotNull()).groupBy(key).agg(
        F.concat_ws(";", F.array_sort(F.collect_set(value))).alias("value"))
    return out.where(F.col("value") != "")


def fold_metadata(wide: DataFrame) -> DataFrame:
    """:func:`fold_metadata_long` over every column of a wide table."""
    kv = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
                                         for c in wide.columns])).alias("kv")).select("kv.key", "kv.value")
    return fold_metadata_long(kv)


def union_tables(tables: list[DataFrame], dedup: bool = False) -> DataFrame:
    """Concatenate same-shaped tables (by name; a layout mismatch raises),
    optionally dropping exact duplicate rows."""
    out = tables[0]
    for t in tables[1:]:
        if t.columns != out.columns:
            raise ValueError(f"table layouts differ: {out.columns} vs {t.columns}")
        out = out.unionByName(t)
    return out.distinct() if dedup else out


def header_names(rows: DataFrame) -> dict[int, list[tuple[int, str]]]:
    """Column names of each section, taken from the first file that has it.

    One small collect, a row per section however many files there are. Raises
    when two files name the same section's columns differently, naming both.
    """
    agreed = header_agreement(rows).collect()
    for r in agreed:
        if r["other_file"] is not None:
            raise ValueError(f"section {r['section_id']}: column names differ between files {r['file']} and {r['other_file']}")
    return {r["section_id"]: [(i, n) for i, n in enumerate(r["names"]) if n is not None]
            for r in sorted(agreed, key=lambda r: r["section_id"])}


def header_agreement(rows: DataFrame) -> DataFrame:
    """Per section the names of the first file that has it and, where some file names the columns
    differently, one such file: ``(section_id, names, file, n_files, other_file)``.

    Minima combine before the shuffle: the least and the greatest image of a header are equal
    exactly when all headers of the section are.
    """
    names = F.array(*[F.col(c) for c in CELLS])
    image = F.to_json(F.struct(names.alias("n")), {"ignoreNullFields": "false"})
    hdr = rows.where(F.col("_is_header")).select("section_id", "_file", names.alias("names"), image.alias("_image"))
    per = hdr.groupBy("section_id").agg(
        F.min(F.struct("_file", "names", "_image")).alias("_first"), F.count_distinct("_file").alias("n_files"),
        F.min(F.struct("_image", "_file")).alias("_low"), F.max(F.struct("_image", "_file")).alias("_high"))
    first = F.col("_first._image")
    other = (F.when(F.col("_low._image") != first, F.col("_low._file"))
             .when(F.col("_high._image") != first, F.col("_high._file")))
    return per.select("section_id", F.col("_first.names").alias("names"), F.col("_first._file").alias("file"),
                      "n_files", other.alias("other_file"))


def section_table(rows: DataFrame, section: int, names: list[tuple[int, str]], dedup: bool = True,
                  devices: DataFrame | None = None, device_col: str = "device") -> DataFrame:
    """Data rows of one section from all files, named columns only.

    ``devices`` (``_file``, ``device_col``; one row per file) tags each row
    with its device, so overlapping exports of one device still dedup
    while different devices stay apart.
    """
    body = rows.where((F.col("section_id") == section) & ~F.col("_is_delim") & ~F.col("_is_header"))
    cols = [F.col(CELLS[i]).alias(n) for i, n in names]
    if devices is not None:
        body = body.join(devices, "_file", "left")
        cols = [F.col(device_col)] + cols
    out = body.select(*cols)
    return out.distinct() if dedup else out


@dataclass
class Report:
    """Tables of a set of report files: ``tables[i]`` is section ``i + 1``."""
    tables: list[DataFrame]
    table_meta: DataFrame     # (section_id, meta array) over all files
    file_meta: DataFrame      # (key, value) folded over all files
    file_header: DataFrame    # (file, src, i, key, value) per file
    rows: DataFrame           # marked rows, for inspection

    def table(self, i: int) -> DataFrame:
        return self.tables[i]


def read_report(spark: SparkSession, paths, width: int = WIDTH, dedup: bool = True,
                chunked: bool = True, device_key: str | None = None, device_col: str = "device") -> Report:
    """Read report files into their tables.

    ``device_key`` names a file-header field (a serial number, say) whose
    value becomes a ``device_col`` column on every table row.
    """
    rows = mark_sections(read_report_rows(spark, paths, width), chunked)
    names = header_names(rows)
    hdr = file_header(rows)
    devices = None
    if device_key is not None:
        devices = hdr.where(F.col("key") == device_key).groupBy(F.col("file").alias("_file")).agg(
            F.min("value").alias(device_col))
    tables = [section_table(rows, sec, names[sec], dedup, devices, device_col) for sec in sorted(names)]
    titles = section_meta(rows)
    table_meta = merge_meta(titles.where(F.col("section_id") > 0))
    return Report(tables, table_meta, fold_metadata_long(hdr), hdr, rows)


def describe_report(report: Report) -> DataFrame:
    """Catalogue of the report: one row per table and column with its type,
    non-null count and approximate distinct count, plus the table titles."""
    spark = report.file_meta.sparkSession
    parts = []
    for i, t in enumerate(report.tables):
        cols = t.columns
        stats = t.agg(*[x for j, c in enumerate(cols) for x in (
            F.count(F.col(c)).alias(f"n{j}"), F.approx_count_distinct(F.col(c)).alias(f"d{j}"))])
        items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t.schema[c].dataType.simpleString()).alias(
            "data_type"), F.col(f"n{j}").alias("non_null"), F.col(f"d{j}").alias("approx_distinct"))
            for j, c in enumerate(cols)])
        parts.append(stats.select(F.lit(i).alias("table_index"), F.inline(items)))
    if not parts:
        return spark.createDataFrame([], "table_index int, column_name string, data_type string, "
                                         "non_null long, approx_distinct long, meta array<string>")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    meta = report.table_meta.select((F.col("section_id") - 1).cast("int").alias("table_index"), "meta")
    return out.join(meta, "table_index", "left")
