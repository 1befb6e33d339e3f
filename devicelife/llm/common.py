"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devicelife.session import ensure_checkpoint_dir

#: White space as the contracts define it: U+0020 and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per Spark context)."""
    sc = spark.sparkContext
    if getattr(sc, "_devicelife_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="devicelife-")) / "devicelife.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._devicelife_shipped = True


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: later steps re-read it, and a
    lost executor costs a re-read, not a recomputation of what came before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: A table of at most so many rows (a few MB of keys) is joined by broadcast, once its rows are counted.
FEW = 20_000


def counted(df: DataFrame, rows: int = 20_000) -> tuple[DataFrame, int]:
    """:func:`cut`, and the number of rows. The checkpoint is read by tasks of about ``rows`` rows, one a core at
    least: a small table leaves a shuffle into many partitions in as many pieces, and each of them would make
    a task and the files of a map output in every step that follows."""
    done, cores = cut(df), max(1, df.sparkSession.sparkContext.defaultParallelism)
    n = done.coalesce(cores).count()
    return done.coalesce(max(cores, -(-n // rows))), n


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, elementwise (wraps modulo 2**64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as doubles in (0, 1)."""
    return ((x >> U64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def slabs(texts: list[str], chars: int = 400_000):
    """Index ranges of consecutive texts with about ``chars`` characters each
    (one longer text makes a slab alone), so that numpy work arrays stay bounded."""
    lo = n = 0
    for i, t in enumerate(texts):
        if n and n + len(t) > chars:
            yield lo, i
            lo, n = i, 0
        n += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by one line feed, and where each text starts
    (with the total length as last entry)."""
    cp = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return cp, starts


_POW = None


def powers(n: int) -> np.ndarray:
    """Powers of a fixed odd multiplier modulo 2**64 (grown on demand, kept per process)."""
    global _POW
    if _POW is None or len(_POW) < n:
        m = max(4096, 1 << (int(n) - 1).bit_length())
        p = np.full(m, GOLDEN | U64(1), dtype=U64)
        p[0] = 1
        _POW = np.multiply.accumulate(p)
    return _POW


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[starts[i]:ends[i]]`` for sorted, disjoint, non-empty runs."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    lengths = ends - starts
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    within = np.arange(total, dtype=np.int64) - np.repeat(first, lengths)
    at = within + np.repeat(starts, lengths)
    terms = mix64(values[at].astype(U64) + GOLDEN) * powers(int(lengths.max()))[within]
    return mix64(np.add.reduceat(terms, first) ^ mix64(lengths.astype(U64)))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[0::2], edge[1::2]


def with_columns(batch: pa.RecordBatch, new: dict, schema: pa.Schema, drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    """The batch's columns (without ``drop``) followed by new ones, as ``schema`` orders them."""
    arrays = []
    for f in schema:
        arrays.append(pa.array(new[f.name], type=f.type) if f.name in new else batch.column(batch.schema.get_field_index(f.name)).cast(f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, max_rows: int, id_col: str = "doc_id",
                    text_col: str = "text", keep: Column | None = None) -> tuple[DataFrame, dict]:
    """Texts of at most about ``max_rows`` labelled rows, an equal number of each label value (chosen by
    the hash of the id), as (_label, _text); and how many rows each value has in all.

    The chosen ids (``max_rows`` of them) are broadcast to the scan of the texts. A null label
    teaches nothing; of an id's several labels the largest counts.
    """
    known = labels.groupBy(id_col).agg(F.max(label).alias("_label")).filter(F.col("_label").isNotNull() & F.col(id_col).isNotNull())
    if keep is not None:
        known = known.filter(keep)
    counts = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}
    if not counts:
        return cut(known.select("_label", F.lit("").alias("_text"))), {}
    each = max(1, max_rows // len(counts))
    million = F.lit(1_000_000)
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(np.ceil(1e6 * min(1.0, each / n)))))])
    chosen = known.filter(F.pmod(F.xxhash64(id_col, F.lit(3)), million) < F.element_at(share, F.col("_label")))
    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return cut(texts.join(F.broadcast(chosen), id_col).select("_label", "_text").repartition(16)), counts


def words_of(cp: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the runs of ``inside`` and the text each belongs to."""
    s, e = runs(inside)
    return s, e, np.searchsorted(starts, s, side="right") - 1


_LOWER = _ALNUM = None


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code point (one to one) and whether it is a letter or digit, by code point."""
    global _LOWER, _ALNUM
    if _LOWER is None:
        lower, alnum = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, dtype=bool)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalnum():
                alnum[c] = True
                low = ch.lower()
                if len(low) == 1:
                    lower[c] = ord(low)
        _LOWER, _ALNUM = lower, alnum
    return _LOWER, _ALNUM
