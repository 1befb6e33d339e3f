"""Embedding near-duplicates by collision counting over one-dimensional projections.

Vectors are scaled to length one and projected on many random directions. A
pair at cosine ``c`` has projections that differ by normal amounts of spread
``sigma = sqrt(2 - 2 c)``, so the law of its collision count is known: with a
window of two sigma around a projection it collides in each with probability
0.954. ``needed_collisions`` is the largest count that a pair at the limit
still reaches with probability ``recall``.

* Sorted projections deal the vectors out: a part with too many vectors is
  cut along its next projection where the fewest windows (half a sigma to
  either side) reach over, near the median if all are alike, and a vector
  whose window reaches over the cut goes to both sides. Four such
  dealings use directions of their own; a pair parts in all of them with
  probability below 0.001 at a few thousand parts of 2,048 vectors.
* Inside a part the collisions of every pair are counted, a few projections
  at a time over the pairs that can still pass; pairs that pass are verified
  by their cosine in double precision.
* Links never become rows: a part gives one row per vector with its number
  of links and edges of a spanning forest. A pair that meets in several
  parts counts in the first of them only, which both vectors' part lists
  tell. Parts that no projection can thin out (near copies of one vector)
  are compared in blocks of at most ``part_rows`` by ``part_rows``.
* Groups are the connected components of the forests' edges.

Equal vectors are one class: copies are counted, not compared.

Edge cases: vectors that are null, empty or zero, or hold null or non-finite
components link with nothing (no links, their own component); vectors of
different lengths never link; rows with equal or null ids are rows of their
own (a null id is kept only in a component that has no other id); extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StructField, StructType

from .common import cut
from .graph import components

COUNTED = 32         # projections whose collisions are counted
DEALINGS = 4
LEVELS = 24          # cuts on the way to a part, at most
STRIP = 128          # rows compared with a block at a time; bounds a task's memory


def needed_collisions(projections: int, window: float, recall: float) -> int:
    """Largest count that a pair of projection spread one reaches with probability ``recall``."""
    p = erf(window / sqrt(2))
    tail = 0.0
    for c in range(projections, -1, -1):
        tail += comb(projections, c) * p ** c * (1 - p) ** (projections - c)
        if tail >= recall:
            return c
    return 0


def directions(length: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, length]).standard_normal((length, count))


def unit_rows(values: list) -> np.ndarray:
    """Vectors of one length scaled to length one, in double precision."""
    x = np.array(values, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)          # no overflow or underflow of squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _projected(classes: DataFrame, seed: int) -> DataFrame:
    """One row per class and dealing: _dealing, _length, _node (1), _class and its projections by level."""
    schema = StructType([StructField("_dealing", IntegerType()), StructField("_length", IntegerType()), StructField("_node", LongType()),
                         StructField("_class", LongType()), StructField("_p", ArrayType(FloatType()))])

    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            sizes = np.array([len(v) for v in vectors.to_pylist()])
            for length in np.unique(sizes):
                at = np.flatnonzero(sizes == length)
                x = unit_rows(vectors.take(pa.array(at)).to_pylist())
                p = (x @ directions(int(length), DEALINGS * LEVELS, seed)).astype(np.float32)
                for k in range(DEALINGS):
                    part = np.ascontiguousarray(p[:, k * LEVELS:(k + 1) * LEVELS])
                    offsets = pa.array(np.arange(0, part.size + 1, LEVELS, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k] * len(at), pa.int32()), pa.array([int(length)] * len(at), pa.int32()),
                         pa.array([1] * len(at), pa.int64()), ids.take(pa.array(at)),
                         pa.ListArray.from_arrays(offsets, pa.array(part.reshape(-1)))], names=schema.fieldNames())

    return classes.select("_class", "_v").mapInArrow(run, schema)


STEPS = [k / 20 for k in range(1, 20)]


def _cut(q: Column, i: Column, window: float) -> Column:
    """The cut between quantiles i and i + 1: quantiles that its window holds, distance from the middle, place."""
    at = (F.get(q, i) + F.get(q, i + 1)) / 2
    return F.struct(F.size(F.filter(q, lambda v: F.abs(v - at) <= window)).alias("over"), F.abs(i - len(STEPS) / 2 + 0.5).alias("aside"), at.alias("at"))


def _dealt(projected: DataFrame, part_rows: int, window: float) -> DataFrame:
    """(_part, _class): the parts that every class is dealt to."""
    key = ["_dealing", "_length", "_node"]
    open_, done = cut(projected), None
    for level in range(LEVELS):
        p = F.element_at("_p", level + 1).cast("double")
        counts = open_.groupBy(*key).agg(F.count("*").alias("_n"), F.percentile_approx(p, STEPS, 1000).alias("_q")).filter(F.col("_n") > part_rows)
        # of the cuts between neighbouring quantiles the one whose window the fewest rows reach over, then the most even one
        best = F.array_min(F.transform(F.sequence(F.lit(3), F.lit(len(STEPS) - 4)), lambda i: _cut(F.col("_q"), i, window)))
        # a cut that many windows reach over separates little: such a part is compared in blocks
        heavy = cut(counts.select(*key, best.alias("_best")).filter(F.col("_best.over") <= len(STEPS) // 4).select(*key, F.col("_best.at").alias("_cut")))
        if heavy.isEmpty():
            break
        settled = open_.join(heavy, key, "left_anti")
        done = settled if done is None else done.unionByName(settled)
        sides = F.array_compact(F.array(F.when(p <= F.col("_cut") + window, F.col("_node") * 2),
                                        F.when(p > F.col("_cut") - window, F.col("_node") * 2 + 1)))
        moved = open_.join(heavy, key).withColumn("_side", sides).withColumn("_node", F.explode("_side"))
        open_ = cut(moved.select(*open_.columns))
    all_ = open_ if done is None else done.unionByName(open_)
    part = (F.col("_length").cast("long") * DEALINGS + F.col("_dealing")) * (1 << (LEVELS + 1)) + F.col("_node")
    return all_.select(part.alias("_part"), "_class")


def count_collisions(a: np.ndarray, b: np.ndarray, window: float, needed: int, upper: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) that collide in at least ``needed`` projections (columns). ``upper``: b is a, first < second."""
    m = a.shape[1]
    first = min(m, m - needed + 6)
    rows, cols = [], []
    for lo in range(0, len(a), 512):
        miss = np.zeros((len(a[lo:lo + 512]), len(b)), dtype=np.uint8)
        for k in range(first):
            miss += np.abs(a[lo:lo + 512, k, None] - b[None, :, k]) > window
        i, j = np.nonzero(miss <= m - needed)
        i += lo
        if upper:
            i, j = i[i < j], j[i < j]
        rows.append(i)
        cols.append(j)
    i, j = np.concatenate(rows), np.concatenate(cols)
    keep = []
    for lo in range(0, len(i), 1 << 16):                # the pairs that are left, over all projections
        x, y = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
        keep.append((np.abs(a[x] - b[y]) <= window).sum(axis=1) >= needed)
    ok = np.concatenate(keep) if keep else np.zeros(0, dtype=bool)
    return i[ok], j[ok]


def _earlier_parts(part: int, lists_a: list, lists_b: list) -> tuple[np.ndarray, np.ndarray]:
    """For rows of a and of b which parts of smaller number than ``part`` they are in, of those that
    rows of both are in: a pair met before if the product of its two rows is not 0."""
    earlier = sorted({int(p) for parts in lists_a for p in parts if p < part} & {int(p) for parts in lists_b for p in parts if p < part})
    number = {p: k for k, p in enumerate(earlier)}

    def member(lists):
        out = np.zeros((len(lists), len(earlier)), dtype=np.float32)
        for r, parts in enumerate(lists):
            for p in parts:
                k = number.get(int(p))
                if k is not None:
                    out[r, k] = 1
        return out

    return member(lists_a), member(lists_b)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row that links (i, j) lead to."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = low[low]
        if (low == before).all():
            return low


def _links(dealt: DataFrame, classes: DataFrame, similarity: float, part_rows: int, recall: float, seed: int) -> DataFrame:
    """(_class, _links: rows linked in other classes, _to: a class of the same local component), of every class with links."""
    lists = dealt.groupBy("_class").agg(F.sort_array(F.collect_set("_part")).alias("_parts"))      # a few per dealing
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    rows = classes.select("_class", "_rows", "_v").join(lists, "_class").withColumn("_part", F.explode("_parts"))
    blocks = F.ceil(F.col("_n") / part_rows).cast("int")
    rows = rows.join(sizes.filter("_n > 1"), "_part").withColumn("_blocks", blocks)
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_class", "_part"), F.col("_blocks").cast("long")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.select("_part", F.least("_block", "_other").alias("_one"), F.greatest("_block", "_other").alias("_two"), "_block",
                       "_class", "_rows", "_v", "_parts")
    schema = StructType([StructField("_class", LongType()), StructField("_links", LongType()), StructField("_to", LongType())])
    sigma = sqrt(2 - 2 * similarity)
    needed = needed_collisions(COUNTED, 2.0, recall)

    def run(key, g):
        part, one, two = (int(k) for k in key)
        g = g.sort_values("_class", kind="stable").reset_index(drop=True)
        a, b = np.flatnonzero(g["_block"] == one), np.flatnonzero(g["_block"] == two)
        none = pd.DataFrame({"_class": pd.Series(dtype="int64"), "_links": pd.Series(dtype="int64"), "_to": pd.Series(dtype="int64")})
        if not len(a) or not len(b):
            return none
        x = unit_rows(g["_v"].tolist())
        p = (x @ directions(x.shape[1], COUNTED, seed + 1)).astype(np.float32)
        # the slack covers float32 rounding
        lists = g["_parts"].tolist()
        earlier_a, earlier_b = _earlier_parts(part, [lists[r] for r in a], [lists[r] for r in b])
        n, name = g["_rows"].to_numpy(), g["_class"].to_numpy()
        count, low = np.zeros(len(g), dtype=np.int64), np.arange(len(g))
        # strips of rows against the block: near copies of one vector make every pair a candidate
        for s in range(0, len(a), STRIP):
            top = a[s:s + STRIP]
            after = np.flatnonzero(b > top[0]) if one == two else np.arange(len(b))
            i, j = count_collisions(p[top], p[b[after]], 2.0 * sigma + 1e-4, needed, False)
            j = after[j]
            if one == two:
                i, j = i[top[i] < b[j]], j[top[i] < b[j]]
            if not len(i):
                continue
            keep = np.concatenate([np.einsum("ij,ij->i", x[top[i[k:k + 16384]]], x[b[j[k:k + 16384]]]) for k in range(0, len(i), 16384)]) >= similarity
            i, j = i[keep], j[keep]
            fresh = ~(earlier_a[s:s + STRIP] @ earlier_b.T > 0.5)[i, j]
            i, j = top[i[fresh]], b[j[fresh]]
            np.add.at(count, i, n[j])
            np.add.at(count, j, n[i])
            low = _forest(len(g), low[i], low[j])[low]
        at = np.flatnonzero(count)
        return pd.DataFrame({"_class": name[at], "_links": count[at], "_to": name[low[at]]})

    return rows.groupBy("_part", "_one", "_two").applyInPandas(run, schema)


def link(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", similarity: float = 0.95, part_rows: int = 2048,
         recall: float = 0.9999, seed: int = 13) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id (smallest id), kept.

    ``recall``: with this probability the count lets a pair at the limit pass."""
    v = F.col("_v")
    whole = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf"))) & F.exists(v, lambda e: e != 0)
    # a repeated id is a row of its own; the key stands for the row
    src = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v"))
    src = src.withColumn("_fine", F.coalesce(whole, F.lit(False)))
    classes = cut(src.filter("_fine").groupBy("_v").agg(F.min("_id").alias("_rep"), F.count("*").alias("_rows"))
                  .withColumn("_class", F.monotonically_increasing_id()))
    window = 0.5 * sqrt(2 - 2 * similarity)
    found = cut(_links(cut(_dealt(_projected(classes, seed), part_rows, window)), classes, similarity, part_rows, recall, seed))
    counts = found.groupBy("_class").agg(F.sum("_links").alias("_links"))
    comp = components(found.select(F.col("_class").alias("a"), F.col("_to").alias("b")))
    named = classes.select("_class", "_v", "_rep", "_rows").join(counts, "_class", "left").join(
        comp.withColumnRenamed("node", "_class"), "_class", "left")
    named = named.withColumn("_comp", F.coalesce("component", "_class"))
    low = named.groupBy("_comp").agg(F.min("_rep").alias("_low"))
    named = named.join(low, "_comp").select(
        F.col("_v").alias("_w"), "_low", (F.coalesce("_links", F.lit(0)) + F.col("_rows") - 1).alias("_n"))
    out = src.join(named, F.col("_fine") & (F.col("_v") == F.col("_w")), "left")
    component = F.when(F.col("_fine"), F.col("_low")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias(id_col), F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("_id").eqNullSafe(component).alias("kept"))
