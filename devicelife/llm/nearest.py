"""Approximate nearest neighbours: stable projections, kd-tree, chi-square stopping.

Vectors are projected to ``dims`` dimensions with Gaussian (2-stable)
directions: the squared projected distance of two vectors over their squared
distance follows a chi-square law with ``dims`` degrees of freedom. A
kd-tree over the projections (its splits fitted on a bounded sample) deals
*all* vectors into cells; a cell's box bounds the projected distance to
anything inside it.

A query takes its projected neighbours in growing order, cell by cell: its
own cell, then the next three, twelve, 48 and so on, always in the order of the projected distance to the cell's box. What a round finds
tightens the query's k-th distance d for the next. A query stops when the
next cell lies at a projected distance r with ``chi2(r^2 / d^2) >= stop``: a
vector nearer than d would show such a projected distance with probability
below ``1 - stop``. Inside a cell vectors come in the order of their own
projected distance under the same test. Every vector taken is verified by its
Euclidean distance in double precision. Distances of the test have a slack
for rounding, so exact copies (d = 0) meet.

Plan: one round is one join of the queries still going with the vectors of
their next cells (boxes of at most ``max_cells`` cells are broadcast), in
blocks of about ``block_rows`` vectors by ``block_queries`` queries; only the
k best of a block leave it. The rounds are the logarithm of the cells.

Edge cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id and vectors of another
length than most; equal distances go to the smaller id; a query's own id is
never a candidate; of a query id's several vectors the first in order asks; fewer candidates than k give fewer rows; repeated rows
count as separate candidates of one id; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import cut


def chi_square(x: np.ndarray, dims: int) -> np.ndarray:
    """Distribution function of the chi-square law for an even number of degrees of freedom."""
    half = np.asarray(x, dtype=float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, dims // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, dims: int) -> float:
    lo, hi = 0.0, 10.0 * dims + 200
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(np.array(mid), dims) < p else (lo, mid)
    return hi


@dataclass
class Tree:
    """Splits of a kd-tree; a negative child is cell ``-1 - child``."""
    axis: np.ndarray
    value: np.ndarray
    child: np.ndarray            # nodes x 2
    cells: int

    def cell(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), dtype=np.int64) if len(self.axis) else np.full(len(points), -1)
        for _ in range(len(self.axis) + 1):
            inner = np.flatnonzero(at >= 0)
            if not len(inner):
                break
            node = at[inner]
            right = points[inner, self.axis[node]] > self.value[node]
            at[inner] = self.child[node, right.astype(int)]
        return -1 - at


def build_tree(points: np.ndarray, cells: int) -> Tree:
    """Median splits along the widest axis until there are ``cells`` cells (or only equal points)."""
    axis, value, child = [], [], []
    made = 0

    def grow(part: np.ndarray, want: int) -> int:
        nonlocal made
        spread = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(points.shape[1])
        if want <= 1 or len(part) < 2 or spread.max() <= 0:
            made += 1
            return -made
        a = int(spread.argmax())
        v = float(np.median(part[:, a]))
        if v >= part[:, a].max():                # more than half equal the maximum: split below it
            v = float(part[part[:, a] < v, a].max())
        node = len(axis)
        axis.append(a)
        value.append(v)
        child.append([0, 0])
        right = part[:, a] > v
        child[node][0] = grow(part[~right], want // 2)
        child[node][1] = grow(part[right], want - want // 2)
        return node

    grow(points, cells)
    return Tree(np.array(axis, dtype=np.int64), np.array(value), np.array(child, dtype=np.int64).reshape(-1, 2), made)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows that take part, as (id long, vec array<double>)."""
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~odd & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0].n if sizes else 0))


def neighbours(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, dims: int = 8,
               stop: float = 0.99, cell_rows: int = 1024, max_cells: int = 2048, sample_rows: int = 20_000,
               block_rows: int = 4096, block_queries: int = 1024, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``df`` for which the column ``is_query`` holds."""
    spark = df.sparkSession
    query_ids = df.select(F.col(id_col).cast("long").alias("id")).filter(is_query)
    rows = usable(df, id_col, vec_col)
    width = rows.select(F.size("vec")).limit(1).collect()
    if not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    direction = np.random.default_rng(seed).standard_normal((width[0][0], dims))
    schema = StructType([StructField("id", LongType()), StructField("vec", ArrayType(DoubleType())), StructField("proj", ArrayType(DoubleType()))])

    def matrix(column) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def project(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(matrix(b.column(1)) @ direction), pa.list_(pa.float64()))],
                                                 names=schema.fieldNames())

    points = cut(rows.mapInArrow(project, schema))
    n = points.count()
    part = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000))
    fitted = points.filter(part < int(1e6 * min(1.0, sample_rows / n)) + 1).select("id", "proj").orderBy("id").toPandas()
    tree = build_tree(np.array(fitted.proj.tolist()).reshape(len(fitted), dims), max(1, min(max_cells, n // cell_rows, len(fitted) // 8)))

    dealt = StructType([*schema.fields, StructField("cell", IntegerType())])

    def deal(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.cell(matrix(b.column(2))), pa.int32())], names=dealt.fieldNames())

    points = cut(points.mapInArrow(deal, dealt))
    boxes = points.groupBy("cell").agg(F.count("*").alias("n"), *[F.min(F.col("proj")[i]).alias(f"lo{i}") for i in range(dims)],
                                       *[F.max(F.col("proj")[i]).alias(f"hi{i}") for i in range(dims)]).toPandas().sort_values("cell")  # max_cells rows
    lo, hi = (boxes[[f"{side}{i}" for i in range(dims)]].to_numpy() for side in ("lo", "hi"))
    number, held = boxes.cell.to_numpy(), boxes.n.to_numpy()
    radius = float(np.sqrt(chi_square_quantile(stop, dims)))
    # vectors without a distance limit yet take all they meet
    asked = (points.join(query_ids.distinct(), "id", "left_semi").groupBy("id").agg(F.min(F.struct("vec", "proj")).alias("own"))
             .select("id", "own.vec", "own.proj", F.lit(float("inf")).alias("limit")))
    asked = cut(asked)
    going = StructType([*schema.fields, StructField("limit", DoubleType())])
    pair = StructType([*going.fields, StructField("cell", IntegerType())])

    def reach(proj: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Largest projected distance at which the test does not hold, with a slack for rounding."""
        return radius * limit * (1 + 1e-9) + 1e-9 * np.sqrt((proj ** 2).sum(axis=-1))

    def ordered(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Cells of each query in growing projected distance, and whether they are within its reach."""
        proj = matrix(part.column(2))
        far = np.sqrt((np.maximum(np.maximum(lo - proj[:, None], proj[:, None] - hi), 0) ** 2).sum(axis=2))
        order = np.argsort(far, axis=1, kind="stable")
        limit = part.column(3).to_numpy(zero_copy_only=False)
        return order, np.take_along_axis(far, order, axis=1) <= reach(proj, limit)[:, None]

    def parts(batches):
        return (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256))

    def still(first: int):
        def run(batches):
            for part in parts(batches):
                yield part.filter(pa.array(ordered(part)[1][:, first]))
        return run

    def chosen(first: int, last: int):
        def run(batches):
            for part in parts(batches):
                order, near = ordered(part)
                q, at = np.nonzero(near[:, first:last])
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(q)).columns, pa.array(number[order[q, first + at]], pa.int32())],
                                                 names=pair.fieldNames())
        return run

    found = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])

    def verify(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if not len(queries) or not len(vectors):
            return none
        ids, vec, proj = vectors.id.to_numpy(), np.stack(vectors.vec.to_numpy()), np.stack(vectors.proj.to_numpy())
        asks, asked_vec, asked_proj = queries.id.to_numpy(), np.stack(queries.vec.to_numpy()), np.stack(queries.proj.to_numpy())
        limits = queries.limit.to_numpy()
        names, took, scores = [], [], []
        for at in range(0, len(asks), 64):
            part = slice(at, at + 64)
            near = np.zeros((len(asks[part]), len(ids)))
            for d in range(dims):
                near += (asked_proj[part, d, None] - proj[:, d]) ** 2
            near = np.sqrt(near)
            meets = (near <= reach(asked_proj[part], limits[part])[:, None]) & (asks[part, None] != ids)
            for i in np.flatnonzero(meets.any(axis=1)):
                order = np.flatnonzero(meets[i])
                order = order[np.argsort(near[i, order], kind="stable")]
                own, limit, step = np.zeros(0), limits[at + i], 4 * k
                while len(own) < len(order):
                    # as many more as the test allows at the distance known now
                    end = len(own) + int(np.searchsorted(near[i, order[len(own):len(own) + step]], reach(asked_proj[at + i], limit), side="right"))
                    if end == len(own):
                        break
                    own = np.concatenate([own, np.sqrt(((vec[order[len(own):end]] - asked_vec[at + i]) ** 2).sum(axis=1))])
                    if len(own) >= k:
                        limit = min(limit, float(np.partition(own, k - 1)[k - 1]))
                    step *= 2
                best = np.lexsort((ids[order[:len(own)]], own))[:k]
                names.append(np.full(len(best), asks[at + i]))
                took.append(ids[order[best]])
                scores.append(own[best])
        if not names:
            return none
        return pd.DataFrame({"query_id": np.concatenate(names), "vec_id": np.concatenate(took), "score": np.concatenate(scores)})

    size = cut(points.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("vn")))

    def search(pairs: DataFrame) -> DataFrame:
        # blocks: a cell's vectors by hash, its queries by hash
        shape = pairs.groupBy("cell").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("qn")).join(size, "cell")
        left = (pairs.join(shape, "cell").withColumn("qb", F.pmod(F.xxhash64("id", F.lit(1)), "qn").cast("int"))
                .withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("vn") - 1))).select("cell", "qb", "vb", *going.fieldNames()))
        right = (points.join(shape, "cell").withColumn("vb", F.pmod(F.xxhash64("id", F.lit(2)), "vn").cast("int"))
                 .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qn") - 1))).select("cell", "qb", "vb", "id", "vec", "proj"))
        key = ["cell", "qb", "vb"]
        return left.groupBy(key).cogroup(right.groupBy(key)).applyInPandas(verify, found)

    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = spark.createDataFrame([], found)
    first, last = 0, 1
    while first < len(number):
        asked = cut(asked.mapInArrow(still(first), going))
        if asked.isEmpty():
            break
        hits = best.unionByName(search(asked.mapInArrow(chosen(first, last), pair)))
        best = cut(hits.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select(*found.fieldNames()))
        limit = best.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("score")).otherwise(float("inf")).alias("limit"))
        asked = asked.drop("limit").join(limit, asked.id == limit.query_id, "left").select(
            "id", "vec", "proj", F.coalesce("limit", F.lit(float("inf"))).alias("limit"))
        first, last = last, 4 * last
    return best.withColumn("rank", F.row_number().over(by_score)).select("query_id", "rank", "vec_id", "score")
