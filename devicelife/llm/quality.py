"""Quality grades with ordinal cumulative-link regression on hashed text.

Ratings are ordered grades 0 .. K-1. One weight vector over hashed text
features gives a text its position f; ordered thresholds cut the line into
grades: P(grade > k) = 1 / (1 + exp(-(f - threshold k))). From it come the
expected grade and the tail probability by which texts are selected.

Features: the words (lower case, share of all words), and bins of a few
measures of the text (distinct words, repeated neighbours, symbols, upper
case, digits, word length, length), hashed into the same weights.

Training reads at most about ``max_rows`` rated texts, an equal number of
each grade, weighted back to their real shares. The model is broadcast; its
size is set by ``BITS``.

Edge cases: null and empty texts have only the length bins; null ratings
teach nothing; with no ratings every expected grade is 0, with one grade it
is that grade; repeated rows are scored alike; extra columns are ignored
unless named in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from .common import U64, codepoints, labelled_sample, letter_tables, mix64, run_hashes, slabs, words_of

BITS = 16
SCALE = 20.0             # weight of the words' shares against the bins


@dataclass
class Model:
    grades: list[int]
    weight: np.ndarray
    thresholds: np.ndarray      # one less than grades, ascending


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix64(h) >> U64(64 - BITS)).astype(np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: bucket, value, and where each text's begin."""
    cp, starts = codepoints(texts)
    lower, alnum = letter_tables()
    n = len(texts)
    space = (cp == 32) | ((cp >= 9) & (cp <= 13))
    s, e, owner = words_of(cp, starts, ~space)
    word = run_hashes(lower[cp], s, e)
    count = np.bincount(owner, minlength=n)
    order = np.lexsort((word, owner))
    sw, so = word[order], owner[order]
    new = np.ones(len(sw), dtype=bool)
    new[1:] = (sw[1:] != sw[:-1]) | (so[1:] != so[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(sw)))
    bucket = [_bucket(sw[at])]
    value = [SCALE * times / count[so[at]]]
    whose = [so[at]]
    total = lambda mask: np.add.reduceat(np.append(mask, False).astype(np.int64), starts[:-1]) if n else np.zeros(0)
    chars = np.maximum(1, total(~space))
    some = np.maximum(1, count)
    twice = np.zeros(len(word), dtype=bool)
    twice[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    measures = [
        np.bincount(so[at], minlength=n) / some * 10,
        np.bincount(owner, twice, n) / some * 10,
        total(~alnum[cp] & ~space) / chars * 20,
        total(lower[cp] != cp) / chars * 10,
        total((cp >= 48) & (cp <= 57)) / chars * 20,
        np.minimum(20, chars / some),
        np.log2(1 + count),
    ]
    for k, m in enumerate(measures):
        bucket.append(_bucket((np.floor(m).astype(np.int64) + 1000 * (k + 1)).astype(U64) + U64(1 << 60)))
        value.append(np.ones(n))
        whose.append(np.arange(n))
    bucket, value, whose = np.concatenate(bucket), np.concatenate(value), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return bucket[order], value[order], np.searchsorted(whose[order], np.arange(n + 1))


def positions(texts: list[str], weight: np.ndarray) -> np.ndarray:
    out = np.zeros(len(texts))
    for lo, hi in slabs(texts, 300_000):
        b, v, at = features(texts[lo:hi])
        out[lo:hi] = np.add.reduceat(weight[b] * v, at[:-1])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_ordinal(bucket: np.ndarray, value: np.ndarray, at: np.ndarray, grade: np.ndarray, k: int, share: np.ndarray,
                steps: int = 200, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the penalised likelihood of grades 0 .. k-1.

    Thresholds are a first one and positive (exponential) gaps, so they stay ordered."""
    rows = np.repeat(np.arange(len(grade)), np.diff(at))
    theta = np.zeros((1 << BITS) + k - 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    share = share / share.sum()
    for step in range(1, steps + 1):
        w, free = theta[:1 << BITS], theta[1 << BITS:]
        cuts = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        f = np.bincount(rows, w[bucket] * value, len(grade))
        # P(grade > j) at the cut below and above the observed grade
        high = np.concatenate([[-np.inf], cuts, [np.inf]])
        up, down = _sigmoid(f - high[grade]), _sigmoid(f - high[grade + 1])
        up, down = np.where(grade == 0, 1.0, up), np.where(grade == k - 1, 0.0, down)
        p = np.maximum(1e-12, up - down)
        du, dd = up * (1 - up) / p * share, down * (1 - down) / p * share
        gw = np.bincount(bucket, (du - dd)[rows] * value, 1 << BITS) - ridge * w
        gc = np.bincount(grade + 1, dd, k + 1)[1:k] - np.bincount(grade, du, k)[1:k]
        later = np.cumsum(gc[::-1])[::-1]                    # a gap moves all later cuts
        gf = np.concatenate([later[:1], later[1:] * np.exp(free[1:])])
        g = np.concatenate([gw, gf])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    free = theta[1 << BITS:]
    return theta[:1 << BITS], np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def fit(docs: DataFrame, ratings: DataFrame, rating: Column, keep=None, max_rows: int = 9000) -> Model:
    """Learn from ``ratings`` (id and the columns ``rating`` is made of), for ids where ``keep`` holds."""
    sample, counts = labelled_sample(docs, ratings, rating.cast("int"), max_rows, keep=keep)
    grades = sorted(counts)
    if len(grades) < 2:
        return Model(grades, np.zeros(1 << BITS), np.zeros(0))
    schema = StructType([StructField("label", IntegerType()), StructField("at", ArrayType(IntegerType())),
                         StructField("value", ArrayType(DoubleType()))])

    def sparse(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in slabs(texts, 300_000):
                b, v, at = features(texts[lo:hi])
                cutup = [(b[at[i]:at[i + 1]], v[at[i]:at[i + 1]]) for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([c[0] for c in cutup], pa.list_(pa.int32())),
                                                  pa.array([c[1] for c in cutup], pa.list_(pa.float64()))], names=schema.fieldNames())

    rows = sample.mapInArrow(sparse, schema).toArrow().sort_by([("label", "ascending")])     # max_rows sparse vectors
    label = np.searchsorted(grades, rows.column("label").to_numpy())
    size = np.bincount(label, minlength=len(grades))
    share = np.array([counts[g] for g in grades])[label] / size[label]
    at, values = rows.column("at").combine_chunks(), rows.column("value").combine_chunks()
    lengths = np.diff(at.offsets.to_numpy())
    weight, cuts = fit_ordinal(at.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy(),
                               np.concatenate([[0], np.cumsum(lengths)]), label, len(grades), share)
    return Model(grades, weight, cuts)


def grade(docs: DataFrame, model: Model, least: int = 1, cut_at: float = 0.5, text_col: str = "text",
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, expected_grade, p_tail = P(grade >= ``least``) and selected (p_tail >= ``cut_at``)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = StructType([*[src.schema[k] for k in keep], StructField("expected_grade", DoubleType()), StructField("p_tail", DoubleType())])

    def run(batches):
        m = held.value
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            above = _sigmoid(positions(texts, m.weight)[:, None] - m.thresholds[None, :])     # P(grade > each but the last)
            steps = np.diff(np.array(m.grades, dtype=float))
            mean = above @ steps + (m.grades[0] if m.grades else 0)
            reach = np.searchsorted(m.grades, least)
            tail = np.ones(len(texts)) if m.grades and reach == 0 else above[:, reach - 1] if reach < len(m.grades) else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(mean), pa.array(tail)], names=schema.fieldNames())

    return src.mapInArrow(run, schema).withColumn("selected", F.col("p_tail") >= cut_at)
