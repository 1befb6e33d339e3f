"""Toxic spans with a linear-chain conditional random field.

Tokens are runs of letters and digits; a chain is a sentence (at most
``CHAIN`` tokens). Each token has hashed features (the word, its first four
and five characters, the words before and after), the states are *clean*
and *toxic*. Forward-backward gives each token's marginal probability of
being toxic; runs of tokens at or above one half are the offending spans
(code point offsets), and the marginals of all tokens add up to the
document's score: a logistic fit of the largest marginal and the expected
number of toxic tokens to the documents' labels.

Labels mark documents, the field needs labelled tokens: a token of a
labelled toxic document counts as toxic if its word or word beginning is
significantly tied to toxic documents (log-likelihood ratio ``MIN_G2`` and
rate ratio ``MIN_RATIO`` over the documents of the sample).

Training reads at most about ``max_rows`` labelled documents and
``max_chains`` chains of them; scoring covers every whole text. The model
is broadcast; its size is set by ``BITS``.

Edge cases: null and empty texts have no tokens and get the score of zero
toxic tokens; a null label teaches nothing; without toxic labels every
score is that of a clean text; repeated rows are scored alike; extra
columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import U64, codepoints, labelled_sample, letter_tables, mix64, run_hashes, slabs, words_of

BITS = 18
CHAIN = 128
KINDS = 5               # features of a token
MIN_G2, MIN_RATIO = 20.0, 10.0
#: Marginals below this add nothing to a document's expected number of toxic tokens (many faint ones
#: would make any long text toxic).
FAINT = 0.2
BREAKS = np.array([ord(c) for c in ".!?\n"], dtype=np.uint32)


@dataclass
class Model:
    emission: np.ndarray     # hash buckets: toxic minus clean
    start: np.ndarray        # 2
    trans: np.ndarray        # 2 x 2, from row to column
    score: np.ndarray        # weights of (largest marginal, log1p(expected toxic tokens), 1)


@dataclass
class Tokens:
    start: np.ndarray        # code point offsets inside the text
    end: np.ndarray
    owner: np.ndarray
    chain: np.ndarray        # where chains start (token numbers), with the number of tokens at the end
    feature: np.ndarray      # tokens x KINDS hash buckets


def tokens(texts: list[str]) -> Tokens:
    cp, starts = codepoints(texts)
    lower, alnum = letter_tables()
    s, e, owner = words_of(cp, starts, alnum[cp])
    n = len(s)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Tokens(none, none, none, np.zeros(1, dtype=np.int64), np.zeros((0, KINDS), dtype=np.int64))
    low = lower[cp]
    word = run_hashes(low, s, e)
    four, five = (run_hashes(low, s, np.minimum(e, s + k)) for k in (4, 5))
    stops = np.concatenate([[0], np.cumsum(np.isin(cp, BREAKS))])
    new = np.ones(n, dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (stops[s[1:]] > stops[e[:-1]])
    at = np.flatnonzero(new)
    within = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    new |= within % CHAIN == 0
    before, after = np.zeros(n, dtype=U64), np.zeros(n, dtype=U64)
    before[1:] = np.where(new[1:], U64(0), word[:-1])
    after[:-1] = np.where(new[1:], U64(0), word[1:])
    feature = np.stack([mix64(h + U64(k << 56)) >> U64(64 - BITS) for k, h in enumerate((word, four, five, before, after))], axis=1)
    return Tokens(s - starts[owner], e - starts[owner], owner, np.append(np.flatnonzero(new), n), feature.astype(np.int64))


def forward_backward(e: np.ndarray, chain: np.ndarray, start: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Marginals of the toxic state for tokens with emission scores ``e`` (and, with ``pairs``, the
    expected number of each transition). All chains advance in step, the longest first."""
    size = np.diff(chain)
    order = np.argsort(-size, kind="stable")
    first, size = chain[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(longest), side="left")       # chains longer than t
    w = np.exp(np.clip(e, -30, 30))
    t = np.exp(trans)
    ahead, back = np.empty(len(e)), np.empty(len(e))
    a0, a1 = np.exp(start[0]), np.exp(start[1])
    p = None
    for k in range(longest):
        at = first[:live[k]] + k
        if p is None:
            x0, x1 = np.full(len(at), a0), a1 * w[at]
        else:
            p = p[:live[k]]
            x0 = (1 - p) * t[0, 0] + p * t[1, 0]
            x1 = ((1 - p) * t[0, 1] + p * t[1, 1]) * w[at]
        p = x1 / (x0 + x1)
        ahead[at] = p
    q = np.full(len(first), 0.5)                                           # share of the toxic state behind
    for k in range(longest - 1, -1, -1):
        n = live[k]
        at = first[:n] + k
        more = live[k + 1] if k + 1 < longest else 0
        if more:
            nxt = first[:more] + k + 1
            y1, y0 = back[nxt] * w[nxt], 1 - back[nxt]
            b0, b1 = t[0, 0] * y0 + t[0, 1] * y1, t[1, 0] * y0 + t[1, 1] * y1
            q[:more] = b1 / (b0 + b1)
        back[at] = q[:n]
    up = ahead * back
    marginal = up / (up + (1 - ahead) * (1 - back))
    if not pairs:
        return marginal
    inner = np.ones(len(e), dtype=bool)
    inner[chain[:-1]] = False
    j = np.flatnonzero(inner)
    i = j - 1
    cells = np.stack([(1 - ahead[i]) * t[0, 0] * (1 - back[j]), (1 - ahead[i]) * t[0, 1] * w[j] * back[j],
                      ahead[i] * t[1, 0] * (1 - back[j]), ahead[i] * t[1, 1] * w[j] * back[j]])
    return marginal, (cells / cells.sum(axis=0)).sum(axis=1).reshape(2, 2)


def fit_field(feature: np.ndarray, chain: np.ndarray, label: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximum penalised likelihood of the labelled chains by Adam; emission, start and transition scores."""
    used, column = np.unique(feature, return_inverse=True)
    column = column.reshape(feature.shape)
    weight, start, trans = np.zeros(len(used)), np.zeros(2), np.zeros((2, 2))
    inner = np.ones(len(label), dtype=bool)
    inner[chain[:-1]] = False
    j = np.flatnonzero(inner)
    seen = np.bincount(label[j - 1] * 2 + label[j], minlength=4).reshape(2, 2)
    begun = np.bincount(label[chain[:-1]], minlength=2)
    theta = np.concatenate([weight, start, trans.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weight, start, trans = theta[:-6], theta[-6:-4], theta[-4:].reshape(2, 2)
        p, moved = forward_backward(weight[column].sum(axis=1), chain, start, trans, pairs=True)
        opened = p[chain[:-1]].sum()
        g = np.concatenate([np.bincount(column.ravel(), np.repeat(label - p, KINDS), len(used)),
                            begun - np.array([len(chain) - 1 - opened, opened]), (seen - moved).ravel()]) - 0.02 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    emission = np.zeros(1 << BITS, dtype=np.float32)
    emission[used] = theta[:-6]
    return emission, theta[-6:-4], theta[-4:].reshape(2, 2)


def summaries(texts: list[str], model: Model):
    """Per text: largest marginal, expected toxic tokens, and the spans at or above one half."""
    top, total = np.zeros(len(texts)), np.zeros(len(texts))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for lo, hi in slabs(texts, 300_000):
        t = tokens(texts[lo:hi])
        if not len(t.owner):
            continue
        p = forward_backward(model.emission[t.feature].sum(axis=1), t.chain, model.start, model.trans)
        np.maximum.at(top, t.owner + lo, p)
        total[lo:hi] += np.bincount(t.owner, np.where(p >= FAINT, p, 0.0), hi - lo)
        hot = np.flatnonzero(p >= 0.5)
        for i in hot.tolist():
            own = spans[lo + t.owner[i]]
            if own and i and p[i - 1] >= 0.5 and t.owner[i - 1] == t.owner[i]:
                own[-1] = (own[-1][0], int(t.end[i]))
            else:
                own.append((int(t.start[i]), int(t.end[i])))
    return top, total, spans


def _design(top: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.stack([top, np.log1p(total), np.ones_like(top)], axis=1)


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.05] * (x.shape[1] - 1) + [1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (p - y)) + ridge @ w)
        w -= np.clip(step, -1.5, 1.5)
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, keep=None, label_col: str = "toxic", max_rows: int = 8000, max_chains: int = 40_000) -> Model:
    """Learn from ``labels`` (id, 0/1), restricted to ids for which the column ``keep`` holds."""
    sample, counts = labelled_sample(docs, labels, F.col(label_col).cast("int"), max_rows, keep=keep)
    blank = Model(np.zeros(1 << BITS, dtype=np.float32), np.array([0.0, -10.0]), np.array([[0.0, -10.0], [0.0, -10.0]]),
                  np.array([0.0, 0.0, -5.0]))
    if not counts.get(1):
        return blank

    # documents of each label that have a feature (word or word beginning): a grouped sum
    pair = StructType([StructField("at", IntegerType()), StructField("label", IntegerType())])

    def features(batches):
        for batch in batches:
            label = np.array(batch.column(0).to_pylist())
            texts = batch.column(1).to_pylist()
            for lo, hi in slabs(texts, 300_000):
                t = tokens(texts[lo:hi])
                if len(t.owner):
                    both = np.unique(np.repeat(t.owner, 3) << BITS | t.feature[:, :3].ravel())
                    at, who = both & ((1 << BITS) - 1), both >> BITS
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(label[lo + who], pa.int32())], names=["at", "label"])

    size = {r[0]: r[1] for r in sample.groupBy("_label").count().collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    seen = sample.mapInArrow(features, pair).groupBy("at").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("d1"), F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("d0"))
    both, log = F.col("d1") + F.col("d0"), lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    g2 = 2 * (log(F.col("d1"), both * n1 / (n0 + n1)) + log(F.col("d0"), F.greatest(F.lit(1e-9), both * n0 / (n0 + n1))))
    rate = (F.col("d1") + 0.1) / (n1 + 0.2) / ((F.col("d0") + 0.1) / (n0 + 0.2))
    tied = np.array(sorted(r[0] for r in seen.filter((g2 >= MIN_G2) & (rate >= MIN_RATIO)).select("at").collect()), dtype=np.int64)
    if not len(tied):
        return blank
    mark = np.zeros(1 << BITS, dtype=bool)
    mark[tied] = True

    # chains to learn from: all, or the first of each kind by a hash of (document, place) where they exceed the bound
    row = StructType([StructField("toxic", IntegerType()), StructField("order", LongType()),
                      StructField("feature", ArrayType(IntegerType())), StructField("label", ArrayType(IntegerType()))])
    tally = StructType([StructField("toxic", IntegerType()), StructField("n", LongType())])

    def parts(batch):
        """Of some texts at a time: tokens, their labels, and whether each chain holds a toxic token."""
        doc, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi in slabs(texts, 300_000):
            t = tokens(texts[lo:hi])
            if len(t.owner):
                label = mark[t.feature[:, :3]].any(axis=1) & (np.array(doc[lo:hi])[t.owner] == 1)
                yield texts[lo:hi], t, label, np.add.reduceat(label, t.chain[:-1]) > 0

    def count(batches):
        hot = [0, 0]
        for batch in batches:
            for *_, kind in parts(batch):
                hot[1] += int(kind.sum())
                hot[0] += len(kind) - int(kind.sum())
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(hot, pa.int64())], names=tally.fieldNames())

    half = max_chains // 2
    n_chains = {r[0]: r[1] for r in sample.mapInArrow(count, tally).groupBy("toxic").agg(F.sum("n")).collect()}
    # hashes below this pass on: all while they fit, else twice as many as are taken
    most = [(1 << 63) - 1 if n <= 2 * half else int((1 << 63) * (2 * half / n)) for n in (n_chains.get(0, 0), n_chains.get(1, 0))]

    def chains(batches):
        for batch in batches:
            for texts, t, label, hot in parts(batch):
                out = ([], [], [], [])
                start = t.chain[:-1]
                own = np.array([int.from_bytes(hashlib.blake2b((x or "").encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
                                for x in texts], dtype=U64)
                place = (start - np.searchsorted(t.owner, t.owner[start])).astype(U64)
                order = mix64(own[t.owner[start]] ^ mix64(place + U64(1))) >> U64(1)
                for c in np.flatnonzero(order <= np.where(hot, U64(most[1]), U64(most[0]))).tolist():
                    i, j = t.chain[c], t.chain[c + 1]
                    out[0].append(int(hot[c]))
                    out[1].append(int(order[c]))
                    out[2].append(t.feature[i:j].ravel())
                    out[3].append(label[i:j].astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                                  pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.list_(pa.int32()))], names=row.fieldNames())

    found = sample.mapInArrow(chains, row)
    picked = []
    for kind in (1, 0):
        picked += found.filter(F.col("toxic") == kind).orderBy("order", "feature").limit(half).collect()
    feature = np.concatenate([np.array(r.feature, dtype=np.int64) for r in picked]).reshape(-1, KINDS)
    label = np.concatenate([np.array(r.label, dtype=np.int64) for r in picked])
    chain = np.concatenate([[0], np.cumsum([len(r.label) for r in picked])])
    field = Model(*fit_field(feature, chain, label), np.zeros(3))

    held = sample.sparkSession.sparkContext.broadcast(field)
    pair = StructType([StructField("label", IntegerType()), StructField("top", DoubleType()), StructField("total", DoubleType())])

    def measure(batches):
        for batch in batches:
            top, total, _ = summaries(batch.column(1).to_pylist(), held.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(top), pa.array(total)], names=pair.fieldNames())

    got = sample.mapInArrow(measure, pair).orderBy("label", "top", "total").collect()       # max_rows
    y = np.array([r.label == 1 for r in got], dtype=float)
    weight = np.where(y == 1, counts[1] / max(1, n1), counts.get(0, 0) / max(1, n0))
    field.score = _newton(_design(np.array([r.top for r in got]), np.array([r.total for r in got])), y, weight / weight.mean())
    return field


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, score (0 to 1) and spans (start, end: code point offsets) of every text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(*keep, F.col(text_col).alias("__text"))
    span = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
    schema = StructType([*[src.schema[k] for k in keep], StructField("score", DoubleType()), StructField("spans", ArrayType(span))])
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            top, total, spans = summaries([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()], held.value)
            p = 1 / (1 + np.exp(-np.clip(_design(top, total) @ held.value.score, -30, 30)))
            listed = [[{"start": a, "end": b} for a, b in own] for own in spans]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p), pa.array(listed, spans_type)], names=schema.fieldNames())

    return src.mapInArrow(run, schema)
