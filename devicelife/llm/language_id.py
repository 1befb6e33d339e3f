"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits. One binary classifier per bit
scores hashed character n-grams (1 to 3 letters, white space marks word
ends): its margin is the mean log-likelihood ratio of the n-grams under the
languages with bit +1 against those with bit -1, calibrated by a logistic
fit. Decoding is loss-weighted: the logistic loss of every bit counts as
much as that classifier got right on the language's own training rows; the
codeword with the least weighted loss is the answer, a second one close to
it flags the text as ambiguous.

Training reads at most about ``max_rows`` labelled rows (hash-chosen, an
equal number of each language, whole texts); everything else covers all
rows. N-gram counts are summed inside the tasks and by a grouped sum; the
model (``2**bits`` x codeword bits) is broadcast, its size set by
parameters and the number of languages.

Edge cases: a null text or one without a letter is ``und`` with score 0;
with one learned language every other text is that language with score 1;
with none all are ``und``; equal losses go to the language first in code
point order; repeated rows are scored alike; null labels teach nothing;
columns other than the text are passed through as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructField, StructType

from .common import codepoints, cut, mix64, slabs

UND = "und"


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray        # languages x code bits, +1 / -1
    ratio: np.ndarray       # hash buckets x code bits: log-likelihood ratios
    scale: np.ndarray       # logistic calibration of each bit's margin
    shift: np.ndarray
    weight: np.ndarray      # languages x code bits, rows sum to 1
    ambiguous_gap: float


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Exhaustive codes for up to 7 languages (every split of the languages once), else the best of
    seeded random codes with 12 log2(n) bits by least distance between two rows."""
    if n <= 1:
        return np.ones((n, 0), dtype=np.int8)
    if n <= 7:
        splits = np.arange(1, 2 ** (n - 1))
        bits = (splits[None, :] >> np.arange(n)[:, None]) & 1
        return (1 - 2 * bits).astype(np.int8)
    rng = np.random.default_rng(seed)
    width = int(np.ceil(12 * np.log2(n)))
    best, far = None, -1
    for _ in range(20):
        code = np.where(rng.random((n, width)) < 0.5, 1, -1).astype(np.int8)
        code = code[:, np.abs(code.sum(axis=0)) < n]
        near = int((code.shape[1] - (code.astype(int) @ code.T.astype(int) - 3 * width * np.eye(n, dtype=int)).max()) // 2)
        if near > far:
            best, far = code, near
    return best


_FOLD = None


def _folded() -> np.ndarray:
    """Lower-case code point of every letter, 32 for everything else."""
    global _FOLD
    if _FOLD is None:
        _FOLD = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                _FOLD[c] = ord(low) if len(low) == 1 else c
    return _FOLD


def grams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of all texts, and where each text's start (plus the end)."""
    cp, starts = codepoints(texts)
    ch = _folded()[cp]
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    keep = ch != 32
    keep[1:] |= ch[:-1] != 32                     # one space after each word, none at the start
    keep[starts[:-1]] = ch[starts[:-1]] != 32
    ch, owner = ch[keep].astype(np.uint64), owner[keep]
    n = len(ch)
    found, whose = [], []
    value = np.zeros(n, dtype=np.uint64)
    for size in (1, 2, 3):
        if n < size:
            break
        value = value[: n - size + 1] * np.uint64(0x110000) + ch[size - 1:]
        ok = owner[size - 1:] == owner[: n - size + 1]
        if size == 1:
            ok = ok & (ch != 32)
        found.append((mix64(value[ok] + np.uint64(size << 60)) >> np.uint64(64 - bits)).astype(np.int64))
        whose.append(owner[: n - size + 1][ok])
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
    found, whose = np.concatenate(found), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return found[order], np.searchsorted(whose[order], np.arange(len(texts) + 1))


#: Added to the number of n-grams when margins are averaged: short texts get small margins.
SHRINK = 20.0


def margins(texts: list[str], ratio: np.ndarray, bits: int) -> np.ndarray:
    """Per text the shrunk mean log-likelihood ratio of each code bit (zero without n-grams)."""
    out = np.zeros((len(texts), ratio.shape[1]))
    for lo, hi in slabs(texts, 300_000):
        bucket, at = grams(texts[lo:hi], bits)
        size = np.diff(at)
        some = np.flatnonzero(size)
        if len(some):
            out[lo + some] = np.add.reduceat(ratio[bucket], at[some], axis=0) / (size[some, None] + SHRINK)
    return out


def decode(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword, its probability, and whether another is close."""
    bits = model.code.shape[1]
    if not bits:
        n = len(margin)
        return np.zeros(n, dtype=int), np.ones(n), np.zeros(n, dtype=bool)
    z = model.scale * margin + model.shift
    plus, minus = np.logaddexp(0, -z), np.logaddexp(0, z)
    loss = np.where(model.code[None] > 0, plus[:, None, :], minus[:, None, :])
    total = (loss * model.weight[None]).sum(axis=2) * bits / 2
    p = np.exp(total.min(axis=1, keepdims=True) - total)
    p /= p.sum(axis=1, keepdims=True)
    best = total.argmin(axis=1)
    two = np.partition(p, -2, axis=1)[:, -2:]
    return best, two[:, 1], two[:, 1] - two[:, 0] < model.ambiguous_gap


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of y in {0, 1} on x, by damped Newton steps with a small ridge."""
    sd = float(x.std()) or 1.0
    x = x / sd
    w = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 1e-2 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w[0] / sd, w[1]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", bits: int = 15,
        max_rows: int = 8000, ambiguous_gap: float = 0.02) -> Model:
    """Learn from rows with a language. At most about ``max_rows`` of them are read (``max_rows`` /
    languages of each, by the hash of the id)."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}     # one row per language
    langs = sorted(counts)
    code = codewords(len(langs))
    if len(langs) < 2:
        none = np.zeros(0)
        return Model(langs, code, np.zeros((1 << bits, 0)), none, none, np.ones((len(langs), 0)), ambiguous_gap)
    each = max(1, max_rows // len(langs))
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(1_000_000))
    wanted = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(int(np.ceil(1e6 * min(1.0, each / counts[k])))))])
    sample = cut(rows.filter(part < F.element_at(wanted, F.col(lang_col)))
                 .select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")).repartition(16))

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lang = batch.column(0).to_pylist()
            for lo, hi in slabs(texts, 300_000):
                bucket, at = grams(texts[lo:hi], bits)
                for i in range(hi - lo):
                    vec = total.setdefault(lang[lo + i], np.zeros(1 << bits))
                    np.add.at(vec, bucket[at[i]:at[i + 1]], 1.0)
        for k, vec in total.items():
            yield pa.RecordBatch.from_pydict({"lang": [k], "vec": [vec]}, schema=pa.schema([("lang", pa.string()), ("vec", pa.list_(pa.float64()))]))

    schema = StructType([StructField("lang", StringType()), StructField("vec", ArrayType(DoubleType()))])
    summed = (sample.mapInArrow(count, schema).select("lang", F.posexplode("vec").alias("at", "n")).filter("n > 0")
              .groupBy("lang", "at").agg(F.sum("n").alias("n")).collect())      # languages x buckets at most
    table = np.zeros((len(langs), 1 << bits))
    number = {k: i for i, k in enumerate(langs)}
    for r in summed:
        table[number[r.lang], r.at] = r.n
    share = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True)
    ratio = np.stack([np.log(share[code[:, b] > 0].mean(axis=0)) - np.log(share[code[:, b] < 0].mean(axis=0))
                      for b in range(code.shape[1])], axis=1).astype(np.float32)

    held = sample.sparkSession.sparkContext.broadcast(ratio)

    def measure(batches):
        for batch in batches:
            m = margins(batch.column(1).to_pylist(), held.value, bits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(m), pa.list_(pa.float64()))], names=["lang", "vec"])

    seen = sample.mapInArrow(measure, schema).collect()                         # max_rows x code bits
    lang = np.array([number[r.lang] for r in seen])
    margin = np.array([r.vec for r in seen])
    fitted = [_logistic(margin[:, b], (code[lang, b] > 0).astype(float)) for b in range(code.shape[1])]
    scale, shift = np.array([f[0] for f in fitted]), np.array([f[1] for f in fitted])
    right = ((scale * margin + shift > 0) == (code[lang] > 0)).astype(float)
    weight = np.stack([(right[lang == k].sum(axis=0) + 1) / ((lang == k).sum() + 2) for k in range(len(langs))])
    return Model(langs, code, ratio, scale, shift, weight / weight.sum(axis=1, keepdims=True), ambiguous_gap)


DECODED_ROWS = 1024      # texts held as Python strings at a time


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
             names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """The ``keep`` columns with the predicted language, its score and whether it is ambiguous
    (``names`` of the three new columns)."""
    bits = int(np.log2(len(model.ratio)))
    held = docs.sparkSession.sparkContext.broadcast(model)
    # a kept text travels once
    at = keep.index(text_col) if text_col in keep else len(keep)
    src = docs.select(*keep, *([] if text_col in keep else [F.col(text_col).alias("__text")]))
    schema = StructType([*[src.schema[k] for k in keep], StructField(names[0], StringType()),
                         StructField(names[1], DoubleType()), StructField(names[2], BooleanType())])

    def run(batches):
        m = held.value
        for batch in (b.slice(lo, DECODED_ROWS) for b in batches for lo in range(0, b.num_rows, DECODED_ROWS)):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            lettered = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool) if m.languages else np.zeros(len(texts), dtype=bool)
            lang, score, near = [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
            if lettered.any():
                best, p, close = decode(m, margins(texts, m.ratio, bits))
                lang = [m.languages[b] if ok else UND for b, ok in zip(best.tolist(), lettered.tolist())]
                score, near = np.where(lettered, p, 0.0), close & lettered
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(lang, pa.string()), pa.array(score), pa.array(near)], names=schema.fieldNames())

    return src.mapInArrow(run, schema)
