"""Whitening, collision-counting links and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from devicelife.llm import collision_links, spelling, whitening

VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())), StructField("_x", StringType()),
                      StructField("n", StringType())])
WORDS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("word", StringType())])


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "extra", "clash") for i, v in rows], VECTORS).repartition(parts)


# ------------------------------------------------------------------ whitening

@pytest.mark.parametrize("kind", ["random", "diagonal", "repeated", "zero", "one"])
def test_eigen_equals_numpy(kind):
    rng = np.random.default_rng(3)
    d = 1 if kind == "one" else 24
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"random": rng.random(d) * 9, "diagonal": np.arange(d) + 1.0, "repeated": np.array([5.0] * 4 + [2.0] * 10 + [1e-9] * (d - 14)),
              "zero": np.zeros(d), "one": np.array([3.0])}[kind]
    a = np.diag(values) if kind == "diagonal" else (q * values) @ q.T
    a = (a + a.T) / 2
    got, vec = whitening.eigen(a, 12)
    want = np.linalg.eigvalsh(a)[::-1][:12]
    assert np.allclose(got, want, atol=1e-12)
    assert np.abs(vec.T @ vec - np.eye(len(got))).max() < 1e-12
    assert np.abs(a @ vec - vec * got).max() < 1e-11


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 20)) @ rng.normal(size=(20, 20))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(i, base[7].tolist()) for i in range(400, 450)] + [(7, base[7].tolist()), (None, base[8].tolist())]
    bad = [(900, None), (901, [1.0] * 19 + [None]), (902, [float("nan")] * 20), (903, [float("inf")] * 20), (904, []), (905, [1.0, 2.0]), (906, [1e300] * 20)]
    got = whitening.whiten(vectors(spark, rows + bad)).toPandas()
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, mean = len(fit), fit.mean(axis=0)
    cov = (fit - mean).T @ (fit - mean) / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n} and got["identity_error"].iloc[0] < 1e-10
    sums = fit.sum(axis=0)
    want = {}
    for (i, _), row in zip(rows, x):
        want[-1 if i is None else i] = (row, sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)))
    signs = {}
    for r in got.itertuples():
        row, deviation = want[-1 if np.isnan(r.vec_id) else int(r.vec_id)]
        value = (row - mean) @ u[:, r.component - 1] / np.sqrt(e[r.component - 1])
        sign = signs.setdefault(r.component, np.sign(value * r.whitened) or 1.0)
        assert r.deviation == deviation and r.whitened == pytest.approx(sign * value, abs=1e-9)
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(cov), rel=1e-9)


def test_whitening_of_small_and_flat_tables(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0        # one distinct vector
    flat = whitening.whiten(vectors(spark, [(k, [float(k), 5.0, 2.0 * k]) for k in range(6)])).toPandas()
    assert set(flat["component"]) == {1} and flat["explained"].iloc[0] == pytest.approx(1.0)
    wide = whitening.whiten(vectors(spark, [(k, [float(k) * 2 ** 40]) for k in range(3)])).toPandas()
    assert wide["deviation"].isna().any() and not wide["whitened"].isna().any()                    # does not fit a long


def test_whitening_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    a, b = (whitening.whiten(vectors(spark, rows, k)).toPandas().sort_values(["vec_id", "component"])["whitened"].to_numpy() for k in (1, 7))
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-9)


# ---------------------------------------------------------- collision counting

def links_of(rows, limit=0.95):
    """(n_links, component) by all pairs."""
    fine = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if fine[i] and fine[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1]), np.array(rows[j][1])
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= limit:
                    n[i] += 1
                    n[j] += 1
                    parent[root(i)] = root(j)
    groups = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            groups[root(i)] = min(groups.get(root(i), vec_id), vec_id)
    return [(vec_id, n[i], groups.get(root(i))) for i, (vec_id, _) in enumerate(rows)]


def near_rows(d=32, seed=2):
    rng = np.random.default_rng(seed)
    rows, k = [], 100
    for copies in (1, 1, 2, 5, 30, 60):
        center = rng.normal(size=d)
        for _ in range(copies):
            rows.append((k, (center + rng.normal(size=d) * rng.choice([0.05, 0.2, 0.3])).tolist()))
            k += 1
    rows += [(k + i, rows[3][1]) for i in range(20)] + [(5, (3 * np.array(rows[3][1])).tolist()), (5, rows[0][1]), (None, rows[1][1])]
    rows += [(7000, None), (7001, [0.0] * d), (7002, [1.0] * (d - 1) + [None]), (7003, [float("nan")] * d), (7004, []), (7005, [1.0, 0.0]), (7006, [1.0, 0.01]),
             (7007, [1e200] * d), (7008, [1e200] * (d - 1) + [2e200]), (7009, [1e-200] * d)]
    return rows


@pytest.mark.parametrize("part_rows", [2048, 48])
def test_links_equal_all_pairs(spark, part_rows):
    rows = near_rows()
    got = collision_links.link(vectors(spark, rows), part_rows=part_rows).collect()
    none = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(none((r.vec_id, r.n_links, r.component_id)) for r in got) == sorted(map(none, links_of(rows)))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_of_an_empty_table(spark):
    assert collision_links.link(vectors(spark, [])).count() == 0


def test_recall_of_pairs_at_the_limit(spark):
    """2,000 pairs of cosine just over the limit, dealt to many small parts."""
    rng = np.random.default_rng(8)
    a = rng.normal(size=(2000, 48))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    c = 0.9501 * a + np.sqrt(1 - 0.9501 ** 2) * b
    rows = [(2 * i, v.tolist()) for i, v in enumerate(a)] + [(2 * i + 1, v.tolist()) for i, v in enumerate(c)]
    got = collision_links.link(vectors(spark, rows, 8), part_rows=256)
    assert got.filter("n_links = 1").count() >= 0.97 * len(rows)
    assert got.filter("n_links > 1").count() == 0


def test_collision_counts():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(40, 12)), rng.normal(size=(50, 12))
    for needed in (0, 3, 6, 12):
        want = {(i, j) for i in range(40) for j in range(50) if (np.abs(a[i] - b[j]) <= 1.0).sum() >= needed}
        assert set(zip(*(x.tolist() for x in collision_links.count_collisions(a, b, 1.0, needed, False)))) == want
    assert collision_links.needed_collisions(32, 2.0, 0.5) > collision_links.needed_collisions(32, 2.0, 0.9999) > 0


# ------------------------------------------------------------ spelling variants

def spelled(texts, least=5):
    c = Counter()
    for i, text in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= 6:
                c[w] += 1
    return {w: n for w, n in c.items() if n >= least}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def expected(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def test_spelling_equals_brute_force(spark):
    rng = random.Random(6)
    letters = "abcdéÿÀz"
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 8, 12]))) for _ in range(60)]
    words += ["aaaaaaaa", "aaaaaaaab", "ababababab", "babababab", "aaaaaab"]
    variants = list(words)
    for w in words:
        for _ in range(4):
            k = rng.randrange(len(w))
            variants.append(rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]]))
    texts = [(rng.randrange(500), " ".join(rng.choice(variants).upper() if rng.random() < 0.1 else rng.choice(variants) for _ in range(rng.choice([0, 5, 80]))))
             for _ in range(150)]
    for k, w in enumerate(words[:20]):                   # chains of forms: 5, 25, 125 times
        texts += [(1000 + k, f"{w}-{w}x, " * 5 + f"{w}xy7" * 30 + f" {w}xyz" * 160)]
    texts += [(None, None), (3, ""), (None, "spelling 12 spelling! " * 6), (4, "spelling " * 5), (4, "spelling " * 5), (9, "q" * 50_000 + " " + "short " * 9)]
    counts = spelled(texts)
    want = expected(counts)
    df = spark.createDataFrame([(i, t, "extra") for i, t in texts], WORDS).repartition(4)
    got = {tuple(r) for r in spelling.variants(spelling.word_counts(df)).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == want
    assert any(r[2] != r[1] and r[1] for r in want)     # some chain is longer than one step


def test_spelling_without_words(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "a bc", "y")], WORDS)
    assert spelling.variants(spelling.word_counts(df)).count() == 0
    assert spelling.variants(spelling.word_counts(df.filter("doc_id > 9"))).count() == 0


def test_two_pivots_share_no_code_point():
    rng = random.Random(1)
    for _ in range(300):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(6, 14)))
        rank = {g: (rng.randrange(5), g) for g in {w[i:i + 2] for i in range(len(w) - 1)}}
        prefix, pivots = spelling.grams_of(w, rank)
        assert len(pivots) == 2 and abs(pivots[0] - pivots[1]) >= 2 and set(pivots) <= {i for _, i in prefix}
        cost = lambda i: rank[w[i:i + 2]][0]
        places = sorted(i for _, i in prefix)
        assert sum(map(cost, pivots)) == min(cost(i) + cost(j) for i in places for j in places if j - i >= 2)
