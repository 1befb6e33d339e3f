"""Language ID, quality and toxicity on small labelled fixtures."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicelife.llm import language_id, quality, toxicity

WORDS = {"x": "garo velin mosta prune kalet", "y": "schnak trumpf wolzig krafft zung", "z": "liao mei shu tang wen"}


def sentence(rng, words, n):
    return " ".join(rng.choice(words.split(), n)).capitalize() + "."


def rows():
    rng = np.random.default_rng(4)
    out = []
    for i in range(240):
        lang = "xyz"[i % 3]
        out.append((i, " ".join(sentence(rng, WORDS[lang], 8) for _ in range(rng.integers(1, 6))), lang))
    return out


EDGES = [(1000, None, None), (1001, "", "x"), (1002, "123 !?", "x"), (None, "garo velin", "x"), (1003, "garo velin " * 20000, None),
         (1004, "schnak wolzig zung", "y"), (1004, "schnak wolzig zung", "y")]


def test_language(spark):
    df = spark.createDataFrame([(*r, "own") for r in rows() + EDGES], "doc_id long, text string, lang string, score string")
    model = language_id.fit(df.filter((F.col("doc_id") % 4 != 2) & (F.col("doc_id") < 1000)), bits=12)
    got = language_id.identify(df, model, keep=("doc_id", "lang")).collect()
    assert len(got) == len(rows()) + len(EDGES)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 1000 and r.doc_id % 4 == 2]
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by[1003].lang_pred == "x" and by[1004].lang_pred == "y" and all(0 <= r.score <= 1 for r in got)


def test_language_with_few_languages(spark):
    df = spark.createDataFrame([(1, "ab", "q"), (2, "..", "q")], "doc_id long, text string, lang string")
    one = language_id.identify(df, language_id.fit(df)).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.score) for r in one] == [("q", 1.0), ("und", 0.0)]
    none = language_id.identify(df, language_id.fit(df.limit(0))).collect()
    assert {r.lang_pred for r in none} == {"und"}


@pytest.mark.parametrize("n", [2, 4, 7, 30])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert min((a != b).sum() for a, b in itertools.combinations(code, 2)) >= (1 if n == 2 else max(2, code.shape[1] // 4))


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    chain, start, trans = np.array([0, 4, 5, 8]), rng.normal(size=2), rng.normal(size=(2, 2))
    e = rng.normal(size=8)
    got, moved = toxicity.forward_backward(e, chain, start, trans, pairs=True)
    want, pairs = np.zeros(8), np.zeros((2, 2))
    for a, b in zip(chain, chain[1:]):
        total, one, two = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(start[y[0]] + sum(e[a + i] * y[i] for i in range(b - a)) + sum(trans[y[i], y[i + 1]] for i in range(b - a - 1)))
            total += w
            one += w * np.array(y)
            for i in range(b - a - 1):
                two[y[i], y[i + 1]] += w
        want[a:b] = one / total
        pairs += two / total
    assert np.allclose(got, want) and np.allclose(moved, pairs)


def test_toxicity(spark):
    rng = np.random.default_rng(6)
    docs, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        s = [sentence(rng, WORDS["x"] + " " + WORDS["z"], 9) for _ in range(4)]
        if bad:
            s[rng.integers(4)] = "Garo filth" + "abc"[i % 2] + " velin."
        docs.append((i, " ".join(s), "own"))
        labels.append((i, int(bad)))
    docs += [(900, None, "x"), (901, "", "x"), (902, "Velin mosta. Garo filtha velin.", "x"), (903, "velin " * 30000, "x")]
    labels += [(2, None), (None, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(df, lab, keep=F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    held = [(got[i].score >= 0.7) == (i % 3 == 0) for i in range(300) if i % 2]
    assert np.mean(held) > 0.97
    assert got[902].score >= 0.7 and [(s.start, s.end) for s in got[902].spans] == [(18, 24)]
    assert got[900].score == got[901].score < 0.5 and got[903].score < 0.5
    blank = toxicity.fit(df, lab.limit(0))
    assert all(r.score < 0.1 and r.spans == [] for r in toxicity.score(df, blank).collect())


def test_ordinal_grades(spark):
    rng = np.random.default_rng(2)
    good = "garo velin mosta prune kalet"
    docs, ratings = [], []
    for i in range(320):
        g = i % 4
        words = [rng.choice(good.split()) if rng.random() < g / 3 else rng.choice(["###", "QQ", "zz1"]) for _ in range(40)]
        docs.append((i, " ".join(words), "own"))
        ratings.append((i, g))
    docs += [(900, None, "x"), (901, "", "x"), (902, "QQ " * 30000, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, selected string")
    rated = spark.createDataFrame(ratings + [(5000, None)], "doc_id long, grade int")
    model = quality.fit(df, rated, F.col("grade"), keep=F.col("doc_id") % 5 != 1)
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in quality.grade(df, model, least=2).collect()}
    held = [i for i in range(320) if i % 5 == 1]
    means = [np.mean([got[i].expected_grade for i in held if i % 4 == g]) for g in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 1.5
    assert np.mean([got[i].selected == (i % 4 >= 2) for i in held]) > 0.8
    assert all(0 <= r.expected_grade <= 3 and 0 <= r.p_tail <= 1 for r in got.values())
    none = quality.grade(df, quality.fit(df, rated.limit(0), F.col("grade"))).collect()
    assert {(r.expected_grade, r.selected) for r in none} == {(0.0, False)}


@pytest.mark.parametrize("bound", [40_000, 40])
def test_toxicity_learns_from_all_chains_that_fit(spark, monkeypatch, bound):
    clean = [(i, f"garo{i} velin mosta.") for i in range(100)]
    bad = [(1000 + i, "vilefoul prune kalet.") for i in range(60)]
    docs = spark.createDataFrame(clean + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in clean + bad], "doc_id long, toxic int")
    given = []
    real = toxicity.fit_field
    monkeypatch.setattr(toxicity, "fit_field", lambda f, c, y: given.append((c, y)) or real(f, c, y))
    toxicity.fit(docs, labels, max_chains=bound)
    (chain, y), = given
    hot = np.add.reduceat(y, chain[:-1]) > 0
    assert ((~hot).sum(), hot.sum()) == ((100, 60) if bound > 160 else (20, 20))
