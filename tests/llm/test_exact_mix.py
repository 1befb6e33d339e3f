"""Exact dedup by chunk recipes and mixing by apportionment."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from devicelife.llm import chunk_dedup, mixing

SCHEMA = "doc_id long, text string, source string, keep_id string"


def texts():
    rng = random.Random(3)
    long = " ".join(rng.choice(["stone", "cedar", "luck\t", "ócté", "zz", "kelp\n"]) for _ in range(9000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (1, "a b"), (2, "ab"), (3, "a  b"), (3, "a  b"), (None, "a  b"), (4, "a b"),
            (8, long), (9, long + "  "), (10, long[:-1] + "q"), (11, "x" * 5000), (12, "x" * 5000), (13, "x" * 4999)]
    rows += [(100 + i, "copy of one text " * 20 + " " * (i % 3)) for i in range(300)]
    return rows


def brute(rows):
    norm = lambda t: "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    return {n: (min(g)[2], len(g)) for n, g in groups.items()}, norm


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_groups(spark, clashing):
    import hashlib
    rows = texts()
    want, norm = brute(rows)
    df = spark.createDataFrame([(i, t, "s", "own") for i, t in rows], SCHEMA)
    extra = {"chunk_hash": lambda c: (F.length(c) % 3).cast("long")} if clashing else {}
    got = chunk_dedup.exact_groups(df, **extra).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(n.encode()).hexdigest(): v for n, v in want.items()}
    assert {g.text_sha256 for g in got} == set(by_sha)
    for g in got:
        assert (g.keep_id, g.group_size) == by_sha[g.text_sha256]
    assert sum(g.kept for g in got) == len(want)           # repeated rows: one stays
    assert all(g.keep_id == g.doc_id for g in got if g.kept)


def test_chunks_are_content_defined(spark):
    long = texts()[9][1]
    df = spark.createDataFrame([(1, long), (2, "new words in front " + long)], "doc_id long, text string")
    cut = df.select(chunk_dedup.chunks(chunk_dedup.normalised(), 128, 1024, chunk_dedup.BOUNDARY).alias("c"),
                    chunk_dedup.normalised().alias("n")).collect()
    for r in cut:
        assert "".join(r.c) == r.n and max(map(len, r.c)) <= 1026
    shared = set(cut[0].c) & set(cut[1].c)
    assert len(shared) > 0.8 * len(cut[0].c)


def test_exact_groups_of_nothing(spark):
    assert chunk_dedup.exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def dealt(shares, seats):
    won = [0] * len(shares)
    for _ in range(seats):
        q = [(-s / (2 * k + 1), i) for i, (s, k) in enumerate(zip(shares, won)) if s > 0]
        won[min(q)[1]] += 1
    return won


@pytest.mark.parametrize("seats", [0, 2, 1003])
def test_highest_quotients(spark, seats):
    rng = random.Random(seats)
    shares = [rng.choice([0, 1, 2, 5, 5, 90, 3000]) for _ in range(23)]
    df = spark.createDataFrame([(i, float(s), seats) for i, s in enumerate(shares)], "i long, s double, n long")
    got = {r.i: r.quota for r in mixing.sainte_lague(df, "s", "n", ["i"]).collect()}
    assert [got[i] for i in range(23)] == dealt(shares, seats)


def filled(sizes, weights, total, cap):
    """Targets by raising the level source by source."""
    t = [0.0] * len(sizes)
    open_ = {i for i in range(len(sizes))}
    left = total
    while open_:
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if cap * sizes[i] < left * weights[i] / w - 1e-9}
        if not over:
            for i in open_:
                t[i] = left * weights[i] / w
            break
        for i in over:
            t[i] = cap * sizes[i]
            left -= t[i]
        open_ -= over
    return t


def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(400):
        s = rng.choice(["hot"] * 5 + ["a", "b", "Z", None, "é"])
        rows.append((i, None if i % 37 == 0 else " ".join(["w"] * rng.choice([0, 1, 3, 40, 200])), s, "x"))
    return rows + [rows[5]] * 2 + [(None, "one two", "a", "x"), (1000, "lone word", "tiny", "x"), (1001, "w " * 30000, "hot", "x")]


def test_mix(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mixing.mix(df, shard_words=2000, block=16).collect()
    assert len(got) == len(rows)
    size = {s: sum(len((t or "").split()) for _, t, x, _ in rows if x == s) for s in {r[2] for r in rows}}
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weights = [[3, 1, 2][i % 3] for i in range(len(names))]
    want = dict(zip(names, filled([size[s] for s in names], weights, 1.5 * sum(size.values()), 2)))
    source = {}
    for i, t, s, _ in rows:
        source[i, len((t or "").split())] = s
    taken = Counter()
    for g in got:
        s = source[g.doc_id, g["size"]]
        assert g.source_size == size[s] and abs(g.target - want[s]) < 1e-6
        assert 0 <= g.taken <= 2 * g["size"]
        taken[s] += g.taken
    for s in names:
        assert abs(taken[s] - want[s]) <= 16, (s, taken[s], want[s])
    again = mixing.mix(df.repartition(2), shard_words=2000, block=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_copies_spread_over_shards(spark):
    rows = [(1, "w " * 10, "hot", "x")] * 3000 + [(None, None, "hot", "x")] * 500 + [(2, "w " * 50, "a", "x")] * 200
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), shard_words=1000, block=16).collect()
    assert len(got) == len(rows) and all(g.taken <= 2 * g["size"] for g in got)
    for source, of in ((30000, "hot"), (10000, "a")):
        mine = [g for g in got if g.source_size == source]
        assert abs(sum(g.taken for g in mine) - mine[0].target) <= 16, of
    copies = spark.createDataFrame([(1, 10), (2, 1), (3, 7)], "_key long, _copies long")
    numbered = sorted((r["_key"], r["_copy"]) for r in mixing._numbered(copies, chunk=3).collect())
    assert numbered == [(k, c) for k, n in ((1, 10), (2, 1), (3, 7)) for c in range(n)]


def test_words_taken_of_a_document(spark):
    text = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(i, text, s, "x") for i, s in enumerate(["a", "a", "b", "b", "b", "c"])], SCHEMA)
    taken = {r.doc_id: r for r in mixing.mix(df, block=16).collect()}
    out = mixing.mixed_documents(df, block=16).collect()
    for i, r in taken.items():
        mine = [o.text for o in out if o.doc_id == i]
        assert sum(len(t.split()) for t in mine) == r.taken
        for t in mine:
            if t != text:
                want = [w for at, n in r.ranges for w in text.split()[at:at + n]]
                assert t.split() == want and len(t.split("\n")) == len(r.ranges)


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = spark.createDataFrame([(1, "", "s", "x"), (2, None, None, "x")], SCHEMA)
    assert [(r.taken, r.target) for r in mixing.mix(empty).collect()] == [(0, 0.0), (0, 0.0)]
