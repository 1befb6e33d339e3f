"""Near duplicates, suffix dedup, nearest neighbours, HTML extraction and the pipeline, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from devicelife.llm import graph, html_extract, near_dedup, nearest, suffix_dedup
from devicelife.llm.graph import components


def near_rows():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, i = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 40, 90]))]
        for _ in range(rng.choice([1, 3, 6])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                t[rng.randrange(len(t))] = word()
            rows.append((i, " ".join(t)))
            i += 1
    passage = " ".join(word() for _ in range(60))
    rows += [(i + k, " ".join(word() for _ in range(30)) + " " + passage) for k in range(20)]
    return rows + [(500, None), (501, ""), (502, "two words"), (503, "Two  words"), (504, "line again " * 30), (505, "line again " * 25),
                   (506, "x " * 20000), (0, rows[0][1]), (None, "lone row of five words")]


def test_near_groups_equal_brute_force(spark):
    rows = near_rows()
    df = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, kept string")
    got = near_dedup.near_groups(df).collect()
    assert len(got) == len(rows)
    texts = [t or "" for _, t in rows]
    value, weight, at = near_dedup.shingles(texts)
    sets = [(value[at[i]:at[i + 1]], weight[at[i]:at[i + 1]]) for i in range(len(rows))]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            same = " ".join(texts[i].lower().split()) == " ".join(texts[j].lower().split())
            if same or near_dedup.probability_jaccard(*sets[i], *sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    want = {}
    for i, (doc, _) in enumerate(rows):
        want.setdefault(find(i), []).append(doc)
    best = {d: min((x for x in g if x is not None), default=None) for g in want.values() for d in g}
    assert all(r.group_id == best[r.doc_id] for r in got)
    assert near_dedup.near_groups(df.limit(0)).count() == 0


def edited_copies(n, seed):
    """Copies of one text of 150 words, a line of ten words in it three times more, with up to eight edits each."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    base += base[10:20] * 3
    texts = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(9)):
            k, edit = rng.randrange(len(t)), rng.choice("wwdi")
            t[k:k + (edit != "i")] = [] if edit == "d" else [word()]
        texts.append(" ".join(t + base[10:20] * (rng.random() < 0.3)))
    return texts


def test_many_near_copies_leave_few_pairs(spark, monkeypatch):
    texts = edited_copies(400, 2)
    seen, verify = [], near_dedup._verified_together
    monkeypatch.setattr(near_dedup, "_verified_together", lambda pairs, *a, **k: seen.append(pairs.count()) or verify(pairs, *a, **k))
    got = {r.doc_id: r.group_id for r in near_dedup.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    value, weight, at = near_dedup.shingles(texts)
    sets = [(value[at[i]:at[i + 1]], weight[at[i]:at[i + 1]]) for i in range(len(texts))]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and near_dedup.probability_jaccard(*sets[i], *sets[j]) >= 0.8:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    assert [got[i] for i in range(len(texts))] == group
    assert 100 < len(set(group)) < 300
    assert sum(seen) < 10_000                                # all that lie apart: over 30,000


def test_shared_differences_bound_the_similarity():
    texts = edited_copies(80, 5) + [" ".join(t.split()[:k] * 2) for t, k in zip(edited_copies(12, 6), range(70, 130, 5))]
    value, weight, at = near_dedup.shingles(texts)
    sets = [(value[at[i]:at[i + 1]], weight[at[i]:at[i + 1]]) for i in range(len(texts))]
    for centre in (0, 7, 85):
        apart = [near_dedup.differences(*s, *sets[centre]) for s in sets]
        for i in range(len(texts)):
            for j in range(i):
                (p, v), (q, w), x, y = apart[i], apart[j], sets[i][1].sum(), sets[j][1].sum()
                common = (x + y - len(p) - len(q)) / 2 + len(np.intersect1d(p, q))
                _, a, b = np.intersect1d(sets[i][0], sets[j][0], return_indices=True)
                assert common == np.minimum(sets[i][1][a], sets[j][1][b]).sum()
                s = near_dedup.probability_jaccard(*sets[i], *sets[j])
                assert common >= s * min(x, y) - 1e-6
                assert (1 + s) * common >= s * (x + y) - (v + w) * (max(x, y) / min(x, y) - s) - 1e-6


def test_probability_jaccard():
    x, y = np.array([3.0, 1, 0, 2]), np.array([1.0, 1, 4, 0])
    want = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(4)) for i in range(4) if x[i] and y[i])
    name = np.arange(4, dtype=np.uint64)
    assert near_dedup.probability_jaccard(name[x > 0], x[x > 0], name[y > 0], y[y > 0]) == pytest.approx(want)


def test_signatures_estimate_it():
    a, b = " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" if i % 40 else "q" for i in range(400))
    value, weight, at = near_dedup.shingles([a, b])
    sig = near_dedup.signatures(value, weight, at, 2000)
    exact = near_dedup.probability_jaccard(value[:at[1]], weight[:at[1]], value[at[1]:], weight[at[1]:])
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (100, 95), (95, 97), (200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 90 for i in (90, 95, 97, 100)}}


def test_components_of_random_graphs(spark, monkeypatch):
    for few in (20_000, 3):                                  # minima broadcast, minima shuffled
        monkeypatch.setattr(graph, "FEW", few)
        for seed in range(2):
            rng = random.Random(seed)
            edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
            edges += edges[:50] + [(400, 400), (None, 7), (7, None), (None, None)] + [(500, k) for k in range(501, 540)]
            low = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}
            for _ in range(300):
                for u, v in edges:
                    if u in low and v in low:
                        low[u] = low[v] = min(low[u], low[v])
            frame = spark.createDataFrame(edges, "a long, b long")
            got = components(frame).collect()
            assert len(got) == len(low) and {r.node: r.component for r in got} == low
            found, n = graph.roots(frame)
            assert {r.node: r.component for r in found.collect()} == {k: v for k, v in low.items() if k != v} and found.count() == n
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def tasks_of(spark, run):
    """How many tasks the jobs of ``run`` completed."""
    sc = spark.sparkContext

    def mark():
        sc.setJobGroup("mark", "")
        spark.range(1, numPartitions=1).rdd.count()
        tracker = sc.statusTracker()
        return max(s for j in tracker.getJobIdsForGroup("mark") for s in tracker.getJobInfo(j).stageIds)
    first = mark()
    run()
    infos = [sc.statusTracker().getStageInfo(s) for s in range(first + 1, mark())]
    return sum(i.numCompletedTasks for i in infos if i is not None)


def test_small_graphs_take_few_tasks(spark):
    """Each task that feeds a shuffle leaves files on disk, however small: a few edges must not make thousands."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found: list = []
        frame = spark.createDataFrame([(i, i // 2) for i in range(1, 60)], "a long, b long")
        n = tasks_of(spark, lambda: found.extend(components(frame).collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.node: r.component for r in found} == {i: 0 for i in range(60)}
    assert n < 64 * 30, n


def brute_suffix(rows):
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    seen, out = set(), {}
    for doc, t in order:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen:
                gone[k:k + 100] = True
            seen.add(raw[k:k + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc, t] = (len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_equals_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    letters = lambda n, a="abcdefghé ": "".join(rng.choice(a) for _ in range(n))
    passages = [letters(n) for n in (99, 100, 101, 130, 400)]
    line = letters(60)
    rows = [(i, "".join(rng.choice([letters(rng.randint(1, 150)), rng.choice(passages), line]) for _ in range(rng.randint(1, 9)))) for i in range(90)]
    rows += [(200, "a" * 700), (201, "ab" * 300), (202, None), (203, ""), (204, passages[1]), (205, letters(3000, "ab")), (206, letters(40_000)),
             (7, passages[4] + "other"), rows[3], (None, passages[4] + "z"), (300, line + letters(200) + line * 5)]
    df = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, n_bytes string").repartition(4)
    want = brute_suffix(rows)
    got = suffix_dedup.dedup(df).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == sorted(str((d, *want[d, t])) for d, t in rows)
    # the same with every open bucket split as a hot one
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    hot = suffix_dedup.dedup(df.filter("doc_id <> 7")).collect()
    want = brute_suffix([r for r in rows if r[0] not in (7, None)])
    assert all((r.n_bytes, r.n_removed, r.n_spans) in {v[:3] for k, v in want.items() if k[0] == r.doc_id} for r in hot)
    assert suffix_dedup.dedup(df.limit(0)).count() == 0


def test_refinement_names_equal_strings():
    rng = random.Random(1)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(100, 170))) for _ in range(6)]
    parts += [parts[0][10:140] if len(parts[0]) >= 140 else parts[0], "a" * 160]
    data = "".join(parts).encode()
    at, number = suffix_dedup.refine(data, np.array([len(p) for p in parts]))
    names = {}
    for p, n in zip(at.tolist(), number.tolist()):
        assert names.setdefault(n, data[p:p + 100]) == data[p:p + 100]
    assert len(set(names.values())) == len(names)


def test_only_strings_that_share_a_hash_are_refined(monkeypatch):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    common = word(130)
    parts = [word(rng.randint(100, 176)) for _ in range(300)] + [word(20) + common + word(20) for _ in range(50)]
    data, size = "".join(parts).encode(), np.array([len(p) for p in parts])
    refined, real = [], suffix_dedup._pointers
    monkeypatch.setattr(suffix_dedup, "_pointers", lambda d, s: (refined.append(len(d)), real(d, s))[1])

    def exact():
        at, number = suffix_dedup.refine(data, size)
        strings = [data[p:p + 100] for p in at.tolist()]
        assert len(at) == sum(n - 99 for n in size) and len(set(zip(strings, number.tolist()))) == len(set(strings)) == len(set(number.tolist()))

    exact()
    assert sum(refined) < len(data) / 5                # around the piece they share, not the other bytes
    refined.clear()
    # strings that only share the hash are told apart
    monkeypatch.setattr(suffix_dedup, "_window_hash", lambda raw, at: at % 7)
    exact()
    assert refined == [len(data)]
    monkeypatch.undo()
    assert len(set(suffix_dedup.refine(parts[0].encode(), size[:1])[1].tolist())) == size[0] - 99


def test_nearest(spark):
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(size=(1500, 16)), np.repeat(rng.normal(size=(1, 16)), 700, axis=0)])
    rows = [(i, v.tolist(), "own") for i, v in enumerate(vectors)]
    rows += [(3000, None, "x"), (3100, [0.0] * 16, "x"), (3200, [1.0] * 15 + [None], "x"), (3300, [float("nan")] * 16, "x"),
             (3400, [1.0, 2.0], "x"), (None, [1.0] * 16, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = nearest.neighbours(df, F.col("id") % 100 == 0, block_rows=300, cell_rows=100).toPandas()
    found = 0
    for q in range(0, 2200, 100):
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(d)), d))[:10]
        own = got[got.query_id == q].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 11)) and np.allclose(own.score, d[own.vec_id])
        found += len(set(best) & set(own.vec_id))
    assert found >= 0.95 * 220 and set(got.query_id) == set(range(0, 2200, 100))
    # equal distances: the 700 copies have the smallest ids first
    assert list(got[got.query_id == 1600].sort_values("rank").vec_id) == list(range(1500, 1510))
    assert (got[got.query_id == 1600].score == 0).all()
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert nearest.neighbours(few, F.col("id") % 100 == 0).groupBy("query_id").count().collect()[0]["count"] == 2
    assert nearest.neighbours(few.limit(0), F.col("id") % 100 == 0).count() == 0


def test_nearest_of_repeated_ids(spark):
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [5.0, 5.0]), (7, [1.0, 0.5]), (7, [1.0, 0.5]), (8, [1.0, 0.5]), (9, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.neighbours(df, F.col("id") % 100 == 0, k=3).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(100, 1, 7, 0.5), (100, 2, 7, 0.5), (100, 3, 8, 0.5)]


def test_chi_square():
    assert nearest.chi_square(np.array([20.0902]), 8)[0] == pytest.approx(0.99, abs=1e-4)
    assert nearest.chi_square_quantile(0.95, 2) == pytest.approx(5.9915, abs=1e-3)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="top"><a href=/>Home</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><div class="cookie-notice">We use cookies a lot here</div>
<div id=main><h1>The &amp; title</h1><p>First <b>bo</b>ld &eacute;&#33;<br>second
line<p>Third one, with <a href=x>a link</a> inside.<div class="ad">Buy now please</div><script>x()</script><form><input>Mail</form>
<ul><li>item one</li><li>item two</li></ul><p>Closing words of the text.</p></div>
<section id="comments"><p>I do not agree at all with this</p></section><aside>More</aside><footer>&copy; us</footer></body></html>"""


def test_html(spark):
    want = "The & title First bold é! second line Third one, with a link inside. item one item two Closing words of the text."
    assert html_extract.extract(PAGE, {}) == want
    marked = PAGE.replace("<div id=main>", "<article>").replace("text.</p></div>", "text.</p></article>")
    pages = [(1, "u", marked, "own"), (1, "u", marked, "own"), (2, "v", None, "x"), (3, None, "", "x"), (None, "w", "<p>only <i", "x"),
             (5, "y", "<p>" + "word " * 30000, "x"), (6, "z", "<ul><li><a href=1>menu</a></ul>", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    weights = html_extract.fit(df)
    assert weights["w:p"] > 0 > weights["x:footer"] and weights["footer"] < weights["p"] < 0
    got = {r.page_id: r.text for r in html_extract.extract_pages(df, weights).collect()}
    assert got[1] == want and got[2] == got[3] == "" and got[None] == "only" and got[5] == ("word " * 30000).strip()


def test_region_is_the_best_run():
    rng = random.Random(4)
    for _ in range(200):
        tokens = [rng.choice([("w:p", "a b", False, False), ("p", "\n", False, False), ("w:li:a", "c", False, False)]) for _ in range(rng.randint(0, 12))]
        weights = {"w:p": 0.5, "p": -0.7, "w:li:a": -1.0}
        score = [weights[t[0]] * (len(t[1].split()) if ":" in t[0] else 1) for t in tokens]
        lo, hi = html_extract.region(tokens, weights)
        best = max([0.0, *(sum(score[i:j]) for i in range(len(score)) for j in range(i + 1, len(score) + 1))])
        assert sum(score[lo:hi]) == pytest.approx(best)


def test_pipeline_stages(spark):
    import corpus_pipeline as C
    rows = [(i, t, "en", f"s{i % 3}" if i else None, len(t or ""), "own") for i, (d, t) in enumerate(near_rows())]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, source string, n_chars long, kept string")
    sizes = []
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, "").cache()
        sizes.append(out.count())
        if k < 4:
            assert out.columns == docs.columns
            docs = out
    assert sizes[0] >= sizes[1] > sizes[2] > 0 and sizes[4] == sizes[3]


LONG = "The river rose in the night and the town woke to water in every street."


@pytest.mark.parametrize("page", [
    f"<body><div class='page has-sidebar'><article><p>{LONG}</p></article></div></body>",
    f"<body><div class='post no-comments'><p>{LONG}</p></div></body>",
    f"<body><div class='sidebar'><main><p>{LONG}</p></main></div></body>",
    f"<body><div id='search'><p>{LONG}</p></div></body>",
    f"<body><p>{LONG}</p><svg class='i'/><nav>Home</nav></body>",
])
def test_html_keeps_articles_in_named_wrappers(page):
    assert html_extract.extract(page, {}) == LONG


@pytest.mark.parametrize("part", [
    "<section id='discussion'><p>Kept too.</p></section>", "<section class='open-discussion'><p>Kept too.</p></section>", "<h2 id='related'>Kept too.</h2>", "<h2 id='search'>Kept too.</h2>",
    "<p>Kept <a href='/hidden-costs'>too.</a></p>", "<p title='the hidden valley'>Kept too.</p>",
    "<p>Kept <a href='/q?id=search'>too.</a></p>", "<p data-id='tags'>Kept too.</p>", "<p>Kept <svg/>too.</p>"])
def test_html_keeps_parts_of_articles(part):
    assert html_extract.extract(f"<body><article><p>{LONG}</p>{part}<p>{LONG}</p></article></body>", {}) == f"{LONG} Kept too. {LONG}"


@pytest.mark.parametrize("part", ["<div class='box ad'>Buy now.</div>", "<div hidden>Buy now.</div>", "<div id=comments>Buy now.</div>",
                                  "<div style='display: none'>Buy now.</div>", "<div class='a' aria-hidden='true'>Buy now.</div>"])
def test_html_drops_marked_parts(part):
    assert html_extract.extract(f"<body><article><p>{LONG}</p>{part}<p>{LONG}</p></article></body>", {}) == f"{LONG} {LONG}"


def test_html_drops_a_long_advert_beside_a_short_article():
    assert html_extract.extract(f"<body><div class='ad'>{LONG}</div><article><p>Rain.</p></article></body>", {}) == "Rain."


COMPOUND = ["ad-container", "comments-list", "sidebar-left", "related-posts", "cookie-bar", "ad-slot", "comment-section", "site-footer", "social-links",
            "newsletter-box", "promo-block", "main-menu", "user-comments", "adBox", "ad1"]


@pytest.mark.parametrize("learned", [False, True])
def test_html_compound_names_and_names_of_topics(spark, learned):
    weights = html_extract.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")) if learned else {}
    body = "<p>" + "one two three four five six seven eight nine ten. " * 4 + "</p>"
    want = " ".join(("one two three four five six seven eight nine ten. " * 4).split())
    for name in COMPOUND:
        box = f"<div class='{name}'><p>{'buy these great shoes now and save a lot today ' * 6}</p></div>"
        for page in (f"<body><article>{body}{box}{body}</article></body>", f"<body><article>{body}{body}</article>{box}</body>",
                     f"<body><div class='page has-sidebar no-comments'><article>{body}{box.replace('class', 'id')}{body}</article></div></body>"):
            assert html_extract.extract(page, weights) == f"{want} {want}", (name, page[:60])
    for kept in ("<p class='search'>", "<section class='copyright'>", "<section id='discussion'>", "<h2 id='related'>", "<div class='shadow download headline'>"):
        close = kept.split()[0].replace("<", "</") + ">"
        page = f"<body><article>{body}{kept}searching for words and more words{close}{body}</article></body>"
        assert "searching for words" in html_extract.extract(page, weights), kept
    behind = f"<body><article>{body}</article><p>a stray line about this site and its terms</p></body>"
    assert html_extract.extract(behind, weights) == want
