"""Embedding joins, neighbours, near-duplicates and components against brute force."""

import itertools
import math

import numpy as np
import pytest

from verisift.llm import graphs, metric_join, neighbours, ngram_join


def vectors(seed=1, n=400, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    x = centres[rng.integers(0, 8, n)] + rng.normal(scale=0.25, size=(n, dim)) * rng.choice([0.2, 1.0, 2.0], n)[:, None]
    x[50:60] = x[49]
    return x.astype(np.float32), rng.integers(0, 3, n)


BAD = [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [float("nan")] + [1.0] * 15, 1), (9004, [float("inf")] + [1.0] * 15, 1), (9005, [None] + [1.0] * 15, 1), (9006, [], 1), (9007, [1.0, 2.0], 1), (9008, [1.0, 2.0], 1)]


def brute_components(ids, linked):
    low = dict(zip(range(len(ids)), range(len(ids)), strict=True))

    def find(a):
        while low[a] != a:
            a = low[a]
        return a

    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = find(i), find(j)
        low[max(a, b)] = min(a, b)
    best = {}
    for k, i in enumerate(ids):
        best[find(k)] = min(best.get(find(k), i), i)
    return [best[find(k)] for k in range(len(ids))]


def test_metric_join(spark):
    x, label = vectors()
    rows = [(i, v.tolist(), int(c), 1) for i, (v, c) in enumerate(zip(x, label, strict=True))]
    rows += [(*b, 1) for b in BAD] + [(9009, x[0].tolist(), None, 1), (3, x[3].tolist(), int(label[3]), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links int").repartition(4)
    got = metric_join.range_join(df).toPandas()
    assert len(got) == len(rows)
    x2, label2, ids = np.vstack([x, x[3]]).astype(float), np.r_[label, label[3]], [*range(400), 3]
    u = x2 / np.linalg.norm(x2, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (label2[:, None] == label2[None])
    np.fill_diagonal(linked, False)
    comp = brute_components(ids, linked)
    own = got[got.vec_id < 9000].sort_values("vec_id")
    want = sorted(zip(ids, linked.sum(1).tolist(), comp, strict=True))
    assert [tuple(map(int, t)) for t in own[["vec_id", "n_links", "component_id"]].itertuples(index=False)] == want
    rest = got[got.vec_id > 9000].set_index("vec_id")
    assert rest.loc[9007, "n_links"] == 1 and rest.loc[9008, "component_id"] == 9007 and not rest.loc[9008, "kept"]
    assert (rest.drop([9007, 9008]).n_links == 0).all() and rest.drop(9008).kept.all()
    assert metric_join.range_join(df.limit(0)).count() == 0


def test_every_close_pair_meets_in_one_cell():
    x, _ = vectors(2)
    u = metric_join.unit(x.astype(float))
    for radius, n in itertools.product((0.1, 0.374, 0.9), (1, 5, 20)):
        home, who, where = metric_join.homes_and_guests(u, u[:n], radius)
        visits = set(zip(who.tolist(), where.tolist(), strict=True))
        assert not any(home[i] == c for i, c in visits)
        d = np.sqrt(np.maximum(0, 2 - 2 * u @ u.T))
        for i, j in zip(*np.nonzero(np.triu(d <= radius, 1)), strict=True):
            # in one cell only, as residents or as resident and guest
            assert (home[i] == home[j]) + ((i, home[j]) in visits) + ((j, home[i]) in visits) == 1


@pytest.mark.parametrize(("block", "cell", "least"), [(4096, 1024, 0), (50, 1024, 0), (50, 20, 2), (7, 20, 2), (4096, 5, 20)])
def test_metric_join_in_cells_and_blocks(spark, monkeypatch, block, cell, least):
    monkeypatch.setattr(metric_join, "BLOCK", block)
    monkeypatch.setattr(metric_join, "CELL", cell)
    used = []
    choose = metric_join.choose_pivots
    monkeypatch.setattr(metric_join, "choose_pivots", lambda c: used.append(choose(c)) or used[0])
    x, _ = vectors(3, 200)
    df = spark.createDataFrame([(i, v.tolist(), "ab"[i % 7 == 0]) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label string")
    u = metric_join.unit(x.astype(float))
    label = np.arange(200) % 7 == 0
    linked = (u @ u.T >= 0.8) & (label[:, None] == label[None])
    got = metric_join.range_join(df, 0.8).orderBy("vec_id").toPandas()
    assert got.n_links.tolist() == (linked.sum(1) - 1).tolist()
    assert got.component_id.tolist() == brute_components(list(range(200)), linked)
    assert sum(len(p) for p in used[0].values()) >= least and (least == 0) == (not used[0])


def test_vectors_of_any_magnitude_link(spark):
    v = [[3.0, 4.0, 0.5], [3.1, 4.0, 0.5]]
    rows = [(10 * k + i, [c * s for c in w], 1) for k, s in enumerate((1.0, 1e200, 1e-200, 1e307)) for i, w in enumerate(v)]
    got = metric_join.range_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).toPandas()
    assert (got.n_links == 7).all() and (got.component_id == 0).all()


def test_neighbours_recall_and_form(spark):
    x, _ = vectors(4, 1500)
    rows = [(i, v.tolist(), 5.0) for i, v in enumerate(x)] + [(*b[:2], 5.0) for b in BAD] + [(None, x[7].tolist(), 5.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double").repartition(4)
    got = neighbours.search(df, df.vec_id % 50 == 0).toPandas()
    y, ids = np.vstack([x, x[7]]).astype(float), np.array([*range(1500), -1])
    hit = 0
    for q in range(0, 1500, 50):
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[q] = np.inf
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        assert own.score.is_monotonic_increasing
        exact = np.sort(d)[:10]
        hit += int((own.score.values <= exact[-1] * (1 + 1e-12)).sum())
        for v, s in zip(own.vec_id.fillna(-1).astype(int), own.score, strict=True):
            assert s == d[v]
    assert hit / (30 * 10) >= 0.9
    assert set(got.query_id) == set(range(0, 1500, 50))
    assert neighbours.search(df.limit(0), df.vec_id % 50 == 0).count() == 0


def brute_neighbours(x, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        out[q] = np.sort(d)[k - 1]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_neighbours_recall_on_embeddings(spark, monkeypatch, small):
    if small:  # many regions, blocks and lots of queries
        monkeypatch.setattr(neighbours, "BLOCK", 90)
        monkeypatch.setattr(neighbours, "QUERIES", 6)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").toPandas()
    x, ids = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy()
    place = {v: k for k, v in enumerate(ids)}
    queries = [v for v in ids if v % 20 == 0]
    got = neighbours.search(df, df.vec_id % 20 == 0).toPandas()
    edge = brute_neighbours(x, [place[q] for q in queries])
    hit = sum(int((own.score.to_numpy() <= edge[place[q]] * (1 + 1e-12)).sum()) for q, own in got.groupby("query_id"))
    assert got.groupby("query_id").size().eq(10).all() and got.query_id.nunique() == len(queries)
    assert hit / (10 * len(queries)) >= 0.9


def test_a_query_visits_only_part_of_the_buckets():
    x = np.random.default_rng(3).normal(size=(4000, 32))
    model = neighbours.Hashing(x, 1, 4000)
    model.fit(x[:50], [x[k : k + 1] + 0.05 for k in range(50)])
    visited = model.probes(x[:100], 0)
    assert (visited.sum(1) >= 1).all() and visited.mean() < 0.2
    assert visited[np.arange(100), model.buckets(x[:100], 0)].mean() > 0.9


def test_neighbours_ties_and_few_candidates(spark):
    same = [(i, [1.0, 1.0, 0.5]) for i in range(30)] + [(100, [9.0, 9.0, 9.0]), (200, [1.0, 2.0]), (203, [2.0, 2.0])]
    df = spark.createDataFrame(same, "vec_id long, embedding array<double>")
    got = neighbours.search(df, df.vec_id % 100 == 0).toPandas()
    assert got[got.query_id == 0].sort_values("rank").vec_id.tolist() == list(range(1, 11))
    assert got[got.query_id == 100].sort_values("rank").vec_id.tolist() == list(range(10))
    assert got[got.query_id == 200].vec_id.tolist() == [203]


def documents():
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{k}" for k in rng.integers(0, 5000, n)]
    texts = [" ".join(word(int(n))) for n in rng.integers(1, 300, 60)]
    base = word(200)
    for k in range(60):
        copy = list(base)
        for at in rng.integers(0, 200, k % 12):
            copy[at] = "changed"
        texts.append(" ".join(copy))
    texts += [texts[0]] * 5 + ["", " ", "one two", "one two", "a b c d e", "a b c d e f", "long " * 30000, "long " * 30001]
    return texts


def brute_jaccard(texts, threshold=0.8):
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    n = len(texts)
    linked = np.zeros((n, n), bool)
    for i, j in itertools.combinations(range(n), 2):
        both = len(sets[i] & sets[j])
        linked[i, j] = linked[j, i] = both > 0 and both >= threshold * (len(sets[i]) + len(sets[j]) - both)
    return linked


@pytest.mark.parametrize("block", [1024, 16])
def test_ngram_join(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = documents()
    ids = [1000 - k for k in range(len(texts))]
    rows = [*zip(ids, texts, strict=True), (5, None), (None, texts[0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class_id int").repartition(4)
    got = ngram_join.join(df).toPandas()
    linked = brute_jaccard(texts)
    want = sorted(zip(ids, linked.sum(1).tolist(), brute_components(ids, linked), strict=True))
    own = got[got.doc_id > 5].sort_values("doc_id")
    assert [tuple(map(int, t)) for t in own[["doc_id", "n_links", "class_id"]].itertuples(index=False)] == want
    assert got[got.doc_id == 5].n_links.tolist() == [0] and got[got.doc_id.isna()].n_links.tolist() == [0]
    if block == 16:
        kept = ngram_join.dedup(df)
        assert kept.columns == df.columns
        assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted({0, 5, *(c for _, _, c in want)})
        assert ngram_join.join(df.limit(0)).count() == 0


def test_repeated_rows_are_copies(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "x y z")], "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.join(df).collect()))
    assert got == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]
    assert sorted(r["doc_id"] for r in ngram_join.dedup(df).collect()) == [1, 2]


def test_dedup_keeps_distinct_texts_that_share_an_id(spark):
    word = lambda p: " ".join(f"{p}{k}" for k in range(200))
    rows = [(1, word("a")), (2, word("a") + " x"), (2, word("b")), (3, word("c")), (3, word("d")), (3, word("d")), (4, word("e")), (4, word("e") + " x"), (5, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in ngram_join.dedup(df).collect()]
    assert sorted(t for i, t in got if i in (1, 2, 3)) == [word(p) for p in "abcd"]
    assert sum(i == 4 for i, _ in got) == 1 and sum(i == 5 for i, _ in got) == 2


def test_pruning_keeps_what_is_similar():
    rng = np.random.default_rng(6)
    lost = 0
    for _ in range(200):
        a = rng.integers(0, 1 << 32, (1, ngram_join.HASHES), dtype=np.uint32)
        b = a.copy()
        flip = rng.random(ngram_join.HASHES) > 0.82
        b[0, flip] += 1
        lost += len(ngram_join.prune(a, b, 0.8, False)[0]) == 0
    assert lost <= 1
    far = rng.integers(0, 1 << 32, (50, ngram_join.HASHES), dtype=np.uint32)
    assert len(ngram_join.prune(far, far, 0.8, True)[0]) == 0
    assert ngram_join.least_matches(0.8) == tuple(sorted(ngram_join.least_matches(0.8)))


def test_bit_filter_passes_its_own(spark):
    from pyspark.sql import functions as F

    df = spark.range(500).select(F.xxhash64("id").alias("h1"))
    table = ngram_join.bit_filter(df)
    both = spark.range(20000).select("id", F.xxhash64("id").alias("h1")).select("id", *[F.shiftrightunsigned(F.xxhash64(F.lit(k), "h1"), 40).alias(f"p{k}") for k in range(ngram_join.FILTER_HASHES)]).toPandas()
    ok = ngram_join.passes(table, [both[f"p{k}"].to_numpy() for k in range(ngram_join.FILTER_HASHES)])
    assert ok[:500].all() and ok[500:].mean() < 0.01


def test_components_of_stars_and_paths(spark):
    edges = [(k + 1, k) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 5001), (5001, 5000), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in graphs.components(df).collect()}
    assert all(got[k] == 0 for k in range(301)) and all(got[k] == 1000 for k in range(1000, 1400)) and got[5001] == 5000


def test_hot_join_splits_hot_keys(spark):
    left = spark.createDataFrame([(1, i) for i in range(3000)] + [(k, 0) for k in range(2, 50)] + [(999, 1)], "k long, v long")
    right = spark.createDataFrame([(k, k * 10) for k in range(1, 50)], "k long, w long")
    got = graphs.hot_join(left, right, ["k"]).toPandas()
    assert len(got) == 3049 and (got[got.k < 999].w == got[got.k < 999].k * 10).all() and got[got.k == 999].w.isna().all()


def test_pruning_loses_no_more_pairs_than_the_bands():
    p, step = 0.8, ngram_join.STEP
    alive, lost = {0: 1.0}, 0.0
    for need in ngram_join.least_matches(p):
        after = {}
        for m, w in alive.items():
            for k in range(step + 1):
                after[m + k] = after.get(m + k, 0.0) + w * math.comb(step, k) * p**k * (1 - p) ** (step - k)
        lost += sum(w for m, w in after.items() if m < need)
        alive = {m: w for m, w in after.items() if m >= need}
    assert lost <= (1 - p**ngram_join.ROWS) ** ngram_join.BANDS < 1e-7
