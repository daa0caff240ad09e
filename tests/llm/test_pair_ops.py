"""Near-duplicates, embeddings, nearest neighbours, components and the pipeline
against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from registrar.llm import ann, embed_dedup, minhash, queries, toxicity
from registrar.llm.components import components

SF = "/root/testdata/sf0.001"


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)]
    d = spark.createDataFrame([*edges, (1, None), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in components(d).collect()}
    links = [(a, b) for a, b in edges if a != b]
    want = roots({x for e in links for x in e}, links)
    assert got == want
    assert components(d.limit(0)).count() == 0


# ------------------------------------------------------- near duplicates

def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    n = len(words)
    return frozenset(tuple(words[i:i + min(k, n)]) for i in range(n - min(k, n) + 1)) if n else frozenset()


def brute(texts, k):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    links = []
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= 80 * (len(x) + len(y) - both):
                links.append((a, b))
    r = roots(sets, links)
    return {i: (len(sets[i]), r[i]) for i in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, k):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in d.collect()}
    rng = random.Random(k)
    for i in range(60):  # near copies of one text, by different shares of changed words
        words = " ".join(f"w{j}" for j in range(150)).split()
        for _ in range(rng.randrange(0, 14)):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        texts[10_000 + i] = " ".join(words)
    rows = spark.createDataFrame([(i, t, 1, "z") for i, t in texts.items()], "doc_id long, text string, rep int, leader string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(rows, minhash.Settings(shingle=k)).collect()}
    assert got == brute(texts, k)


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng, texts = random.Random(5), {}
    for i in range(80):
        words = [f"w{j}" for j in range(60)]
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(60)] = f"n{rng.random()}"
        texts[i] = " ".join(words)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(rows, minhash.Settings(shingle=2)).collect()}
    assert got == brute(texts, 2)


def test_near_duplicates_of_odd_texts(spark):
    long = " ".join(str(i) for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (9, "One"), (8, "one"), (10, "one two"), (11, "ONE  two"), (None, "one"), (12, long),
            (13, long + " end"), (9, "One"), (14, "ÉA b"), (15, "éA b"), (16, "a\x1cb"), (17, "a b")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(d, minhash.Settings(shingle=2)).collect())
    want = [(-1, 1, None, None), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 8, True), (9, 1, 8, False), (9, 1, 8, False),
            (10, 1, 10, True), (11, 1, 10, False), (12, 29_999, 12, True), (13, 30_000, 12, False), (14, 1, 14, True), (15, 1, 15, True),
            (16, 1, 16, True), (17, 1, 17, True)]
    assert out == want
    assert minhash.near_duplicates(d.limit(0)).count() == 0


def test_estimate_is_near_jaccard():
    s, rng = minhash.Settings(), np.random.default_rng(0)
    prefer = minhash.preferences(s.registers)
    for n, shared in ((400, 320), (3000, 2000), (40, 30)):
        got = []
        for _ in range(40):
            x = rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64)
            a, b = (minhash.sketch_of(h, s.registers, prefer) for h in (x[:n], x[n - shared:]))
            got.append(minhash.estimate(np.array((a == b).mean())))
        j = shared / (2 * n - shared)
        assert abs(np.mean(got) - j) < 0.03
    assert 0 < minhash.COLLISIONS < 2 ** -minhash.MANTISSA


# ------------------------------------------------------------- embeddings

VECTORS = "vec_id long, embedding array<float>, label int, key string, v int"


def vector_rows(seed=0, groups=12, size=14, dims=16):
    rng, rows, i = np.random.default_rng(seed), [], 0
    for g in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(size):
            v = centre + rng.normal(size=dims) * rng.choice([0, 0.1, 0.25, 0.4])
            rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 3])], int(g % 3)))
            i += 1
    rows += [(i, None, 1), (i + 1, [], 1), (i + 2, [0.0] * dims, 1), (i + 3, [math.nan] * dims, 1), (i + 4, [math.inf] * dims, 0),
             (i + 5, [1.0, None] + [0.0] * (dims - 2), 0), (i + 6, rows[0][1], None), (i + 7, rows[0][1], rows[0][2]), (i + 8, rows[0][1], rows[0][2])]
    return rows


def usable(r):
    return r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])


def test_embedding_links_equal_brute_force(spark):
    rows = vector_rows()
    d = spark.createDataFrame([(*r, "k", 0) for r in [*rows, rows[3]]], VECTORS)
    out = embed_dedup.near_duplicates(d, embed_dedup.Settings(window=32, passes=10)).collect()
    x = {r[0]: np.array(r[1], dtype=float) / np.linalg.norm(r[1]) for r in rows if usable(r) and r[2] is not None}
    label = {r[0]: r[2] for r in rows}
    links = [(a, b) for a, b in itertools.combinations(x, 2) if label[a] == label[b] and x[a] @ x[b] >= 0.93]
    n = {r[0]: 0 for r in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    comp = roots([r[0] for r in rows], links)
    assert len(out) == len(rows) + 1
    for r in out:
        assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], comp[r.vec_id], comp[r.vec_id] == r.vec_id)
    assert embed_dedup.near_duplicates(d.limit(0)).count() == 0


def test_embedding_group_larger_than_the_window(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    rows = [(i, [float(x) for x in base + 0.02 * rng.normal(size=16)], 0, "k", 0) for i in range(150)]
    out = embed_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), embed_dedup.Settings(window=16)).collect()
    assert all(r.n_links == 149 and r.component_id == 0 for r in out)


def nearest(rows, queries, n):
    ok = [(r[0], np.array(r[1], dtype=float)) for r in rows if usable(r)]
    out = {}
    for k, v in ok:
        if k in queries:
            out[k] = sorted((-(v * w).sum(), i) for i, w in ok if i != k)[:n]
    return out


def test_nearest_neighbours_on_small_tables(spark):
    rows = vector_rows(2)
    d = spark.createDataFrame([(*r, "k", 0) for r in rows], VECTORS)
    is_query = F.col("vec_id") % 5 == 0
    want = nearest(rows, {r[0] for r in rows if r[0] % 5 == 0}, 20)
    out = ann.search(d, is_query).orderBy("query_id", "rank").collect()
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys()
    found = sum(len({i for _, i in got[k]} & {i for _, i in want[k]}) for k in want)
    assert found >= 0.9 * sum(map(len, want.values()))
    for k in got:
        assert got[k] == sorted(got[k]) and len(got[k]) == len(want[k])
    few = ann.search(d.filter("vec_id < 9"), is_query).collect()  # fewer candidates than neighbours
    assert sorted((r.query_id, r.rank) for r in few) == [(q, i) for q in (0, 5) for i in range(1, 9)]
    assert ann.search(d.limit(0), is_query).count() == 0 and ann.search(d, F.lit(False)).count() == 0
    assert ann.search(d.filter("vec_id = 0"), is_query).count() == 0


def test_recall_on_the_embeddings(spark, monkeypatch):
    monkeypatch.setattr(ann, "FILE_ROWS", 16)  # files in parts
    out = queries.op9_permutation_ann(spark, SF).toPandas()
    d = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = nearest([(r.vec_id, list(r.embedding), r.label) for r in d], {r.vec_id for r in d if r.vec_id % 20 == 0}, 20)
    hit = sum(len(set(g["vec_id"]) & {i for _, i in want[q]}) for q, g in out.groupby("query_id"))
    assert hit >= 0.9 * 20 * len(want) and (out.groupby("query_id").size() == 20).all()


def test_short_queries_are_searched_in_blocks(spark):
    rows = vector_rows(6)
    d = spark.createDataFrame([(*r, "k", 0) for r in rows], VECTORS)
    s = ann.Settings(prefix=1, posted=1, files=1)  # one file each: most queries find too few
    got = ann.search(d, F.col("vec_id") % 5 == 0, s).groupBy("query_id").count().collect()
    assert {r["count"] for r in got} == {20}


def test_footrule():
    q, e = np.array([[0, 1, 2]]), np.array([[2, 1, 0], [0, 1, 2], [3, 4, 5]])
    theirs, own = ann.places(e, 6), ann.places(q, 6)
    assert ann.footrule(own[0], theirs).tolist() == [4, 0, 2 + 1 + 0 + 2 + 1 + 0]


@pytest.mark.parametrize("n_pivots, k", [(256, 256), (700, 256), (700, 300), (40, 7)])
def test_farness_ranks_as_the_footrule_from_the_prefix_alone(n_pivots, k):
    rng = np.random.default_rng(k)
    orders = np.array([rng.permutation(n_pivots)[:k] for _ in range(200)])
    theirs = ann.places(orders, n_pivots)
    far, want = ann.farness(orders[0], theirs.T).astype(int), ann.footrule(theirs[0], theirs)
    assert far[0] == far.min() and (2 * (far - far[0]) == want).all()


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.filter("doc_id < 3").withColumn("doc_id", F.lit(None).cast("long"))
    docs = docs.unionByName(docs.filter("doc_id = 5")).unionByName(extra)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names, now = [n for n, _ in corpus_pipeline.STAGES], docs
    assert names == ["toxicity", "quality", "near_duplicates", "packing"]

    def ids(d):
        return sorted((r.doc_id if r.doc_id is not None else -1) for r in d.select("doc_id").collect())

    bad = toxicity.with_score(docs, toxicity.fit(docs, labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)), "p").filter("p >= 0.5")
    after = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert after.columns == docs.columns and sorted(ids(after) + ids(bad)) == ids(docs)
    truly = labels.filter("toxic = 1").join(docs, "doc_id")
    assert truly.join(after, "doc_id", "left_semi").count() <= 0.2 * truly.count()
    good = corpus_pipeline.drop_low_quality(spark, after, SF)
    assert good.columns == docs.columns
    clean = labels.filter("quality = 1 and toxic = 0").join(after, "doc_id", "left_semi")
    assert clean.join(good, "doc_id", "left_semi").count() >= 0.98 * clean.count()
    one = corpus_pipeline.drop_near_duplicates(spark, good, SF)
    texts = {r.doc_id: r.text for r in good.filter("doc_id is not null").collect()}
    want = [i for i, (_, c) in brute(texts, 5).items() if c == i]
    assert one.columns == docs.columns and ids(one) == sorted([-1] * good.filter("doc_id is null").count() + want)
    packed = corpus_pipeline.pack_sequences(spark, one, SF)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert packed.select("doc_id").distinct().count() == one.select("doc_id").distinct().count()


def test_pipeline_runs_and_takes_an_empty_table(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0 and (name == "packing" or out.columns == none.columns)


def test_passes_grow_with_the_label(spark):
    s = embed_dedup.Settings()
    assert [embed_dedup.passes_for(n, s) for n in (0, 1, 512, 2000)] == [8] * 4
    assert 8 < embed_dedup.passes_for(200_000, s) < embed_dedup.passes_for(1_000_000, s) < embed_dedup.passes_for(10_000_000, s)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    both = np.concatenate([x, 0.94 * x + np.sqrt(1 - 0.94 ** 2) * side])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(both)] + [(9999, [1.0] * 32, 2)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = embed_dedup.near_duplicates(d, embed_dedup.Settings(window=32, passes=1)).toPandas()
    found = (out["n_links"] > 0).sum()
    assert found >= 0.995 * 2000, found


def test_pipeline_filters_on_statistics_computed_once(spark):
    import corpus_pipeline
    from registrar.llm import quality
    from registrar.llm.common import table
    d = table(spark, SF, "documents")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    rules = quality.Model(0.1, tuple((((name, True, 0.5), ("bars", False, 2.0)), 0.2) for name in quality.STATISTICS))
    once = plan(quality.with_score(d, rules, "score"))
    held = plan(quality.with_score(d, rules, "score", filtered=True).filter("score >= 0.5"))
    assert held.count("array_distinct(") == once.count("array_distinct(") and held.count("split(") <= once.count("split(")
    assert corpus_pipeline.drop_low_quality(spark, d, SF).columns == d.columns


def test_texts_are_not_shuffled_for_the_ids_that_go(spark, monkeypatch):
    copy = "one text of which there are two rows with ids of their own"
    rows = [(1, copy), (2, copy), (3, "a text that stays"), (4, "one row"), (4, "another row of that id"), (4, "one row"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # more kept ids than Spark would send by itself
    try:
        out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        want = [(None, "no id"), (1, copy), (3, "a text that stays"), (4, "another row of that id"), (4, "one row")]
        assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
        monkeypatch.setattr(corpus_pipeline.minhash, "BROADCAST_IDS", 0)  # more ids than are sent
        assert sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
