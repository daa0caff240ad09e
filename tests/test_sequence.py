"""The order helpers equal plain windows, with so few rows to a partition that every key
spans several of them (the hot-key path)."""

import random

from pyspark.sql import functions as F

from registrar.functions.sequence import dense_ids, previous_value, running_count, running_sum


def _rows(seed, n=300, keys=3):
    rnd = random.Random(seed)
    seqs = rnd.sample(range(10_000), n)
    return [(rnd.randrange(keys) if rnd.random() > 0.05 else None, s, rnd.randrange(-5, 10)) for s in seqs]


def test_running_sum_matches_brute_force(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "k long, seq long, v long")
    for inclusive in (False, True):
        got = {(r.k, r.seq): r.out for r in running_sum(df, ["k"], ["seq"], "v", "out", inclusive, parts=7).collect()}
        for k, s, _ in rows:
            exp = sum(v for k2, s2, v in rows if k2 == k and (s2 < s or (inclusive and s2 == s)))
            assert got[(k, s)] == exp


def test_running_count_without_key(spark):
    rows = _rows(2)
    df = spark.createDataFrame(rows, "k long, seq long, v long")
    got = {r.seq: r.out for r in running_count(df, [], ["seq"], F.col("v") > 3, "out", parts=5).collect()}
    for _, s, _ in rows:
        assert got[s] == sum(1 for _, s2, v in rows if s2 < s and v > 3)


def test_previous_value_matches_lag(spark):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "k long, seq long, v long")
    got = {(r.k, r.seq): r.prev for r in
           previous_value(df, ["k"], ["seq"], "v", "prev", default=F.lit(-99), parts=11).collect()}
    for k, s, _ in rows:
        earlier = sorted((s2, v) for k2, s2, v in rows if k2 == k and s2 < s)
        assert got[(k, s)] == (earlier[-1][1] if earlier else -99)


def test_previous_value_two_order_columns(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(2), b, p, rnd.randrange(100)) for b in range(6) for p in rnd.sample(range(50), 8)]
    df = spark.createDataFrame(rows, "k long, b long, p long, v long")
    got = {(r.k, r.b, r.p): r.prev for r in previous_value(df, ["k"], ["b", "p"], "v", "prev", parts=4).collect()}
    for k, b, p, _ in rows:
        earlier = sorted(((b2, p2), v) for k2, b2, p2, v in rows if k2 == k and (b2, p2) < (b, p))
        assert got[(k, b, p)] == (earlier[-1][1] if earlier else None)


def test_dense_ids(spark):
    seqs = random.Random(5).sample(range(1000), 40)
    df = spark.createDataFrame([(s,) for s in seqs], "seq long")
    got = {r.seq: r.id for r in dense_ids(df, ["seq"], "id", start=100, parts=3).collect()}
    assert got == {s: 101 + i for i, s in enumerate(sorted(seqs))}


def test_sparse_order_and_one_hot_key(spark):
    """Order values far apart and one key with most rows: every partition gets some of
    the hot key, none gets all."""
    from registrar.functions.sequence import _dealt
    rows = [(1 if i % 10 else i, i * 10**12 + i * i, 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, seq long, v long")
    per = _dealt(df, ["k"], ["seq"], 8).where("k = 1").groupBy("__chunk").count().collect()
    assert len(per) >= 6 and max(r["count"] for r in per) < 500
    got = [r.out for r in running_sum(df, ["k"], ["seq"], "v", "out", inclusive=True, parts=8).where("k = 1").orderBy("seq").collect()]
    assert got == list(range(1, len(got) + 1))


def test_small_keys_are_one_window_and_hot_keys_are_dealt(spark, monkeypatch):
    from registrar.functions import sequence
    rows = _rows(6, keys=2) + [(9, s, 1) for s in range(5)]
    df = spark.createDataFrame(rows, "k long, seq long, v long")
    dealt, real = [], sequence._dealt
    monkeypatch.setattr(sequence, "_dealt", lambda d, *a: dealt.append({r.k for r in d.select("k").distinct().collect()}) or real(d, *a))
    expected = sorted((str(k), s, sum(v for k2, s2, v in rows if k2 == k and s2 < s)) for k, s, _ in rows)
    for most, hot in ((1 << 18, []), (100, [{0, 1}]), (3, [{None, 0, 1, 9}])):
        dealt.clear()
        monkeypatch.setattr(sequence, "HOT_ROWS", most)
        got = running_sum(df, ["k"], ["seq"], "v", "out").select("k", "seq", "out").collect()
        assert sorted((str(r.k), r.seq, r.out) for r in got) == expected
        assert dealt == hot


def test_materialized_rows_are_stored_in_columns(spark):
    from registrar.functions.sequence import materialize
    out = materialize(spark.range(10).withColumn("x", F.lit(None).cast("string")))
    assert out.inputFiles() and sorted(r.id for r in out.collect()) == list(range(10))


def test_hot_keys_are_found_among_full_hash_classes_only(spark, monkeypatch):
    from registrar.functions import sequence as S
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 3), (2, 9), (None, 7)) for i in range(n)], "k long, i long")
    monkeypatch.setattr(S, "HOT_ROWS", 6)
    for classes in (1, 1 << 14):  # one class of all keys, a class a key
        monkeypatch.setattr(S, "CLASSES", classes)
        assert {r[0].k for r in S._hot_keys(rows, ["k"]).collect()} == {2, None}
    monkeypatch.setattr(S, "CLASSES", 1)
    monkeypatch.setattr(S, "HOT_ROWS", 10)
    assert S._hot_keys(rows, ["k"]) is None  # the class is full, no key of it is hot
    monkeypatch.setattr(S, "HOT_ROWS", 6)
    got = {(r.k, r.i): r.n for r in S.running_count(rows, ["k"], ["i"], F.lit(True), "n").collect()}
    assert got == {(r.k, r.i): r.i for r in rows.collect()}
