import numpy as np
from pyspark.sql import functions as F

from telemetry_engine.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k):
    v = {}
    for i, e, _ in rows:
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            v.setdefault(i, []).append([int(np.floor(1024 * float(np.float32(x)))) for x in e])
    out = []
    for q in sorted(v):
        if q % 10:
            continue
        for own in {tuple(x): x for x in v[q]}.values():  # equal rows are one query
            best = sorted((-sum(a * b for a, b in zip(own, c)), i) for i in v if i != q for c in v[i] if len(c) == len(own))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:k])]
    return sorted(out)


def test_equals_brute_force_with_ties_nulls_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 8], "s") for i in range(300)]
    rows += [(301, None, "s"), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0], "s"), (303, [float("nan")] * 6, "s"),
             (304, [float("inf")] * 6, "s"), (None, [1.0] * 6, "s"), (310, [1.0, 2.0], "s"), (311, [3.0, 1.0], "s"),
             (320, [], "s"), (5, rows[5][1], "s"), (20, rows[20][1], "s"), (30, rows[31][1], "s")]
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, k=7)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 7)


def test_query_blocks_give_the_same(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "s") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=3, query_bytes=600)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3)


def test_fewer_than_k_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0], "s"), (1, [2.0], "s")], SCHEMA)
    assert topk.top_k(df, F.col("vec_id") == 0).collect() == [(0, 1, 1, 2 * 1024 * 1024)]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).collect() == []


def test_blocks_are_pruned_and_large_values_exact():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(20, 16)) * 3
    v = topk.whole(np.repeat(centre, 128, axis=0) + rng.normal(size=(2560, 16)) / 20)
    ids, q = np.arange(2560), v[::100]
    best = topk.Best(len(q), 10)
    scored = topk.search(ids[::100], q, ids, v, best, np.arange(len(q)))
    s = (q @ v.T).astype(np.int64)
    s[np.arange(len(q)), ids[::100]] = topk.NONE
    assert (best.score == -np.sort(-s, axis=1)[:, :10]).all()
    assert scored < s.size / 4  # most blocks are never scored
    a = np.array([[2.0 ** 40, 1.0]])
    assert topk.products(a, np.array([[2.0 ** 20, 1.0]]))[0, 0] == 2 ** 60 + 1
