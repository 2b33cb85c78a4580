import numpy as np
from pyspark.sql import functions as F

from strata.llm import vector_search

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k=10):
    """The k nearest other rows of each query, among the rows that take part."""
    ok = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array(sorted(ok))
    x = np.array([ok[i] for i in ids])
    out = {}
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - ok[q]) ** 2).sum(axis=1))
        out[int(q)] = [(int(ids[i]), float(d[i])) for i in np.lexsort((ids, d)) if ids[i] != q][:k]
    return out


def found(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame([(i, v, 0, "old") for i, v in rows], schema)
    got = {}
    for r in vector_search.search(df, F.col("_id") % 100 == 0, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return got


def same(got, want):
    return got.keys() == {q for q, x in want.items() if x} and all([i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12) for q in got)


def test_odd_rows(spark):
    """Few vectors, in one list: the result is exact. Ties, copies, zeros, nulls and rows that take no part."""
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, -1.0]), (100, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]),
            (7, [None, 1.0]), (8, [float("inf"), 1.0]), (200, [-0.0, 1.0]), (9, [2.0, 3.0]), (9, [2.0, 3.0]), (None, [1.0, 1.0]), (300, None), (400, [0.0, 0.0])]
    assert same(found(spark, rows), brute(rows))
    assert found(spark, []) == {} and found(spark, [(100, [1.0, 2.0])]) == {}


def test_copies(spark):
    rng = np.random.default_rng(1)
    hot = rng.normal(size=8)
    rows = [(i, (hot if i % 3 == 0 else rng.normal(size=8)).tolist()) for i in range(900)]
    assert same(found(spark, rows, list_size=1000), brute(rows))


def test_recall(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(30, 16)) * 2
    rows = [(i, (centers[i % 30] + rng.normal(size=16)).tolist()) for i in range(6000)]
    got, want = found(spark, rows, list_size=64), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    assert hits >= 0.9 * 10 * len(want)
    exact = {(q, i): s for q, x in want.items() for i, s in x}
    assert all(abs(exact[q, i] - s) < 1e-9 for q, x in got.items() for i, s in x if (q, i) in exact)


def test_graph_finds_near_centroids():
    rng = np.random.default_rng(3)
    index = vector_search.fit(rng.normal(size=(8000, 12)).astype(np.float32), 500)
    assert len(index.points) == 500
    x = rng.normal(size=(200, 12)).astype(np.float32)
    ids, d = index.search(x, 32)
    true = ((x[:, None, :] - index.points[None]) ** 2).sum(axis=2)
    assert (np.diff(d, axis=1) >= 0).all() and np.mean(ids[:, 0] == true.argmin(axis=1)) >= 0.97
