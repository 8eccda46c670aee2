"""Exact search against all inner products in Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from parcelkit.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, is_query, k=10):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if is_query(i):
            scores = [(-min(max(sum(x * y for x, y in zip(q, v)), topk.LONG[0]), topk.LONG[1]), j)
                      for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q)]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def f32(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def compare(spark, rows, is_query, cond, k=10, **options):
    rows = [(i, f32(v)) for i, v in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, topk.top_k(df, cond, k, **options).collect()))
    assert got == plain(rows, is_query, k)


def test_random_vectors_and_blocks(spark):
    rng = np.random.default_rng(2)
    near = rng.normal(size=(40, 64))
    rows = [(i, (near[i % 40] + 0.1 * rng.normal(size=64)).tolist()) for i in range(1500)]
    compare(spark, rows, lambda i: i % 50 == 0, F.col("vec_id") % 50 == 0)
    compare(spark, rows[:400], lambda i: i % 20 == 0, F.col("vec_id") % 20 == 0, k=3, query_block=7)


def test_ties_repeats_and_odd_vectors(spark):
    same = [0.5] * 8
    rows = [(i, same) for i in range(30)] + [(0, same), (0, same), (100, [1.0] * 8), (100, [-1.0] * 8), (7, None),
                                             (8, [1.0, None] * 4), (9, [math.nan] * 8), (10, [math.inf] * 8), (None, same),
                                             (200, [1.0] * 5), (201, [2.0] * 5), (300, []), (301, []), (-100, [3e38] * 8),
                                             (101, [-3e38] * 8), (102, [1e15] * 8)]
    compare(spark, rows, lambda i: i % 100 == 0, F.col("vec_id") % 100 == 0)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x, q = rng.integers(-900, 900, size=(50, 37)).astype(float), rng.integers(-900, 900, size=(20, 37)).astype(float)
    last = np.full((20, 50), np.inf)
    for s in topk.LEVELS:
        bound = topk.profile(q, s) @ topk.profile(x, s).T
        assert (bound >= q @ x.T - 1e-6).all()
        last = bound
    assert np.isfinite(last).all()


def test_empty_table_and_query(spark, queries):
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = sorted(map(tuple, queries["op8_exact_top_k"](spark, SF001).collect()))
    assert got == plain(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize("scale", [1, 2.0 ** 40])
def test_exact_scores(scale):
    q, x = np.array([[3.0, -5.0]]) * scale, np.array([[7.0, 2.0], [1.0, 1.0]]) * scale
    assert topk.exact(q, x).tolist() == [[min(int(11 * scale * scale), topk.LONG[1]), max(int(-2 * scale * scale), topk.LONG[0])]]


def test_a_block_of_queries_is_small_in_memory():
    """A full block of queries against many rows, some of them near: less than
    190 MB besides the worker's 110, and the scores of plain products."""
    import tracemalloc

    rng = np.random.default_rng(6)
    q = rng.integers(-1000, 1000, size=(topk.QUERY_BLOCK, 64)).astype(float)
    x = np.concatenate([rng.integers(-1000, 1000, size=(4000, 64)).astype(float), q[:1000] + 1])
    ids = rng.permutation(len(x))
    tracemalloc.start()
    search = topk.Search(q, 11)
    search.add(ids, x)
    got = [np.concatenate(c) for c in zip(*search.results())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 190e6
    for i in (0, 511, 512, 5000, len(q) - 1):
        mine = got[0] == i
        want = sorted((-int(s), int(j)) for s, j in zip(q[i] @ x.T, ids))[:11]
        assert sorted(zip((-got[1][mine]).tolist(), got[2][mine].tolist())) == want
