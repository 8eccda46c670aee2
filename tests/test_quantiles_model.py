"""Exact distributed quantiles, stratified split, AUC and the logit fit."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelkit.operators import model, quantiles


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=5000), np.full(3000, 2.5), rng.exponential(size=2000) * 1e6])
    df = spark.createDataFrame([("a", float(v)) for v in vals] + [("b", float(v)) for v in vals[:7]], "k string, v double")
    probs = [0.05, 0.1, 0.5, 0.9, 0.95, 1.0]
    got = {r["k"]: [r[f"q_{i}"] for i in range(len(probs))] for r in
           quantiles.exact_quantiles(df, "k", probs).collect()}
    assert got["a"] == pytest.approx(list(np.quantile(vals, probs)), rel=1e-12)
    assert got["b"] == pytest.approx(list(np.quantile(vals[:7], probs)), rel=1e-12)


def test_order_statistics_small_leaf(spark):
    vals = [float(v) for v in np.random.default_rng(1).integers(0, 50, size=4000)]
    df = spark.createDataFrame([(0, v) for v in vals], "k int, v double")
    s = sorted(vals)
    got = quantiles.order_statistics(df, "k", {(0, r): r for r in (0, 17, 1999, 3999)}, bins=8, leaf=10)
    assert [got[(0, r)] for r in (0, 17, 1999, 3999)] == [s[0], s[17], s[1999], s[3999]]


def test_stratified_split_quota(spark):
    rows = [(i, 1 if i % 3 == 0 else 0) for i in range(10000)]
    df = spark.createDataFrame(rows, "pid long, y int")
    sp = model.stratified_split(df, "y", "pid", 0.25, 42)
    c = {(r["y"], r["is_test"]): r["count"] for r in sp.groupBy("y", "is_test").count().collect()}
    n1, n0 = sum(1 for _, y in rows if y == 1), sum(1 for _, y in rows if y == 0)
    assert c[(1, True)] == int(np.ceil(0.25 * n1)) and c[(0, True)] == int(np.ceil(0.25 * n0))
    # the chosen rows are the smallest hashes per class
    h = lambda p: ((p * 7919 + 42 * 104729) % 1000003, p)
    want = set(p for p, _ in sorted((r for r in rows if r[1] == 1), key=lambda r: h(r[0]))[:int(np.ceil(0.25 * n1))])
    got = {r["pid"] for r in sp.filter("is_test AND y = 1").collect()}
    assert got == want


def test_auc_against_pair_counting(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, size=600)
    s = np.round(rng.random(600) * 0.5 + y * 0.2, 2)   # ties on purpose
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "target_lead int, score double")
    m = {r["metric"]: r["value"] for r in model.classifier_metrics(df).collect()}
    pos, neg = s[y == 1], s[y == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert m["auc"] == pytest.approx(pairs / (len(pos) * len(neg)), rel=1e-12)
    pred = s > 0.5
    assert m["accuracy"] == pytest.approx(np.mean(pred == (y == 1)))


def test_logit_matches_newton(spark):
    rng = np.random.default_rng(11)
    n = 3000
    X = rng.normal(size=(n, 2))
    p = 1 / (1 + np.exp(-(0.3 + 0.8 * X[:, 0] - 0.5 * X[:, 1])))
    y = (rng.random(n) < p).astype(int)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, X[:, 0], X[:, 1])],
                               "target_lead int, f1 double, f2 double")
    rows, st = model.logit_inference(df, ["f1", "f2"])
    A = np.column_stack([np.ones(n), X])
    w = np.zeros(3)
    for _ in range(50):
        mu = 1 / (1 + np.exp(-A @ w))
        H = A.T @ (A * (mu * (1 - mu))[:, None])
        w = w + np.linalg.solve(H, A.T @ (y - mu))
    se = np.sqrt(np.diag(np.linalg.inv(H)))
    assert [r[1] for r in rows] == pytest.approx(list(w), rel=1e-6)
    assert [r[2] for r in rows] == pytest.approx(list(se), rel=1e-4)
    assert st["n_obs"] == n


def test_l2_logistic_matches_newton(spark):
    """The penalised intercept is part of the fit."""
    rng = np.random.default_rng(3)
    n = 2000
    X = np.column_stack([rng.normal(size=n), rng.integers(0, 2, size=n)])
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.2 + 0.7 * X[:, 0] - 0.4 * X[:, 1])))).astype(int)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, *X.T)],
                               "target_lead int, f1 double, f2 double")
    m = model.fit_l2_logistic(df, ["f1", "f2"], C=0.05)
    A = np.column_stack([np.ones(n), X])
    w = np.zeros(3)
    for _ in range(50):
        mu = 1 / (1 + np.exp(-A @ w))
        w = w - np.linalg.solve((A.T * (mu * (1 - mu))) @ A + np.eye(3) / 0.05, A.T @ (mu - y) + w / 0.05)
    assert list(m.coefficients) == pytest.approx(list(w), abs=1e-5)


def test_separated_classes_have_infinite_odds():
    assert model.odds(800.0) == math.inf and model.odds(0.0) == 1.0


def test_column_quantiles_match_numpy(spark):
    from parcelkit.operators.quantiles import column_quantiles
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=4000), rng.integers(0, 7, size=4000).astype(float)
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)], "a double, b double, c double")
    got = column_quantiles(df, {c: F.col(c) for c in "abc"}, [0.0, 0.1, 0.5, 0.93, 1.0], grid=16, read=50)
    assert set(got) == {"a", "b"}
    for c, v in (("a", a), ("b", b)):
        n, mean, lo, hi, q = got[c]
        assert (n, lo, hi) == (4000, v.min(), v.max()) and mean == pytest.approx(v.mean())
        assert q == pytest.approx(np.quantile(v, [0.0, 0.1, 0.5, 0.93, 1.0]), abs=1e-12)


def test_column_quantiles_of_few_values(spark):
    """Two and three distinct values, ranks at and around the steps, brackets
    never read: each scan must leave a value behind."""
    from parcelkit.operators.quantiles import column_quantiles
    two, three = [1.0] * 700 + [5.0] * 300, [2.0] * 499 + [3.0] + [4.0] * 500
    df = spark.createDataFrame(list(zip(two, three)), "a double, b double")
    probs = [0.0, 0.3, 0.499, 0.4995, 0.5, 0.699, 0.7, 0.701, 1.0]
    got = column_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, probs, grid=4, read=0)
    for c, v in (("a", two), ("b", three)):
        assert got[c][4] == pytest.approx(np.quantile(v, probs), abs=1e-12)


def test_column_quantiles_scan_without_exploding(spark):
    """No generator, no grouping: each scan is one global aggregate."""
    from parcelkit.operators import quantiles
    seen = []
    original = type(spark.range(1)).agg

    def spy(self, *a, **k):
        out = original(self, *a, **k)
        seen.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    df = spark.range(30_000).selectExpr("cast(id * 7919 % 30011 as double) AS a")
    try:
        type(df).agg = spy
        got = quantiles.column_quantiles(df, {"a": F.col("a")}, [0.1, 0.5, 0.9])
    finally:
        type(df).agg = original
    want = np.quantile([float(i * 7919 % 30011) for i in range(30_000)], [0.1, 0.5, 0.9])
    assert got["a"][4] == pytest.approx(want) and len(seen) == 2
    assert not any("Generate" in p for p in seen)


def test_samples_by_threshold(spark, monkeypatch):
    """The n least hashes, ties by key, over several narrowing passes;
    the plan ranks rows of the
    crossing range only."""
    from parcelkit.operators import summary

    monkeypatch.setattr(summary, "SAMPLE_RANGES", 16)
    keys = list(range(-500, 4500))
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k long, _v string")
    code = sorted((math.fmod(k * 7919 + 3 * 104729, 1000003), k) for k in keys)
    for n in (0, 1, 777, 5000, 9000):
        out = summary.arith_hash_sample(df, "k", n, 3)
        assert sorted(r["k"] for r in out.collect()) == sorted(k for _, k in code[:n])
        assert out.columns == df.columns
    plan = summary.hash_sample(df, "k", 100)._jdf.queryExecution().executedPlan().toString()
    limits = [int(x) for x in re.findall(r"(?:Limit |limit=)(\d+)", plan)]
    assert "Union" in plan and all(x < 16 for x in limits)
    a, b = (sorted(r["k"] for r in summary.hash_sample(df, "k", 100, s).collect()) for s in (1, 2))
    assert len(set(a)) == len(set(b)) == 100 and a != b
    same = spark.createDataFrame([(7, str(i)) for i in range(300)] + [(None, "n"), (8, "x")], "k long, v string")
    assert summary.hash_sample(same, "k", 50).count() == 50
    assert summary.arith_hash_sample(same, "k", 302).count() == 302
    assert summary.hash_sample(df.limit(0), "k", 5).count() == 0


def test_l2_fit_keeps_no_second_copy_of_the_rows(spark, monkeypatch):
    """The library keeps the fit's rows itself; a cached input would double them."""
    from pyspark.sql import DataFrame

    def refuse(self, *args):
        raise AssertionError("the input of the fit is cached")

    df = spark.range(200).selectExpr("cast(id % 2 as int) AS target_lead", "cast(id % 7 as double) AS f1")
    for cls in {DataFrame, type(df)}:
        monkeypatch.setattr(cls, "persist", refuse)
        monkeypatch.setattr(cls, "cache", refuse)
    assert len(model.fit_l2_logistic(df, ["f1"]).coefficients) == 2
