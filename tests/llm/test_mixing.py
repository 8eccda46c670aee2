"""Mixing: targets, whole accounting per shard, seeded reruns."""

from collections import Counter

import numpy as np
import pytest

from conftest import SF001
from parcelkit.llm import mixing


def test_targets():
    assert mixing.targets([100, 100, 100]) == pytest.approx([187.5, 75.0, 37.5])
    # the first source stops at 3 * 10, the rest is shared 2 : 1
    assert mixing.targets([10, 100, 100]) == pytest.approx([30, 120, 60])
    # after resharing a second one is above its limit
    assert mixing.targets([10, 30, 200]) == pytest.approx([30, 90, 120])
    assert mixing.targets([0, 5]) == pytest.approx([0, 5]) and mixing.targets([]) == [] and mixing.targets([0]) == [0]


def test_tree_deals_every_draw_once():
    quotas = np.array([700, 0, 3, 1024, 51])
    for shards in (1, 2, 7, 16):
        first, count = map(np.array, zip(*(mixing.leaf(k, shards, quotas, 7) for k in range(shards))))
        assert (count.sum(axis=0) == quotas).all() and (first == np.cumsum(count, axis=0) - count).all()
        assert np.ptp(count.sum(axis=1)) <= 1  # equal shards up to rounding


def test_tree_is_hypergeometric():
    """Left counts have the mean and spread of draws without replacement."""
    quotas = np.array([60, 40])
    left = np.array([mixing.leaf(0, 2, quotas, seed)[1][0] for seed in range(3000)])
    assert left.mean() == pytest.approx(30, abs=0.3)
    assert left.var() == pytest.approx(50 * 0.6 * 0.4 * 50 / 99, rel=0.1)


def check(df, **options):
    rows = mixing.place(df, **options).collect()
    taken, size, target = Counter(), Counter(), {}
    for r in rows:
        assert r.mix.size == len((r.text or "").encode().split())
        assert len(r.mix.shards) <= 3
        taken[r.source] += r.mix.size * len(r.mix.shards)
        size[r.source] += r.mix.size
        target[r.source] = (r.mix.source_size, r.mix.target)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    for s, t in zip(order, mixing.targets([size[s] for s in order])):
        assert target[s] == (size[s], pytest.approx(t))
    return rows, taken, {s: t for s, (_, t) in target.items()}


def test_documents(docs):
    rows, taken, target = check(docs, shard_words=5000)
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.01)
    for s, t in target.items():
        assert taken[s] == pytest.approx(t, rel=0.1)  # some ten documents a source
    again = check(docs.repartition(5), shard_words=5000)[0]
    key = lambda rs: sorted((r.doc_id, tuple(r.mix.shards)) for r in rs)
    assert key(rows) == key(again)
    shards = Counter(s for r in rows for s in r.mix.shards)
    assert len(shards) > 1
    mixed = mixing.mix(docs, shard_words=5000)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: len(r.mix.shards) for r in rows if r.mix.shards})


def test_hot_source_comes_close(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 300))), "hot" if i % 3 == 0 else f"s{i % 17}") for i in range(6000)]
    _, taken, target = check(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for s, t in target.items():
        assert abs(taken[s] - t) <= 10


def test_edge_rows(edge, empty):
    rows, _, _ = check(edge)
    assert len(rows) == edge.count()
    assert mixing.mix(edge).columns == edge.columns
    assert mixing.place(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_query(spark, queries):
    got = queries["op7_mix_sources"](spark, SF001).collect()
    assert len(got) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert all(r.taken <= 3 * r.size and r.taken == r.size * len(r.shards) for r in got)
