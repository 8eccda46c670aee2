"""Ranked search against plain counting over all documents."""

import math
import re
from collections import Counter

import numpy as np

from conftest import SF001
from parcelkit.llm import ranking as R

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return [m.translate(LOWER) for m in PATTERN.findall(text or "")]


def plain_search(docs, items, k=50):
    """docs: (doc_id, text); items: (item_id, text)."""
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    total, words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked = set(plain_terms(text))
        scored = []
        for d, b in bags:
            m = 50 + 50 * sum(b.values()) * total // words
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    * (1000000000 * b[t] // (1000 * b[t] + 20 * m)) for t in asked if b[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        scored.sort(key=lambda x: x[:3])
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(scored[:k])]
    return out


def same(got, want):
    def key(r):
        return tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_terms_are_the_contract_s():
    for text in ("Été ÀÉ İstanbul ẞtraße naïve_word 漢字 a1b2 \U0001f600x\x7f\x00y [z] A-Z @`{|}~", "", None, " x Y"):
        assert [t.decode() for t in R.terms(text)] == plain_terms(text)


def test_query_is_the_plain_one(spark, queries, rows):
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()
    got = queries["op12_ranked_search"](spark, SF001).collect()
    same(got, plain_search([(r.doc_id, r.text) for r in rows], items))


def test_small_shards_and_blocks(spark, docs, rows, monkeypatch):
    """Queries in several blocks, and many small shards with floors carried
    from shard to shard (in this process: no worker sees the patch)."""
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    got = R.search(docs, items, k=7, block_bytes=1500).collect()
    pairs = items.select("item_id", "text").collect()
    want = plain_search([(r.doc_id, r.text) for r in rows], pairs, k=7)
    same(got, want)


def shard_of(bags, vocabulary):
    total, words = len(bags), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    weights = np.array([R.weight(total, df[t]) for t in vocabulary], dtype=np.int64)
    at = {t: i for i, t in enumerate(vocabulary)}
    post = [(i, at[t], n) for i, b in enumerate(bags) for t, n in b.items()]
    doc, term, tf = (np.array(x) for x in zip(*post))
    norms = np.array([R.length_norm(sum(b.values()), total, words) for b in bags], dtype=np.int64)
    return R.Shard(doc, term, tf, weights, norms, list(range(total)))


def full_scores(shard, query):
    score = np.zeros(shard.size, dtype=np.int64)
    for t in query.tolist():
        docs, share = shard.postings(t)
        score[docs] += share
    return score


def check(shard, queries, k):
    """Answers against full scoring; postings visited."""
    shard.read = 0
    for q in queries:
        score = full_scores(shard, q)
        docs, got = shard.search(q, k)
        kth = np.sort(score)[-k]
        assert (np.sort(docs) == np.flatnonzero((score >= kth) & (score > 0))).all()
        assert (got == score[docs]).all()
    return shard.read


def test_pair_bounds_lose_nothing():
    rng = np.random.default_rng(3)
    vocabulary = [f"t{i}" for i in range(40)]
    bags = [Counter(f"t{t}" for t in rng.choice(40, size=rng.integers(1, 30), p=np.arange(1, 41) / 820)) for _ in range(3000)]
    shard = shard_of(bags, vocabulary)
    queries = [np.sort(rng.choice(40, size=n, replace=False)) for n in (1, 2, 3, 8, 13, 20, 40)]
    check(shard, queries, 10)
    shard.join_pairs(queries)
    check(shard, queries, 10)
    for q in queries:
        for u in shard.units(q):
            assert shard.bound(u) <= sum(shard.top[t] for t in u)


def test_pair_bounds_tighten():
    """Two frequent terms that never meet: the sum of their maxima reaches
    the floor set by the rare terms, their joint bound does not."""
    vocabulary = ["a", "b", "pad", "r1", "r2"]
    bags = []
    for i in range(4000):
        b = Counter({"pad": 60})
        if i < 3000:
            b["ab"[i % 2]] = 1 + i % 50
        if i >= 3960:
            b[f"r{1 + i % 2}"] = 1
        b["pad"] -= sum(b.values()) - 60
        bags.append(+b)
    query = np.array([0, 1, 3, 4])
    shard = shard_of(bags, vocabulary)
    single = check(shard, [query], 10)
    shard.join_pairs([query])
    assert sorted(shard.units(query)[1]) == [0, 1] and shard.bound(shard.units(query)[1]) < shard.top[0] + shard.top[1]
    assert check(shard, [query], 10) < single / 10


def test_edge_rows(spark, edge, empty):
    items = spark.createDataFrame([(1, "Second words UND3 und5 word7", 5), (1, "Second words UND3 und5 word7", 5), (2, None, 1),
                                   (3, "", 1), (4, "nowhere-to-be-found", 1), (None, "Été 漢字 the id", 1)],
                                  "item_id long, text string, rank int")
    got = R.search(edge, items).collect()
    same(got, plain_search([(r.doc_id, r.text) for r in edge.collect()], [(r.item_id, r.text) for r in items.collect()]))
    assert R.search(empty, items).count() == 0
    assert R.search(edge, items.where("false")).count() == 0


def test_ties_go_by_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(100, 0, -1)] + [(None, "same words here")] * 5
                                 + [(i, "other filler") for i in range(200, 400)], "doc_id long, text string")
    items = spark.createDataFrame([(9, "same words")], "item_id long, text string")
    got = R.search(docs, items, k=50).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(1, 51)) and [r["rank"] for r in got] == list(range(1, 51))
    got = R.search(docs, items, k=103).orderBy("rank").collect()
    assert [r.doc_id for r in got[98:]] == [99, 100, None, None, None]
