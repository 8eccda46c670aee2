"""SimHash groups against all pairs of fingerprints."""

import re

import numpy as np
import xxhash

from conftest import SF001
from parcelkit.llm import simhash


def plain(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    """Root of each fingerprint by testing all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def expected(rows):
    fps = {(d, t): plain(t) for d, t in rows}
    comp = components(fps.values())
    least = {}
    for (d, _), f in fps.items():
        if d is not None:
            least[comp[f]] = min(d, least.get(comp[f], d))
    return {k: (f, least.get(comp[f])) for k, f in fps.items()}


def test_fingerprints_match_the_definition(rows):
    for t in [None, "", "A", "a b", "a b c", "Ab aB ab AB", "İ Ä ä K k", *(r.text for r in rows[:60])]:
        assert simhash.fingerprint(t) == plain(t)


def test_links_lose_no_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, size=60, dtype=np.uint64)
    fps = set(map(int, base)) | {0, 2 ** 64 - 1}
    for f in map(int, base):
        for _ in range(12):  # chains of one to three flipped bits, within and across bytes
            f ^= sum(1 << int(b) for b in rng.choice(64, size=int(rng.integers(1, 4)), replace=False))
            fps.add(f)
    low = int(base[0])
    fps |= {low ^ m for m in range(600)}  # one crowded posting list
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.fp % 2 ** 64: r.root for r in simhash.fingerprint_groups(df).collect()}
    want = components(fps)
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(f)
    mine = {}
    for f in fps:
        mine.setdefault(got.get(f, f"own {f}"), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_groups_match_all_pairs(spark, docs, edge):
    near = docs.select("doc_id", "text").union(
        spark.createDataFrame([(10_000 + i, f"some shared long sentence that goes on and on for a while {'x ' * 300} {i % 7}")
                               for i in range(40)], "doc_id long, text string"))
    for df in (near, edge):
        rows = df.select("doc_id", "text").collect()
        want = sorted((str(r.doc_id), *map(str, expected([tuple(x) for x in rows])[tuple(r)])) for r in rows)
        got = sorted((str(r.doc_id), str(r.fingerprint % 2 ** 64), str(r.component_id))
                     for r in simhash.group_documents(df).collect())
        assert got == want


def test_one_document_of_each_group_stays(edge, empty):
    kept = simhash.keep_one(edge)
    groups = {(r.fingerprint, r.component_id) for r in simhash.group_documents(edge).collect()}
    assert kept.columns == edge.columns and kept.count() == len({c if c is not None else f for f, c in groups})
    assert simhash.keep_one(empty).count() == 0 and simhash.group_documents(empty).count() == 0


def test_query(spark, queries, rows):
    want = expected([(r.doc_id, r.text) for r in rows])
    got = {r.doc_id: r for r in queries["op4_simhash_near_dedup"](spark, SF001).collect()}
    assert len(got) == len(rows)
    for r in rows:
        f, c = want[(r.doc_id, r.text)]
        assert (got[r.doc_id].fingerprint, got[r.doc_id].component_id) == (f"{f:016x}", c)
