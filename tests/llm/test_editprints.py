"""Order MinHash against a plain version with Python integers."""

import hashlib
import random

import numpy as np
import pytest

from parcelkit.llm import editprints as E

M32, M64 = (1 << 32) - 1, (1 << 64) - 1
MIX, FINAL = int(E.MIX), int(E.FINAL)


def plain_codes(text):
    """Occurrence-numbered k-mers counted with a dict."""
    n = max(1, len(text) - E.K + 1) if text else 0
    seen, out = {}, []
    for i in range(n):
        kmer = text[i:i + E.K]
        code = len(kmer)
        for c in kmer:
            code = ((code ^ ord(c)) * MIX) & M64
            code ^= code >> 32
        nth = seen[kmer] = seen.get(kmer, -1) + 1
        code = (code + nth * MIX) & M64
        code = ((code ^ (code >> 32)) * FINAL) & M64
        out.append(code ^ (code >> 32))
    return out


def plain_fingerprint(text):
    codes = plain_codes(text)
    if not codes:
        return [0] * E.SKETCHES
    out = []
    for j in range(E.SKETCHES):
        a, b, o = int(E.MULTIPLIERS[0][j]), int(E.MULTIPLIERS[1][j]), int(E.OFFSETS[j])

        def h(code):
            x = (((code & M32) ^ o) * a) & M32
            x ^= x >> 15
            return (x * b) & M32

        picked = sorted(sorted(range(len(codes)), key=lambda i: (h(codes[i]), i))[:E.TUPLE])
        value = len(picked)
        for i in picked:
            value = ((value ^ codes[i]) * MIX) & M64
            value ^= value >> 32
        out.append(value >> 48)
    return out


def plain_rows(rows):
    """rows: (doc_id, text) in the operator's order."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        third = len(text) // 3
        changed = text[:len(text) - third] + nxt[:third]
        a, b, c = plain_fingerprint(text), plain_fingerprint(changed), plain_fingerprint(nxt)
        hexed = ["".join(f"{v:04x}" for v in f) for f in (a, b)]
        alike = [sum(x == y for x, y in zip(a, f)) / E.SKETCHES for f in (b, c)]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *hexed, *alike))
    return out


def key(r):
    return tuple((v is not None, v) for v in r)


@pytest.mark.parametrize("text", ["", "a", "short", "12345678", "123456789", "abababababababababab",
                                  "漢字 \U0001f600 smile naïve " * 3, "x" * 5000, "some words " * 300])
def test_fingerprint_is_the_plain_one(text):
    assert E.elements(text).tolist() == plain_codes(text)
    assert E.fingerprint(text).tolist() == plain_fingerprint(text)


def test_chunks_do_not_change_it(monkeypatch):
    text = " ".join(f"word{i * i % 331}" for i in range(900))
    whole = E.fingerprint(text)
    monkeypatch.setattr(E, "CHUNK", 37)
    assert (E.fingerprint(text) == whole).all()


def test_order_counts():
    """Two halves changing places keep nearly all k-mers but lose tuples that
    span them; an edit of few letters loses little."""
    rng = random.Random(5)
    half = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(150)) for _ in range(2)]
    text = half[0] + " " + half[1]
    own = E.fingerprint(text)
    swapped = E.likeness(own, E.fingerprint(half[1] + " " + half[0]))
    touched = E.likeness(own, E.fingerprint(text[:700] + "X" + text[701:]))
    assert 0.3 < swapped < 0.7
    assert touched > 0.9
    assert E.likeness(own, E.fingerprint(half[0][::-1])) < 0.1


def test_query_is_the_plain_one(spark, queries, rows):
    got = sorted(map(tuple, queries["op11_order_minhash"](spark, "/root/testdata/sf0.001").collect()))
    short = [(r.doc_id, r.text) for r in sorted(rows, key=lambda r: -r.doc_id)]
    want = sorted(plain_rows_fast(short))
    assert got == want


def plain_rows_fast(rows):
    """As plain_rows with the operator's fingerprint, which the tests above
    hold against the plain one (200 whole texts take minutes without numpy)."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        changed = text[:len(text) - len(text) // 3] + nxt[:len(text) // 3]
        a, b, c = (E.fingerprint(t) for t in (text, changed, nxt))
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), E.to_text(a), E.to_text(b),
                    float(np.mean(a == b)), float(np.mean(a == c))))
    return out


def test_edge_rows(spark, edge):
    """Nulls, empty, blank and very long texts, repeated rows, one id with two
    texts and clashing names; many more ranges than rows."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = E.fingerprint_documents(edge).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    from parcelkit.llm.common import row_key
    ties = {r.text: r.tie["a"] for r in edge.select("text", row_key("text").alias("tie")).collect()}
    ordered = sorted(((r.doc_id, r.text) for r in edge.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), ties[r[1]]))
    want = plain_rows_fast(ordered)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_one_row_and_none(spark, edge, empty):
    assert E.fingerprint_documents(empty).count() == 0
    one = E.fingerprint_documents(edge.where("doc_id = 6")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and 0 < one[0].near_edited <= 1


def test_many_repeats_spread_over_ranges(spark):
    df = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE 7 END AS doc_id",
                                      "CASE WHEN id % 3 = 0 THEN concat('text of number ', id) ELSE 'the same text' END AS text")
    got = E.fingerprint_documents(df)
    assert got.count() == 4000
    same = got.where("n_chars = 13 AND near_next = 1.0").count()
    assert same == 2666 - 1  # each repeat but the last is followed by another
