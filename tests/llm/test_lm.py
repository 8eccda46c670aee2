"""Language model: base counts by definition, gradients, held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from parcelkit.llm import lm


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def base(rows):
    """Counts and base scores by definition; rows (doc_id, text, held_out)."""
    c = Counter(t for _, text, held in rows if not held for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return n, [(len(tokens(t)), sum(c[w] > 0 for w in tokens(t)),
                sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in tokens(t))) for _, t, _ in rows]


@pytest.fixture
def small(monkeypatch):
    """Few known words, so that most go the way of the join."""
    monkeypatch.setattr(lm, "KNOWN", 1500)


def check(df, rows):
    n, want = base(rows)
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in df.collect()))
    assert got == sorted((str(d), h, *w[:2], round(w[2], 6)) for (d, _, h), w in zip(rows, want))
    assert {r.train_tokens for r in df.collect()} <= {n}


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.usefixtures("small")
def test_query_counts_and_held_out_gain(spark, queries, rows):
    got = queries["op6_lm_scoring"](spark, SF001)
    check(got, [(r.doc_id, r.text, held(r.doc_id)) for r in rows])
    out = [r for r in got.collect() if r.held_out]
    assert len(out) > 10 and all(r.score < 0 for r in out)
    # on unseen texts the network beats the smoothed unigram counts
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.usefixtures("small")
def test_edge_rows(edge, empty):
    rows = [(r.doc_id, r.text, r.doc_id == 6) for r in edge.collect()]
    got = lm.score(edge, F.col("doc_id") == 6)
    check(got, rows)
    assert lm.score(empty, F.lit(False)).count() == 0
    nothing = lm.score(edge, F.lit(True)).collect()
    assert {r.train_tokens for r in nothing} == {0} and all(math.isfinite(r.score) for r in nothing)


def make(seed=0):
    rng = np.random.default_rng(seed)
    p = lm.initial(rng.integers(1, 1000, size=lm.MODEL_WORDS + 2))
    return {k: (v * 3 if k == "E" else v).astype(np.float64) for k, v in p.items()}, rng


def test_gradients_match_differences():
    p, rng = make()
    trainer = lm.Trainer(p)
    size = np.array([7, 5, 5, 2])
    ids = rng.integers(0, lm.MODEL_WORDS + 2, size=size.sum())
    targets, inputs = next(lm.whole_texts(ids, size, 3).windows(lambda n: 32))
    seen = {}
    trainer._update = lambda g: seen.update(g)
    trainer.window(targets, inputs, np.zeros((4, lm.HIDDEN)))

    def loss():
        out = lm.score_texts(p, ids, size, 3)
        return -out.sum() / size.sum()
    for name in lm.SHAPES:
        flat, g = p[name].reshape(-1), seen[name].reshape(-1)
        for i in [*np.argsort(-np.abs(g))[:3], int(rng.integers(len(flat)))]:
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert g[i] == pytest.approx((up - down) / 2e-4, abs=2e-6), name


def test_probabilities_sum_to_one_and_state_is_carried():
    p, rng = make(1)
    m = lm.MODEL_WORDS + 2
    h = rng.normal(size=(1, lm.HIDDEN)).repeat(m, axis=0)
    assert np.exp(lm._output(p, h, np.arange(m))[0]).sum() == pytest.approx(1)
    ids = rng.integers(0, m, size=100)  # over three windows
    whole = lm.score_texts(p, ids, np.array([100]), 0)[0]
    state, last, total = np.zeros((1, lm.HIDDEN)), 0, 0.0
    ew = p["E"] @ p["Wx"] + p["b"]
    for t in ids:
        state = lm._step(ew[[last]], state, p["U"], p["bu"])[4]
        total += lm._output(p, state, np.array([t]))[0][0]
        last = t
    assert whole == pytest.approx(total)


def test_training_learns_an_order():
    """On a fixed cycle of words the next word becomes certain."""
    counts = np.zeros(lm.MODEL_WORDS + 2, dtype=np.int64)
    counts[:6] = 1000
    trainer = lm.Trainer(lm.initial(counts))
    ids = np.tile(np.r_[np.tile(np.arange(5), 12), 5], 64)
    size = np.full(64, 61)
    before = lm.score_texts(trainer.p, ids, size, 5).sum()
    for _ in range(60):
        trainer.texts(ids, size, 5)
    assert lm.score_texts(trainer.p, ids, size, 5).sum() > 0.2 * before


def test_workers_do_not_mix_vocabularies():
    a, b = (lm.Vocabulary(w, [2] * len(w), 1, 9, 4) for w in ([b"a", b"b"], [b"b", b"c", b"a"]))
    assert [lm._ranks(v)[b"b"] for v in (a, b, a)] == [1, 0, 1]


def test_spans_cover_each_token_once():
    size = np.array([1, 512, 513, 1100])
    ids = np.arange(size.sum())
    start, length, before = lm.spans(ids, size, 9, 512)
    assert sorted(i for a, n in zip(start, length) for i in range(a, a + n)) == ids.tolist()
    firsts = {0, 1, 513, 1026}
    assert all(b == (9 if a in firsts else a - 1) for a, b in zip(start, before)) and length.max() == 512


def test_most_frequent_words(spark):
    counts = spark.createDataFrame([(bytearray(w.encode()), c) for w, c in zip("abcdefg", (9, 7, 7, 5, 5, 5, 1))], "word binary, c long")
    words = lambda n: sorted(bytes(r["word"]).decode() for r in lm.most_frequent(counts, n).collect())
    assert [words(n) for n in (0, 1, 2, 3, 5, 6, 99)] == [[], ["a"], ["a"], list("abc"), list("abc"), list("abcdef"), list("abcdefg")]


def test_scoring_step_is_the_training_step():
    """The lighter step gives the very numbers of the traced one."""
    rng = np.random.default_rng(8)
    k = lm.HIDDEN
    ew, h, u, bu = (rng.standard_normal(s).astype(np.float32) for s in ((9, 3 * k), (9, k), (k, 3 * k), (3 * k,)))
    light = lm._next_state(lm._halved_gates(ew), h, lm._halved_gates(u), lm._halved_gates(bu))
    assert np.allclose(light, lm._step(ew, h, u, bu)[4], rtol=1e-6, atol=1e-7)
    assert lm.tokenize("Zoë A\x0bb c".encode()) == ["zoë".encode(), b"a", "b c".encode(), lm.END]
    assert lm.tokenize(None) == lm.tokenize(b"") == [lm.END]


def test_scores_do_not_depend_on_the_texts_beside(monkeypatch):
    """Texts are scored with others of like lengths, those of many batches
    together; each gets the same number as alone, and the steps of the longest
    text are made for few others."""
    rng = np.random.default_rng(3)
    p = lm.initial(rng.integers(1, 100, lm.MODEL_WORDS + 2))
    size = np.r_[rng.integers(1, 30, 200), 700, rng.integers(1, 30, 200), 650]
    ids = rng.integers(0, lm.MODEL_WORDS + 2, size.sum()).astype(np.int32)
    start = np.cumsum(size) - size
    alone = [lm.score_texts(p, ids[a:a + n], size[i:i + 1], 3)[0] for i, (a, n) in enumerate(zip(start, size))]
    steps = []
    real = lm._next_state
    monkeypatch.setattr(lm, "_next_state", lambda ew, h, u, bu: steps.append(len(h)) or real(ew, h, u, bu))
    for beside in (8, 64, 1024):
        monkeypatch.setattr(lm, "SCORED_TEXTS", beside)
        steps.clear()
        np.testing.assert_allclose(lm.score_texts(p, ids, size, 3), alone, rtol=1e-6)
        assert sum(steps) == size.sum() and max(steps) <= beside


def test_batches_are_gathered_before_they_are_scored(monkeypatch):
    texts = [b"a b", b"", None, b"c a a", b"b"]
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([-i]), pa.array([t], pa.binary())], names=["a", "b", "text"])
               for i, t in enumerate(texts)]
    for most, groups in ((10 ** 6, 1), (1, 5), (4, 3)):
        monkeypatch.setattr(lm, "SCORED_TOKENS", most)
        got = list(lm._side_by_side(iter(batches), {b"a": 0, b"b": 1}))
        assert len(got) == groups
        a, b, size, rank = (np.concatenate([g[i] for g in got]).tolist() for i in (0, 1, 4, 3))
        assert a == [0, 1, 2, 3, 4] and b == [0, -1, -2, -3, -4] and size == [3, 1, 1, 4, 2]
        assert rank == [0, 1, -2, -2, -2, -1, 0, 0, -2, 1, -2] and [w for g in got for w in g[2]] == [b"c"]
    assert list(lm._side_by_side(iter([]), {})) == []
