"""Packing: every id in exactly one piece, little padding, BM25 order."""

import zlib

import numpy as np
import pytest

from conftest import SF001
from parcelkit.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_path())


def check_pieces(pieces, want, window=packing.WINDOW):
    """``want``: ids of each document in no order; pieces in no order."""
    docs, sequences = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, dtype="<u4")
        assert len(ids) == p.length > 0 and zlib.crc32(p.ids) == p.ids_crc32
        docs.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids.tolist()))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window  # full, or a power of two
    held = sorted((str(k[0]), sum(len(x) for _, x in v)) for k, v in docs.items())
    assert sum(n for _, n in held) == sum(len(ids) for _, ids in want)
    for (doc, n), parts in docs.items():
        copies = [ids for d, ids in want if d == doc and len(ids) == n]
        flat = {}
        for start, ids in parts:
            for i, x in enumerate(ids):
                flat.setdefault(start + i, []).append(x)
        assert sorted(flat) == list(range(n))
        for i in range(n):
            assert sorted(flat[i]) == sorted(c[i] for c in copies)


TEXTS = ["", None, "Hello <|endoftext|> world <|STARTOFTEXT|>", "H\u0331A\u0301 e\u0301 İ K ẞ 漢字 \U0001f600", "a\u00a0b\x1cc  d\te",
         "don't we'll 1234 !!!...", "HELLO hello Hello"]


def test_ids_are_the_tokenizers(tokenizer, rows):
    texts = [*TEXTS, *(r.text for r in rows[:80])]
    ids, size = packing.tokens(packing.tokenizer_path())(texts)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END] for t in texts]
    assert size.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_a_full_table_changes_nothing(monkeypatch, rows):
    texts = [r.text for r in rows[:60]]
    want = packing.Tokens(packing.tokenizer_path())(texts)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 500)
    small = packing.Tokens(packing.tokenizer_path())
    parts = [small(texts[i:i + 7]) for i in range(0, 60, 7)]
    assert len(small.known) == 500
    assert np.array_equal(np.concatenate([p[0] for p in parts]), want[0])
    assert np.array_equal(np.concatenate([p[1] for p in parts]), want[1])


def test_pieces(spark, docs, edge, tokenizer):
    for df, options in ((docs, {}), (edge, {}), (docs.limit(60).repartition(3), {"shard_tokens": 5000, "window": 256})):
        rows = df.select("doc_id", "text").collect()
        want = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [packing.END]) for r in rows]
        check_pieces(packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect(), want,
                     options.get("window", packing.WINDOW))


def test_neighbours_are_ranked_by_bm25():
    rng = np.random.default_rng(0)
    size = rng.integers(5, 40, size=50)
    ids = rng.integers(0, 300, size=int(size.sum())).astype(np.uint16)
    index = packing.Index(ids, size)
    docs = np.split(ids, np.cumsum(size)[:-1])
    df = {t: sum(t in d for d in docs) for t in range(300)}
    idf = {t: np.log(1 + (50 - n + 0.5) / (n + 0.5)) for t, n in df.items()}
    terms = sorted((t for t in set(docs[0].tolist()) if df[t] > 1), key=lambda t: (-idf[t], t))[:packing.QUERY_TERMS]
    score = {}
    for j in range(1, 50):
        s = 0.0
        for t in terms:
            tf = int((docs[j] == t).sum())
            s += idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * size[j] / size.mean()))
        if s:
            score[j] = s
    unused = np.ones(50, dtype=bool)
    unused[0] = False
    got = index.neighbours(0, unused).tolist()
    assert sorted(got) == sorted(score)
    assert np.allclose([score[j] for j in got], sorted(score.values(), reverse=True))


def test_every_term_of_a_seed_is_searched():
    """Documents that share only frequent terms of the seed are neighbours too."""
    rare = np.arange(100, 140)
    docs = [np.r_[rare, 1, 2, 3], rare, *([1, 2, 3, 200 + j] for j in range(20)), *([3, 300 + j] for j in range(20)), [400]]
    size = np.array([len(d) for d in docs])
    index = packing.Index(np.concatenate(docs).astype(np.uint16), size)
    unused = np.ones(len(docs), dtype=bool)
    unused[[0, 5]] = False
    got = index.neighbours(0, unused).tolist()
    assert got == [1, *(j for j in range(2, 22) if j != 5), *range(22, 42)]


def test_topics_share_sequences(spark):
    """Documents of one topic are packed together."""
    topics = [[f"{a}{b}{c}" for b in "aeiou" for c in "bdfgklmn"] for a in ("str", "fl", "qu", "gr")]
    text = lambda t, i: " ".join(topics[t][(i * 7 + j) % 40] for j in range(150))
    rows = [(i, text(i % 4, i)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    seqs = {}
    for p in packing.pack(df, with_ids=False).collect():
        seqs.setdefault(p.sequence_id, []).append(p.doc_id % 4)
    same = sum(max(s.count(t) for t in range(4)) for s in seqs.values())
    assert same >= 0.8 * sum(map(len, seqs.values()))


def test_empty_table_and_query(spark, empty, queries, tokenizer):
    assert packing.pack(empty).count() == 0
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    pieces = queries["op10_packing"](spark, SF001).collect()
    total = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in rows)
    assert sum(p.length for p in pieces) == total
    full = {}
    for p in pieces:
        full[p.sequence_id] = full.get(p.sequence_id, 0) + p.length
    padding = sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in full.values())
    assert padding == 0


def test_new_words_are_tokenised_many_at_a_time(tokenizer):
    """Words of letters and symbols after them are few texts to the tokenizer,
    with the same ids; also by a tokenizer that marks no ends of words."""
    class Counting:
        texts = 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}{end}" for i in range(700) for end in ("", ",", "é&&&")]
    texts = [" ".join(words), "Über ÉTÉ. don't x's, a…. J̌ <|endoftext|>, l'été 12.5 ªº×÷ İx ÿ!", "a <| b |>"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [packing.END] for t in texts]
    for ends in (True, False):
        table = packing.Tokens(packing.tokenizer_path())
        table.tokenizer = Counting()
        table.ends_word &= ends
        ids, size = table(texts)
        assert size.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert table.tokenizer.texts < 60 if ends else table.tokenizer.texts > 2000
