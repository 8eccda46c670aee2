"""Quality rules: features by definition, EM on planted classes, verdicts."""

import re

import numpy as np

from conftest import SF001
from parcelkit.llm import quality

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = BLANK.findall(text)
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for i, r in enumerate(runs):
        seen.setdefault(r, []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines, dup, have = text.split("\n"), 0, set()
    for x in lines:
        if BLANK.search(x):
            dup += x in have
            have.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


TEXTS = ["a b c d e f g h " * 3, "a a a a a a a a a", "x " * 7, "one two three four five six seven eight nine",
         "l1 x\nl1 x\n\n \n\nl1 x\nl2", "a b c d e f g h i j k a b c d e f g h", "\x1c\x1d nbsp\u00a0word \x0b v",
         "#*$%&|<> # \U0001f600", ""]


def test_features_match_the_definition(rows):
    for t in [*TEXTS, None, *(r.text for r in rows)]:
        assert quality.measure(t)[:5] == plain(t)


def test_equal_hashes_are_not_trusted():
    words = [str(i) for i in range(300)]
    assert quality.repeated_words(words) == 0
    assert quality.repeated_words(words + words[40:60]) == 40


def test_em_finds_lone_and_shared_failures():
    rng = np.random.default_rng(1)
    kind = rng.choice(4, size=4000, p=[0.9, 0.04, 0.03, 0.03])
    votes = np.ones((4000, 4), dtype=int)
    for j in range(1, 4):
        votes[kind == j, j] = 0
    votes[(kind == 2), 3] = np.where(rng.random((kind == 2).sum()) < 0.7, 0, 1)
    votes[rng.random((4000, 4)) < 0.1] = -1
    pat, n = np.unique(votes, axis=0, return_counts=True)
    p = quality.fit(pat, n.astype(float)).posterior(votes)
    any_bad = (votes == 0).any(axis=1)
    assert ((p < 0.5) == any_bad).mean() > 0.999 and (p[kind == 0] > 0.5).all()


def test_poor_labels_go_and_clean_ones_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs).select("doc_id", "quality.kept", "quality.base_failed")
    rows = scored.join(labels.withColumnRenamed("quality", "good"), "doc_id").collect()
    clean = [r for r in rows if r.good == 1 and not r.base_failed]
    poor = [r for r in rows if r.good == 0]
    assert all(r.kept for r in clean)
    assert sum(not r.kept for r in poor) >= 0.9 * len(poor)


def test_edge_rows(spark, edge, empty):
    got = quality.score(edge)
    assert got.count() == edge.count()
    for r in got.collect():
        assert tuple(r.quality)[:5] == plain(r.text)
        assert r.quality.base_failed == (r.quality.n_words < 20 or 100 * r.quality.n_repeat_words > 30 * r.quality.n_words)
        assert not (r.quality.base_failed and r.quality.kept)
    assert quality.keep_good(edge).columns == edge.columns
    assert quality.score(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_a_quality_column_survives(edge):
    from pyspark.sql import functions as F
    df = edge.withColumn("quality", F.lit("mine"))
    assert {r.quality for r in quality.keep_good(df).collect()} <= {"mine"}
    assert set(quality.keep_good(df).columns) == set(df.columns)


def test_query(spark, queries):
    got = queries["op3_quality_rules"](spark, SF001).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").toPandas()
    for d, t in zip(docs.doc_id, docs.text):
        assert tuple(got.loc[d, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == plain(t)
