"""License scan against a scan of every rule over every text in Python."""

import re

from pyspark.sql import functions as F

from conftest import SF001
from parcelkit.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_of(text):
    """(n_words, starts per label) by comparing words at every place."""
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), found


def found_of(text):
    """Detections that stand: every rule over the joined words, then each
    detection against all others."""
    joined = " ".join(WORDS.findall((text or "").lower()))
    spans = []
    for r in licenses.signatures():
        if not r.base:
            for m in re.finditer(rf"(?<![^ ])(?:{r.pattern})(?![^ ])", joined):
                start = joined[:m.start()].count(" ")
                spans.append((start, start + len(m.group().split(" ")), r.rank, r.label))
    spans.sort(key=lambda s: (s[0], -s[1], s[2]))
    return [s for i, s in enumerate(spans) if not any(o[1] >= s[1] for o in spans[:i])]


def check(spans, text, n_words, base, found):
    n, want = base_of(text)
    assert n_words == n
    assert sorted((s.start, s.label) for s in base) == sorted(want)
    if spans:
        assert [(s.start, -s.till, s.rank, s.label) for s in found] == found_of(text)


def test_there_are_hundreds_of_rules_in_order():
    rules = licenses.signatures()
    assert len(rules) >= 250 and [r.rank for r in rules] == list(range(len(rules)))
    for r in rules:
        re.compile(r.pattern)


def spellings(pattern):
    """Every choice of a pattern's alternatives; optional parts left out."""
    m = re.search(r"\((?:\?:)([^()]*)\)(\?)?", pattern)
    if not m:
        return [pattern]
    parts = [""] if m[2] else m[1].split("|")
    return [x for p in parts for x in spellings(pattern[:m.start()] + p + pattern[m.end():])]


def test_every_keyword_gates_its_rule():
    """A match always holds its rule's keyword, whichever alternative it took."""
    for r in licenses.signatures():
        for said in spellings(r.pattern):
            words = [re.split(r"[^a-z0-9]+", said.replace("[sc]", c)) for c in "sc"]
            assert any(r.keyword in w for w in words), (r, said)


def test_freebsd_is_found_by_its_own_keyword(spark):
    df = spark.createDataFrame([(1, "Distributed under the FreeBSD License.")], "doc_id long, text string")
    got = licenses.scan(df).select(licenses.labels(F.col("licenses.found")).alias("l")).first()["l"]
    assert "bsd-2-clause" in got.split(",")


TEXTS = [
    "Licensed under CC BY-NC 4.0. All rights reserved; cc-by, CC BY",
    "GNU General Public License, version 3 or the GNU Lesser General Public License version 2.1",
    "SPDX-License-Identifier: Apache-2.0\nsee https://www.apache.org/licenses/LICENSE-2.0",
    "Released under the MIT License. mit Licence. Permission is hereby granted, free of charge, to any person obtaining a copy",
    "the general public\tlicense general public license all rights reserved all rights reserved",
    "cc by" * 5 + " cc by cc by", None, "", "cc", "no license here", "under the terms of the Mozilla Public License 2.0 cc by sa 4.0",
]


def test_matches_a_plain_scan(spark, docs, edge):
    made = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for df in (made, docs.select("doc_id", "text"), edge):
        for r in licenses.scan(df).collect():
            check(True, r.text, r.licenses.n_words, r.licenses.base, r.licenses.found)


def test_one_passage_one_label(spark):
    df = spark.createDataFrame([(1, TEXTS[1])], "doc_id long, text string")
    assert [s.label for s in licenses.scan(df).first().licenses.found] == ["gpl-3.0", "lgpl-2.1"]


def test_many_detections_in_one_long_text(spark):
    df = spark.createDataFrame([(1, "x cc by y " * 5000)], "doc_id long, text string")
    r = licenses.scan(df).first().licenses
    assert len(r.base) == 5000 and r.base[-1].start == 4999 * 4 + 1


def test_empty_table_and_query(spark, empty, queries):
    assert licenses.scan(empty).count() == 0
    got = queries["op1_license_scan"](spark, SF001)
    assert got.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert got.where("score < 0 or score > 1 or (n_base = 0) <> (first_word is null)").count() == 0
