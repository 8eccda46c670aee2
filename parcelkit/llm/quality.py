"""Weak-supervision quality filter: rules vote or abstain, EM learns how far
each rule can be trusted, and a document is kept by its posterior.

Every rule looks at one measured property of a text and votes good, bad or
abstains. A latent-class model (one good class, one poor class per rule)
gives each rule its own chance of a bad vote in each class; votes are taken
as independent given the class. The vote pattern of a document (R rules,
three states) is all the model needs, so the corpus is reduced to counts per
pattern, at most 3**R rows whatever its size, and EM runs over that table.
The posterior then follows from a document's own votes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from parcelkit.llm.common import BLANKS, prepare, tmp_names

SYMBOLS = "#*$%&|<>"
WINDOW = 8
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = UPPER + UPPER.lower()

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_distinct", "n_upper", "n_letters", "n_marks"]
FEATURE_TYPE = T.StructType([T.StructField(f, T.LongType()) for f in FEATURES])


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words lying in a ``window``-word run that occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    if len(seen) > len(words) - 2:  # two equal runs repeat at least two words
        return 0
    # Equal runs have equal hashes: no equal hash, no repeat.
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(window):
            h = h * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + n].astype(np.uint64) + np.uint64(1)
    h.sort()
    if not (h[1:] == h[:-1]).any():
        return 0
    # Exact: rank runs of 1, 2, 4, ... words by pairing ranks.
    rank, size = ids, 1
    while size < window:
        step = min(size, window - size)
        a, b = rank[:len(rank) - step], rank[step:]
        rank = np.unique(a * (int(rank.max()) + 1) + b, return_inverse=True)[1]
        size += step
    dup = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:n] += dup
    edge[window:window + n] -= dup
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str | None) -> tuple:
    """The features of one whole text (null: as the empty text)."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # bytes.split() breaks at exactly the six ASCII blanks
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines), len(set(words)),
            len(raw) - len(raw.translate(None, UPPER)), len(raw) - len(raw.translate(None, LETTERS)),
            text.count("!") + text.count("?"))


def features(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in text], columns=FEATURES, dtype="int64")


@dataclass(frozen=True)
class Rule:
    """Votes on ``num / den``: bad beyond ``bad``, good within ``good``, else
    abstains (also where ``den`` is 0). ``sign`` -1 turns both tests round."""
    name: str
    num: str
    den: str
    bad: float
    good: float
    sign: int = 1

    def vote(self, f: pd.DataFrame) -> np.ndarray:
        """1 good, 0 bad, -1 abstains."""
        den = np.ones(len(f)) if self.den == "1" else f[self.den].to_numpy(dtype=float)
        x = self.sign * f[self.num].to_numpy(dtype=float) / np.maximum(den, 1)
        vote = np.where(x > self.sign * self.bad, 0, np.where(x <= self.sign * self.good, 1, -1))
        return np.where(den == 0, -1, vote).astype(np.int32)


RULES = (
    Rule("too_short", "n_words", "1", 19.5, 30, -1),
    Rule("repeated_runs", "n_repeat_words", "n_words", 0.30, 0.15),
    Rule("symbols", "n_symbols", "n_words", 0.10, 0.03),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.50, 0.15),
    Rule("capitals", "n_upper", "n_letters", 0.40, 0.15),
    Rule("marks", "n_marks", "n_words", 0.20, 0.08),
    Rule("few_words", "n_distinct", "n_words", 0.12, 0.20, -1),
    Rule("long_words", "word_chars", "n_words", 15, 10),
    Rule("short_words", "word_chars", "n_words", 2, 3, -1),
)


@dataclass(frozen=True)
class Model:
    """Class shares and each rule's chance of a bad vote by class. Class 0 is
    good; class j + 1 is poor in the way rule j looks for."""
    share: np.ndarray  # (R + 1,)
    bad: np.ndarray    # (R + 1, R)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a document is good, for rows of votes."""
        return np.exp(self._joint(votes)[:, 0] - np.logaddexp.reduce(self._joint(votes), axis=1))

    def _joint(self, votes: np.ndarray) -> np.ndarray:
        bad, good = (votes == 0).astype(float), (votes == 1).astype(float)
        return np.log(self.share) + bad @ np.log(self.bad).T + good @ np.log(1 - self.bad).T


def fit(patterns: np.ndarray, counts: np.ndarray, tol: float = 1e-10, rounds: int = 5000,
        misfire: float = 0.002) -> Model:
    """EM over vote patterns (rows of 1, 0, -1) with their document counts.

    Poor texts are of several kinds, and one kind seldom fails the rule for
    another; a single poor class would explain lone bad votes as noise of the
    good class. So each rule opens a poor class of its own, and EM estimates
    all shares and all rates. Votes alone cannot tell a lone bad vote of a
    poor text from a misfire on a good one, so the misfire rates carry a prior:
    ``misfire``, weighing as much as the corpus. Pseudo-documents keep every
    rate off 0 and 1.
    """
    r = patterns.shape[1]
    bad, good = (patterns == 0).astype(float), (patterns == 1).astype(float)
    first = np.vstack([np.full(r, misfire), np.where(np.eye(r) > 0, 0.95, 0.02)])
    share, rate = np.r_[0.9, np.full(r, 0.1 / r)], first
    last = -math.inf
    for _ in range(rounds):
        x = Model(share, rate)._joint(patterns)
        total = np.logaddexp.reduce(x, axis=1)
        now = float(counts @ total)
        w = counts[:, None] * np.exp(x - total[:, None])
        share = (w.sum(axis=0) + 0.1) / (counts.sum() + 0.1 * (r + 1))
        weight = np.r_[counts.sum() + 1, np.ones(r)][:, None]
        rate = (w.T @ bad + weight * first) / (w.T @ (bad + good) + weight)
        own = np.arange(r)
        rate[own + 1, own] = np.maximum(rate[own + 1, own], 0.95)  # else a class drifts off its rule
        if abs(now - last) <= tol * max(1.0, abs(now)):
            break
        last = now
    return Model(share, rate)


def learn(docs: DataFrame, text: str = "text", rules=RULES) -> Model:
    """Fit on the vote patterns of every row."""
    base = 3 ** np.arange(len(rules))

    @pandas_udf("long")
    def pattern(t: pd.Series) -> pd.Series:
        f = features(t)
        return pd.Series(np.stack([r.vote(f) + 1 for r in rules], axis=1).astype(np.int64) @ base)

    counted = docs.select(pattern(F.col(f"`{text}`")).alias("p")).groupBy("p").count()
    rows = sorted(map(tuple, counted.collect()))  # at most 3 ** len(rules) rows
    codes, counts = (np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1))
    return fit(codes[:, None] // base % 3 - 1, counts.astype(float))


def score(docs: DataFrame, text: str = "text", rules=RULES, min_posterior: float = 0.5) -> DataFrame:
    """``docs`` with struct column ``quality``: the features, the votes, the
    posterior probability of a good document, base_failed and kept.

    Two passes over the texts: one reduces them to pattern counts, one scores;
    nothing but the counts leaves the executors and nothing is shuffled but
    them. Null texts count as empty; an empty table gives an empty result;
    repeated rows count each. ``quality`` is the only added column: an input
    column of that name is replaced.
    """
    prepare(docs.sparkSession)
    model = learn(docs, text, rules)
    kind = T.StructType([*FEATURE_TYPE.fields, T.StructField("votes", T.ArrayType(T.IntegerType())),
                         T.StructField("posterior", T.DoubleType()), T.StructField("base_failed", T.BooleanType()),
                         T.StructField("kept", T.BooleanType())])

    @pandas_udf(kind)
    def judge(t: pd.Series) -> pd.DataFrame:
        f = features(t)
        votes = np.stack([r.vote(f) for r in rules], axis=1)
        p = model.posterior(votes)
        failed = (f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])
        return f.assign(votes=list(votes), posterior=p, base_failed=failed, kept=~failed & (p >= min_posterior))

    return docs.withColumn("quality", judge(F.col(f"`{text}`")))


def keep_good(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    (mark,) = tmp_names(docs, "kept")
    scored = score(docs.withColumnRenamed("quality", mark), text, **options) if "quality" in docs.columns else \
        score(docs, text, **options)
    out = scored.where(F.col("quality")["kept"]).drop("quality")
    return out.withColumnRenamed(mark, "quality") if "quality" in docs.columns else out
