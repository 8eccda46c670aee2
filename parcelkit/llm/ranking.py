"""Ranked lexical search with MaxScore and pair bounds.

Documents are reduced to their counts of the query terms once (stored), and
their corpus statistics give each term its weight. A task then turns its rows
into shards, each an inverted index whose postings carry the term's exact
integer share of the score, and answers every query on each shard:

* Precomputed for the shard: each list's largest share, and for pairs of a
  query's terms the list of documents that hold both, with the sum of both
  shares and the largest such sum. A document gets from a pair at most the
  largest of the joint maximum and the two single maxima, which is less than
  the sum of the single maxima unless the two peak in one document.
* At query time the terms are taken pair by pair, largest bound first. Once
  the combined bound of the pairs left is below the score to beat, documents
  seen in none of the lists so far are skipped (MaxScore), and the lists left
  are only looked up for candidates whose score so far plus the bound of the
  pairs left still reaches it.
* The score to beat starts at the 50th best of a sample of the rows and at
  the pair lists' own joint shares. Any subset of documents gives a valid
  lower bound, so results are exact.

Queries go in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelkit.llm.common import prepare
from parcelkit.session import materialize

# Bytes of query text in one block (its distinct terms are what tasks hold).
BLOCK_BYTES = 4_000_000
# Postings of one in-memory shard, and documents, whichever comes first.
SHARD_POSTINGS = 2_000_000
SHARD_DOCS = 200_000
# One row in so many gives the queries' first score to beat.
SAMPLE = 64
# ASCII letters lower-cased, digits and all bytes of other characters kept, the rest blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order, as UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 50 + (50 * n * n_docs) // n_terms


# --- documents -> counts of query terms ----------------------------------------------

def _count(vocabulary):
    """(doc_id, n, terms, tfs): number of terms of each document that has
    any, and its query terms with their counts."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                        ("tfs", pa.list_(pa.int32()))])

    def run(batches):
        known = vocabulary.value.get
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            keep, length, sizes, found, counts = [], [], [0], [], []
            for i in range(batch.num_rows):
                words = terms(texts[i].as_py())
                if not words:
                    continue
                code = np.fromiter(map(known, words, repeat(-1)), dtype=np.int32, count=len(words))
                kind, tf = np.unique(code, return_counts=True)
                skip = 1 if kind[0] < 0 else 0
                keep.append(i)
                length.append(len(words))
                sizes.append(len(kind) - skip)
                found.append(kind[skip:])
                counts.append(tf[skip:].astype(np.int32))
            ends = pa.array(np.cumsum(sizes), pa.int32())
            flat = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int32), pa.int32()) for x in (found, counts)]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep, pa.int64())), pa.array(length, pa.int64()),
                 *(pa.ListArray.from_arrays(ends, f) for f in flat)], schema=schema)
    return run


# --- one shard -------------------------------------------------------------------------

class Shard:
    """Inverted index of some documents over the query terms.

    ``doc``/``term``/``tf`` are parallel postings; ``weights`` by term,
    ``norms`` by document, ``ids`` the documents' ids (None: null)."""

    def __init__(self, doc, term, tf, weights, norms, ids):
        order = np.argsort(term, kind="stable")
        self.ids, self.size = ids, len(norms)
        term = term[order]
        self.docs = doc[order]
        tf = tf[order].astype(np.int64)
        self.share = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * norms[self.docs]))
        bounds = np.searchsorted(term, np.arange(len(weights) + 1))
        self.first, self.end = bounds[:-1], bounds[1:]
        self.top = np.zeros(len(weights), dtype=np.int64)
        held = np.flatnonzero(self.end > self.first)
        if len(held):
            self.top[held] = np.maximum.reduceat(self.share, self.first[held])
        self.pairs: dict = {}
        self.read = 0  # postings visited, for tests

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        return self.docs[self.first[t]:self.end[t]], self.share[self.first[t]:self.end[t]]

    def units(self, query: np.ndarray) -> list[tuple]:
        """A query's terms that occur here, paired in order of their largest
        share (ties by term): [(a, b) or (a,)]."""
        here = query[self.top[query] > 0]
        here = here[np.lexsort((here, -self.top[here]))].tolist()
        return [tuple(here[i:i + 2]) for i in range(0, len(here), 2)]

    def join_pairs(self, queries: list[np.ndarray]) -> None:
        """The intersection list of every pair of the queries, with joint
        shares. Each first term is spread out once for all its partners."""
        wanted: dict = {}
        for q in queries:
            for u in self.units(q):
                if len(u) == 2:
                    wanted.setdefault(u[0], set()).add(u[1])
        spread = np.zeros(self.size, dtype=np.int64)
        for a, partners in wanted.items():
            docs, share = self.postings(a)
            spread[docs] = share
            for b in partners:
                other, more = self.postings(b)
                both = spread[other]
                at = np.flatnonzero(both)
                self.pairs[a, b] = other[at], both[at] + more[at]
            spread[docs] = 0

    def bound(self, unit: tuple) -> int:
        """The most that one document can get from a unit."""
        if len(unit) == 1:
            return int(self.top[unit[0]])
        joint = self.pairs.get(unit)
        if joint is None:
            return int(self.top[unit[0]] + self.top[unit[1]])
        return int(max(joint[1].max(initial=0), self.top[unit[0]], self.top[unit[1]]))

    def search(self, query: np.ndarray, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that hold the k best scores of at least
        ``floor``, all ties included."""
        units = self.units(query)
        bounds = [self.bound(u) for u in units]
        order = sorted(range(len(units)), key=lambda i: -bounds[i])
        units, bounds = [units[i] for i in order], [bounds[i] for i in order]
        left = np.r_[np.cumsum(bounds[::-1])[::-1], 0] if bounds else np.zeros(1, dtype=np.int64)
        for u in units:
            joint = self.pairs.get(u)
            if joint is not None and len(joint[1]) >= k:
                floor = max(floor, int(np.partition(joint[1], -k)[-k]))
        score = np.zeros(self.size, dtype=np.int64)
        at = 0
        while at < len(units) and left[at] >= floor:
            for t in units[at]:
                docs, share = self.postings(t)
                score[docs] += share
                self.read += len(docs)
            at += 1
            if at & (at - 1) == 0:  # after 1, 2, 4, ... units
                floor = max(floor, _kth(score, k))
        # Candidates: seen, and able to reach the floor with the pairs left.
        found = np.flatnonzero((score > 0) & (score + left[at] >= floor))
        while at < len(units) and len(found):
            for t in units[at]:
                docs, share = self.postings(t)
                if len(docs) <= len(found):
                    score[docs] += share
                else:
                    where = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                    score[found] += np.where(docs[where] == found, share[where], 0)
                self.read += min(len(docs), len(found))
            at += 1
            floor = max(floor, _kth(score[found], k))
            found = found[score[found] + left[at] >= floor]
        found = found[score[found] >= max(floor, _kth(score[found], k))]
        return found, score[found]


def _kth(score: np.ndarray, k: int) -> int:
    return int(np.partition(score, -k)[-k]) if len(score) >= k else 0


class Best:
    """The k best (score, document) of each query in a task; equal scores by
    ascending id, null ids last."""

    def __init__(self, k: int, floors: list[int]):
        self.k, self.floors = k, list(floors)
        self.rows: list[list] = [[] for _ in floors]

    def add(self, q: int, scores: np.ndarray, ids: list) -> None:
        rows = self.rows[q] + list(zip(scores.tolist(), ids))
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        self.rows[q] = rows[:self.k]
        if len(rows) >= self.k:
            self.floors[q] = max(self.floors[q], rows[self.k - 1][0])


def _search(plan, k: int):
    """Answers of a task's rows: (q, score, doc_id)."""
    schema = pa.schema([("q", pa.int64()), ("score", pa.int64()), ("doc_id", pa.int64())])

    def run(batches):
        numbers, queries, weights, floors, n_docs, n_terms = plan.value
        best = Best(k, floors)
        held: list = []

        def flush():
            doc = np.concatenate([h[0] for h in held])
            shard = Shard(doc, *(np.concatenate([h[i] for h in held]) for i in (1, 2)), weights,
                          np.concatenate([h[3] for h in held]), [x for h in held for x in h[4]])
            shard.join_pairs(queries)
            for i, q in enumerate(queries):
                docs, scores = shard.search(q, k, best.floors[i])
                if len(docs):
                    best.add(i, scores, [shard.ids[d] for d in docs.tolist()])

        size = rows = 0
        for batch in batches:
            tf, term = batch.column("tfs"), batch.column("terms")
            sizes = term.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            norms = np.array([length_norm(n, n_docs, n_terms) for n in batch.column("n").to_pylist()], dtype=np.int64)
            held.append((rows + np.repeat(np.arange(len(sizes)), sizes), term.flatten().to_numpy(),
                         tf.flatten().to_numpy(), norms, batch.column("doc_id").to_pylist()))
            size, rows = size + int(sizes.sum()), rows + len(sizes)
            if size >= SHARD_POSTINGS or rows >= SHARD_DOCS:
                flush()
                held, size, rows = [], 0, 0
        if held:
            flush()
        for i, found in enumerate(best.rows):
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([numbers[i]] * len(found), pa.int64()), pa.array([r[0] for r in found], pa.int64()),
                     pa.array([r[1] for r in found], pa.int64())], schema=schema)
    return run


# --- blocks of queries -----------------------------------------------------------------

def _blocks(asked: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """``asked`` with a column block, so that no block of several queries has
    more than ``limit`` bytes of text."""
    total = asked.agg(F.sum(F.octet_length("text")).alias("s")).first()["s"] or 0
    n = max(1, -(-total // limit))
    while True:
        dealt = asked.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(n)))
        sizes = dealt.groupBy("block").agg(F.sum(F.octet_length("text")).alias("s"), F.count("*").alias("c"))
        if sizes.where((F.col("s") > limit) & (F.col("c") > 1)).isEmpty():
            return dealt, n
        n *= 2


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` the ``k``
    documents of highest score above 0, equal scores by ascending doc_id
    (null ids last).

    A null or empty document has no terms, so it neither counts nor is
    found; an item without terms, or whose terms no document holds, has no
    rows. Repeated documents are documents of their own; repeated items each
    get their answers. Extra columns are left out. Empty tables give an empty
    result.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    asked = materialize(items.select(F.col(f"`{item_id}`").alias("item_id"),
                                     F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text"))
                        .withColumn("q", F.monotonically_increasing_id()), "ranking-items")
    dealt, n = _blocks(asked, block_bytes)
    answers = [_answer(rows, dealt.where(F.col("block") == b), k) for b in range(n)]
    found = answers[0]
    for a in answers[1:]:
        found = found.union(a)
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def _answer(rows: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """(q, score, doc_id): what one block's queries find; k rows per query
    and task at most, stored, so that the block's broadcasts can go."""
    sc = rows.sparkSession.sparkContext
    asked = [(r["q"], set(terms(r["text"]))) for r in block.select("q", "text").collect()]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(t for _, t in asked))))} if asked else {}
    words = sc.broadcast(vocabulary)
    counted = materialize(rows.where(F.length("text") > 0).mapInArrow(
        _count(words), "doc_id long, n long, terms array<int>, tfs array<int>"), "ranking-counts")
    total = counted.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = {r["t"]: r["count"] for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    weights = np.array([weight(total["docs"], df.get(t, 0)) for t in range(len(vocabulary))], dtype=np.int64)
    numbers = [q for q, _ in asked]
    queries = [np.array(sorted(vocabulary[t] for t in ts), dtype=np.int64) for _, ts in asked]
    useful = counted.where(F.size("terms") > 0)

    def run(part: DataFrame, floors: list[int]) -> DataFrame:
        plan = sc.broadcast((numbers, queries, weights, floors, total["docs"], total["terms"]))
        found = materialize(part.mapInArrow(_search(plan, k), "q long, score long, doc_id long"), "ranking-found")
        plan.destroy()
        return found

    # The sample's k-th best is a floor for the whole: more documents can only raise it.
    sample = run(useful.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SAMPLE)) == 0), [1] * len(numbers))
    kth = sample.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).where(F.col("r") == k)
    floor = {r["q"]: r["score"] for r in kth.collect()}
    found = run(useful, [max(1, floor.get(q, 1)) for q in numbers])
    words.destroy()
    return found
