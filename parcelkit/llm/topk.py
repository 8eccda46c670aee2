"""Exact top-k search by inner product with multi-resolution segment bounds.

Vectors are cut into segments. With mean m and deviation s of a segment of
length L, the inner product over it is at most L * (m_q m_x + s_q s_x); as
|q - x|^2 = |q|^2 + |x|^2 - 2 q.x, that is the lower bound of the distance
from segment means and deviations, for scores that are inner products. Each
task goes through its rows in blocks, bounds all query-row pairs with few
segments, the pairs left with more, and computes the exact integer score of
the survivors; what cannot enter the query's best so far is left out.

Queries are taken in blocks of a bounded number, each sent to all tasks; a
task returns its best rows per query, which are written before the next block
is sent, and those are ranked by a window. A task goes through a block in
tiles of queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelkit.llm.common import prepare
from parcelkit.session import materialize

SCALE = 1024
LEVELS = (1, 4, 16)
QUERY_BLOCK = 8192
# Share of pairs above which a level is computed for whole blocks.
DENSE = 0.05
# Queries and rows whose pairs are bounded at once: what a task holds besides
# its queries does not grow with the block of queries.
TILE = 512
ROWS = 2048
EXACT = 2.0 ** 53
LONG = (-(1 << 63), (1 << 63) - 1)


def usable(vec: pa.Array) -> tuple[np.ndarray, list]:
    """(row numbers, floor(SCALE * x) as float64 vectors) of the rows that are
    not null and hold neither nulls nor non-finite components."""
    out, at = [], []
    values = vec.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    ok = np.isfinite(flat)  # null components are NaN here
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(flat * SCALE)
    sizes = np.array([0 if n is None else n for n in vec.value_lengths().to_pylist()], dtype=np.int64)
    ends = np.cumsum(sizes)
    bad = np.r_[0, np.cumsum(~ok)]
    good = np.flatnonzero(np.asarray(vec.is_valid()) & (bad[ends] == bad[ends - sizes]))
    for i in good.tolist():
        at.append(i)
        out.append(flat[ends[i] - sizes[i]:ends[i]])
    return np.array(at, dtype=np.int64), out


def profile(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(L) * mean and sqrt(L) * deviation per segment: the bound
    of two vectors is the inner product of their profiles."""
    if not x.shape[1]:
        return np.zeros((len(x), 1))
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)[:-1]
    size = np.diff(np.r_[cuts, x.shape[1]])
    total, square = np.add.reduceat(x, cuts, axis=1), np.add.reduceat(x * x, cuts, axis=1)
    spread = np.sqrt(np.maximum(square - total * total / size, 0))
    return np.concatenate([total / np.sqrt(size), spread], axis=1)


def exact(q: np.ndarray, x: np.ndarray, pairs: tuple | None = None) -> np.ndarray:
    """Integer inner products: of all rows, or of the (i, j) pairs. Doubles
    hold them exactly below 2**53; beyond it they are summed as Python
    integers and saturate at the ends of a long."""
    reach = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if reach < EXACT:
        s = q @ x.T if pairs is None else np.einsum("ij,ij->i", q[pairs[0]], x[pairs[1]])
        return np.rint(s).astype(np.int64)
    big = [[int(v) for v in row] for row in q], [[int(v) for v in row] for row in x]
    todo = pairs or np.indices((len(q), len(x))).reshape(2, -1)
    s = np.array([min(max(sum(a * b for a, b in zip(big[0][i], big[1][j])), LONG[0]), LONG[1])
                  for i, j in zip(*(t.tolist() for t in todo))], dtype=np.int64)
    return s.reshape(len(q), len(x)) if pairs is None else s


class Search:
    """Best ``keep`` rows of each query among the rows seen so far."""

    def __init__(self, queries: np.ndarray, keep: int):
        self.tiles = [Tile(queries[i:i + TILE], keep) for i in range(0, len(queries), TILE)]

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        lo, step = 0, 64  # small first blocks raise the floors
        while lo < len(x):
            rows = x[lo:lo + step]
            profiles = [profile(rows, s) for s in LEVELS]
            for tile in self.tiles:
                tile.add(ids[lo:lo + step], rows, profiles)
            lo, step = lo + step, min(ROWS, step * 4)

    def results(self):
        """(query number, score, id) arrays, tile by tile."""
        for i, tile in enumerate(self.tiles):
            q, score, found = tile.best
            yield q + i * TILE, score, found


class Tile:
    """The search for up to TILE queries."""

    def __init__(self, queries: np.ndarray, keep: int):
        self.q, self.keep, n = queries, keep, len(queries)
        self.profiles = [profile(queries, s) for s in LEVELS]
        self.floor = np.full(n, -np.inf)  # score that a row must reach
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, ids: np.ndarray, x: np.ndarray, profiles: list) -> None:
        pairs = None
        if np.isfinite(self.floor).any():
            for p, r in zip(self.profiles, profiles):
                slack = 1e-9 * np.linalg.norm(p, axis=1).max(initial=0) * np.linalg.norm(r, axis=1).max(initial=0) + 1e-6
                if pairs is None:
                    pairs = np.nonzero(p @ r.T + slack >= self.floor[:, None])
                    continue
                if len(pairs[0]) > DENSE * len(p) * len(x):
                    bound = (p @ r.T)[pairs]
                else:
                    bound = np.einsum("ij,ij->i", p[pairs[0]], r[pairs[1]])
                left = bound + slack >= self.floor[pairs[0]]
                pairs = pairs[0][left], pairs[1][left]
        if pairs is None or len(pairs[0]) > DENSE * len(self.q) * len(x):
            scores = exact(self.q, x)
            qi, xi = np.nonzero(scores >= self.floor[:, None]) if pairs is None else pairs
            scores = scores[qi, xi]
        else:
            (qi, xi), scores = pairs, exact(self.q, x, pairs)
        enough = scores >= self.floor[qi]
        qi, scores, found = qi[enough], scores[enough], ids[xi[enough]]
        if not len(qi):
            return
        qi, scores, found = (np.concatenate([a, b]) for a, b in zip(self.best, (qi, scores, found)))
        order = np.lexsort((found, -scores, qi))
        qi, scores, found = qi[order], scores[order], found[order]
        first = np.searchsorted(qi, np.arange(len(self.q) + 1))
        rank = np.arange(len(qi)) - first[qi]
        top = rank < self.keep
        self.best = qi[top], scores[top], found[top]
        full = np.flatnonzero(np.diff(first) >= self.keep)
        self.floor[full] = scores[first[full] + self.keep - 1]


def _search(block, keep: int):
    """Rows of a task against one query block: (q, score, vec_id)."""
    schema = pa.schema([("q", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def run(batches):
        by_size: dict = {}
        for at, vec in block.value:
            by_size.setdefault(len(vec), []).append((at, vec))
        searches = {n: (np.array([a for a, _ in v]), Search(np.array([x for _, x in v], dtype=np.float64).reshape(len(v), n), keep))
                    for n, v in by_size.items()}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            rows, vecs = usable(batch.column("vec"))
            size = np.array([len(v) for v in vecs], dtype=np.int64)
            for n, (_, search) in searches.items():
                mine = np.flatnonzero(size == n)
                if len(mine):
                    search.add(ids[rows[mine]].astype(np.int64), np.array([vecs[i] for i in mine]).reshape(len(mine), n))
        for at, search in searches.values():
            for q, score, found in search.results():
                yield pa.RecordBatch.from_arrays([pa.array(at[q]), pa.array(score), pa.array(found)], schema=schema)
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vec: str = "embedding",
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query``, the
    ``k`` rows of highest integer inner product besides itself, ties to the
    smaller vec_id.

    Rows with a null id, a null vector, or a null or non-finite component
    take no part; vectors are compared with those of their own length only.
    Rows may repeat: of a query's own id and score one row is the query
    itself, others are candidates, and a repeated query gets its answers once
    per row. Fewer candidates give fewer rows; an empty table gives none.
    """
    spark = vectors.sparkSession
    prepare(spark)
    valid = vectors.where(F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{vec}`").isNotNull())
    rows = valid.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vec}`").alias("vec"))
    asked = materialize(valid.where(is_query).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                                                     F.col(f"`{vec}`").alias("vec"))
                        .withColumn("q", F.monotonically_increasing_id()), "topk-queries")
    blocks = max(1, -(-asked.count() // query_block))
    found = []
    for b in range(blocks):
        # Rows of a task are dealt in turn, so a block has query_block rows
        # and one more per task at most.
        part = asked.where(F.pmod("q", F.lit(blocks)) == b).collect()
        lists = pa.array([list(r["vec"]) for r in part], pa.list_(pa.float64()))
        at, vecs = usable(lists) if part else ([], [])
        queries = spark.createDataFrame(
            pd.DataFrame({"q": [part[i]["q"] for i in at], "query_id": [part[i]["vec_id"] for i in at],
                          "own": [int(exact(v[None], v[None])[0, 0]) for v in vecs]}, dtype="int64"),
            "q long, query_id long, own long")
        block = spark.sparkContext.broadcast([(part[i]["q"], v) for i, v in zip(at, vecs)])
        best = rows.mapInArrow(_search(block, k + 1), "q long, score long, vec_id long")
        # Written at once, so neither the driver nor a task holds two blocks.
        found.append(materialize(best.join(F.broadcast(queries), "q"), "topk-block"))
        block.destroy()
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    top = out.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    alike = Window.partitionBy("q").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    top = top.withColumn("self", own & (F.sum(own.cast("int")).over(alike) == 1)).where(~F.col("self"))
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("n"))).where(F.col("rank") <= k)
    return top.select("query_id", "rank", "vec_id", "score")
