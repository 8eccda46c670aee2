"""Mixing sources to target weights by a multivariate-hypergeometric tree.

Targets: sources in code-point order (null last) get weights that repeat and
share the corpus' words; a source that would exceed ``cap`` times its own
words stops there and the excess is shared anew among the others.

Blocks: a 63-bit hash of a document's id and text deals the documents of a
source to 1,024 blocks, which is a fixed random permutation. A source's mix
is whole passes over all its blocks, then the leading part of one more pass:
all documents whose hash lies below a threshold, found exactly from block
sums and the one block where the rest runs out, and a few single documents
whose sizes close what is left. So what a document gives follows from its
hash and one row of numbers per source.

Tree: the block draws of all sources are split among the output shards by a
binary tree. Each node halves its shards and draws the left half's blocks of
each source without replacement, a multivariate-hypergeometric draw seeded by
the node; a shard walks from the root to its leaf and so learns its own exact
quota per source and where its range of each source's draws begins. Ranges
are disjoint and cover all draws. Inside a shard documents are shuffled by a
hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.functions import pandas_udf

from parcelkit.llm.common import prepare, tmp_names
from parcelkit.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK_BITS = 10
BLOCKS = 1 << BLOCK_BITS
HASH_BITS = 63
# Words of one output shard.
SHARD_WORDS = 4_000_000
# Rounds that add single documents to close what a threshold leaves.
EXTRA_ROUNDS = 5
# Sources are categories of a corpus; their table is handled whole.
MAX_SOURCES = 100_000


@pandas_udf(T.LongType())
def word_count(text: pd.Series) -> pd.Series:
    """Words between ASCII blanks; null: 0."""
    return pd.Series([0 if t is None else len(t.encode("utf-8", "replace").split()) for t in text], dtype="int64")


def targets(sizes: list[int], weights=WEIGHTS, cap: float = CAP) -> list[float]:
    """Words each source is to give, sources in order."""
    out, left, total = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while left:
        share = sum(weights[i % len(weights)] for i in left)
        over = {i for i in left if total * weights[i % len(weights)] / share > cap * sizes[i]}
        for i in over or left:
            out[i] = float(cap * sizes[i]) if over else total * weights[i % len(weights)] / share
        if not over:
            break
        total -= sum(out[i] for i in over)
        left -= over
    return out


@dataclass(frozen=True)
class Plan:
    """What is known of each source, by its place in code-point order."""
    names: list          # source names, null last
    sizes: list
    targets: list
    full: np.ndarray     # whole passes
    limit: np.ndarray    # hashes below it are drawn once more
    extras: list         # single hashes that are drawn once more
    shards: int

    def partial(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, turn) of the draws after the whole passes, in order: the
        leading blocks and those of single documents once more, and a turn
        later those of single documents that lie below the limit already."""
        limit, shift = int(self.limit[i]), HASH_BITS - BLOCK_BITS
        once = {*range((limit - 1 >> shift) + 1 if limit else 0), *(u >> shift for u in self.extras[i] if u >= limit)}
        twice = {u >> shift for u in self.extras[i] if u < limit}
        pairs = sorted([(0, b) for b in once] + [(1, b) for b in twice])
        turn, block = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        return block, turn + int(self.full[i])


def _units(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> DataFrame:
    """(source, u, size) for each row of ``docs``."""
    return docs.select(F.col(f"`{source}`").alias("source"), unit_hash(doc_id, text, seed).alias("u"),
                       word_count(F.col(f"`{text}`")).alias("size"))


def unit_hash(doc_id: str, text: str, seed: int) -> Column:
    """63-bit hash that orders the documents of a source."""
    return F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`").isNull(), F.col(f"`{doc_id}`"),
                      F.col(f"`{text}`").isNull(), F.col(f"`{text}`")).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def make_plan(units: DataFrame, weights=WEIGHTS, cap: float = CAP, shard_words: int = SHARD_WORDS) -> Plan:
    """Targets, thresholds and extra documents from (source, u, size)."""
    spark = units.sparkSession
    sums = units.groupBy("source").agg(F.sum("size").alias("size"))
    rows = sums.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "replace")))
    names, sizes = [r["source"] for r in rows], [int(r["size"]) for r in rows]
    want = targets(sizes, weights, cap)
    full = np.array([min(int(cap), int(t // s)) if s else 0 for t, s in zip(want, sizes)], dtype=np.int64)
    rest = np.array([max(0.0, t - f * s) for t, f, s in zip(want, full, sizes)])
    rest[rest < 0.5] = 0.0
    n = len(names)

    def table(**cols) -> DataFrame:
        kind = {int: T.LongType(), float: T.DoubleType()}
        fields = [T.StructField("source", T.StringType())] + [
            T.StructField(k, kind[type(v[0])] if len(v) else T.LongType()) for k, v in cols.items()]
        data = [(names[i], *(v[i] for v in cols.values())) for i in range(n)]
        return F.broadcast(spark.createDataFrame(data, T.StructType(fields)))  # at most MAX_SOURCES rows

    # Rows of equal hash are one unit: they are drawn together or not at all.
    once = units.groupBy("source", "u").agg(F.sum("size").alias("size"))
    block = F.shiftright("u", HASH_BITS - BLOCK_BITS)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    need = table(rest=[float(x) for x in rest])
    blocks = once.groupBy("source", block.alias("block")).agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0)))  # 1,024 rows a source
    edge = before.join(need, same(before, need)).where((F.col("before") <= F.col("rest"))
                                                       & (F.col("before") + F.col("size") > F.col("rest")))
    edge = edge.select(before["source"].alias("e_source"), "block", "before", "rest")
    inside = once.withColumn("b", block).join(edge, once["source"].eqNullSafe(F.col("e_source"))
                                              & (F.col("b") == F.col("block")))
    along = Window.partitionBy("source").orderBy("u").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(along))  # one block of a source
    cut = inside.where("upto > rest").groupBy("source").agg(F.min("u").alias("u"))
    took = inside.where("upto <= rest").groupBy("source").agg(F.max("upto").alias("taken"))
    limits = {r["source"]: int(r["u"]) for r in cut.collect()}
    limit = np.array([limits.get(s, 0) if rest[i] else 0 for i, s in enumerate(names)], dtype=np.int64)
    base = {r["source"]: int(r["before"]) for r in edge.select(F.col("e_source").alias("source"), "before").collect()}
    base |= {r["source"]: int(r["taken"]) for r in took.collect()}
    short = [max(0.0, float(rest[i]) - base.get(s, 0)) if rest[i] else 0.0 for i, s in enumerate(names)]

    extras: list = [[] for _ in names]
    for last in [False] * (EXTRA_ROUNDS - 1) + [True]:
        if not any(x >= 1 for x in short):
            break
        # Below the limit a document has full + 1 copies already.
        state = table(limit=[int(x) if f + 1 >= cap else 0 for x, f in zip(limit, full)], short=[float(x) for x in short])
        gone = [u for e in extras for u in e]
        # The largest one that fits; at the end the nearest, above or below.
        fits = F.abs(F.col("size") - F.col("short")) < F.col("short") if last else F.col("size") <= F.col("short")
        free = once.join(state, same(once, state)).where((F.col("u") >= F.col("limit")) & (F.col("size") > 0) & fits)
        if gone:  # at most EXTRA_ROUNDS a source
            free = free.where(~F.col("u").isin(gone)) if len(gone) < 1000 else free.join(
                F.broadcast(spark.createDataFrame([(u,) for u in gone], "u long")), "u", "left_anti")
        best = free.groupBy(once["source"]).agg(
            F.min(F.struct(F.abs(F.col("size") - F.col("short")).alias("off"), "u", "size")).alias("m"))
        found = {r["source"]: r["m"] for r in best.collect()}
        for i, s in enumerate(names):
            if s in found:
                extras[i].append(int(found[s]["u"]))
                short[i] -= int(found[s]["size"])
    shards = max(1, round(sum(want) / shard_words))
    return Plan(names, sizes, want, full, limit, extras, shards)


def leaf(shard: int, shards: int, quotas: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) of the draws of each source that go to ``shard``."""
    lo, hi, first, have = 0, shards, np.zeros_like(quotas), quotas.copy()
    while hi - lo > 1:
        mid = (lo + hi) // 2
        total = int(have.sum())
        take = total * (mid - lo) // (hi - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(have, take, method="marginals") if total else have * 0
        if shard < mid:
            have, hi = left, mid
        else:
            first, have, lo = first + left, have - left, mid
    return first, have


def assign(spark, plan: Plan, seed: int) -> DataFrame:
    """(source_at, block, shards): the shard of each pass over a block."""
    quotas = np.array([int(plan.full[i]) * BLOCKS + len(plan.partial(i)[0]) for i in range(len(plan.names))], dtype=np.int64)

    def walk(batches):
        for pdf in batches:
            for shard in pdf["id"]:
                first, count = leaf(int(shard), plan.shards, quotas, seed)
                for i in np.flatnonzero(count):
                    d = np.arange(first[i], first[i] + count[i])
                    block, turn = d % BLOCKS, d // BLOCKS
                    after = d - int(plan.full[i]) * BLOCKS
                    last = after >= 0
                    block[last], turn[last] = (x[after[last]] for x in plan.partial(i))
                    yield pd.DataFrame({"source_at": np.int32(i), "block": block, "turn": turn, "shard": np.int64(shard)})

    draws = spark.range(plan.shards).mapInPandas(walk, "source_at int, block long, turn long, shard long")
    out = draws.groupBy("source_at", "block").agg(F.array_sort(F.collect_list(F.struct("turn", "shard"))).alias("t"))
    return out.select("source_at", "block", F.col("t.shard").alias("shards"))  # at most cap turns a block


def place(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          weights=WEIGHTS, cap: float = CAP, shard_words: int = SHARD_WORDS, seed: int = 7) -> DataFrame:
    """``docs`` with struct column ``mix``: size, source_size, target (its
    source's), shards (the output shard of each copy taken, possibly none)
    and hash. Every row is returned once.

    A null source is a source of its own, last in order; a null text has size
    0; repeated rows are drawn alike; an empty table gives an empty result.
    Reruns agree: all draws are seeded, and hashes depend on the rows alone.
    """
    spark = docs.sparkSession
    prepare(spark)
    plan = make_plan(materialize(_units(docs, doc_id, text, source, seed), "mix-units"), weights, cap, shard_words)
    blocks = assign(spark, plan, seed)
    if len(plan.names) * BLOCKS <= 1_000_000:  # rows of the table at most
        blocks = F.broadcast(blocks)
    info = spark.createDataFrame(
        [(s, i, int(plan.sizes[i]), float(plan.targets[i]), int(plan.full[i]), int(plan.limit[i]), plan.extras[i])
         for i, s in enumerate(plan.names)],
        "source_name string, source_at int, source_size long, target double, full int, lim long, extras array<long>")
    names = tmp_names(docs, "mix_u", "mix_info", "mix_block", "mix_shards", "mix_at")
    u, about, block, shards, at = names
    info = F.broadcast(info.select(F.col("source_name").alias(at), F.struct(*info.columns).alias(about)))
    tab = blocks.select(F.struct("source_at", "block").alias(block), F.col("shards").alias(shards))
    rows = docs.withColumn(u, unit_hash(doc_id, text, seed)).join(
        info, F.col(f"`{source}`").eqNullSafe(F.col(at)))
    key = F.struct(F.col(about)["source_at"].alias("source_at"),
                   F.shiftright(u, HASH_BITS - BLOCK_BITS).alias("block"))
    rows = rows.join(tab.withColumnRenamed(block, block + "_t"), key == F.col(block + "_t"), "left")
    copies = (F.col(about)["full"] + (F.col(u) < F.col(about)["lim"]).cast("int")
              + F.array_contains(F.col(about)["extras"], F.col(u)).cast("int"))
    mix = F.struct(word_count(F.col(f"`{text}`")).alias("size"), F.col(about)["source_size"].alias("source_size"),
                   F.col(about)["target"].alias("target"),
                   F.coalesce(F.slice(F.col(shards), F.lit(1), copies), F.array().cast("array<long>")).alias("shards"),
                   F.col(u).alias("hash"))
    return rows.withColumn("mix", mix).select(*(f"`{c}`" for c in docs.columns if c != "mix"), "mix")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: a row of ``docs``, with its columns, for each copy
    taken; the rows of a shard lie together, shuffled by hash."""
    placed = place(docs, **options)
    shard, turn = tmp_names(placed, "mix_shard", "mix_turn")
    out = placed.select("*", F.posexplode("mix.shards").alias(turn, shard))
    out = out.repartition(shard).sortWithinPartitions(shard, F.xxhash64("mix.hash", turn))
    return out.select(*(f"`{c}`" for c in docs.columns if c != "mix"))
