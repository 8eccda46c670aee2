"""Helpers shared by the training-data operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelkit.session import ensure_checkpoint_dir, materialize, ship_package
from parcelkit.sources.tables import read_table

# Rows of one Arrow batch handed to a Python worker; texts may be long, so
# a batch stays small.
ARROW_ROWS = 2000
# ASCII blanks: the word separators of the contracts ([\x20\x09-\x0D]).
BLANKS = " \t\n\x0b\x0c\r"


def prepare(spark: SparkSession) -> None:
    """What the Python stages rely on: the shared checkpoint folder, the
    package on the executors and small Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    prepare(spark)
    return read_table(spark, sf_dir, name)


def row_key(*cols: str | Column) -> Column:
    """128-bit key of the given columns (nulls count as a value of their own),
    as a struct of two longs. Two seeds keep accidental equality out of reach
    at 10^11 rows, where one 64-bit hash would collide."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    parts = [x for c in cols for x in (c.isNull(), c)]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(0x9E3779B9), *parts).alias("b"))


def tmp_names(df: DataFrame, *names: str) -> list[str]:
    """The given working-column names, lengthened until no column of ``df``
    has them (extra input columns may carry any name)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Components of an undirected graph given as edges (a, b) of one
    orderable type: returns (node, root) for every node of an edge, where
    root is the smallest node of its component.

    Alternating large-star / small-star contraction: each half-round is one
    grouped minimum and one equi-join, and the number of rounds grows with
    the logarithm of the component size. Every round is written to the
    shared checkpoint folder, so a lost executor costs one round at most.
    Nothing is collected but a row count and a checksum per round.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = materialize(e, name)
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), name)
        now = e.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)
