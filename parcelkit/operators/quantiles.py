"""Exact quantiles without gathering a column into one task.

Linear interpolation between order statistics, as pandas ``quantile``:
``h = (n - 1) q``, value = ``v[floor h] + (h - floor h) (v[ceil h] - v[floor h])``.

Each order statistic is found by histogram refinement: per target, one
distributed pass bins the values inside the current range into B bins and
returns ``count, min, max`` per bin (a small result); the bin holding the
target rank becomes the next range. When a range holds at most ``leaf``
values (or a single distinct value) those values are read directly. Every
pass is a filter + partial aggregation; no task ever holds more than one
histogram or one leaf.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 1024
LEAF = 20000


def order_statistics(values: DataFrame, key: str, targets: dict[tuple, int],
                     bins: int = BINS, leaf: int = LEAF, ext: dict | None = None) -> dict[tuple, float]:
    """``values``: ``key, v`` (non-null doubles). ``targets``: {(key_value, rank): rank}
    with 0-based ranks. ``ext``: optional {key_value: (min, max)}.
    Returns {(key_value, rank): value}."""
    spark = values.sparkSession
    if ext is None:
        ext = {r[key]: (r["lo"], r["hi"]) for r in values.groupBy(key).agg(
            F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    # state per target: (lo, hi, rank within [lo, hi])
    state = {t: (ext[t[0]][0], ext[t[0]][1], r) for t, r in targets.items() if t[0] in ext}
    out: dict[tuple, float] = {}
    # Every pass keeps at most one bin of a range, so ranges shrink to a leaf
    # or to one distinct value.
    while True:
        active = {t: s for t, s in state.items() if t not in out}
        if not active:
            break
        for t, (lo, hi, r) in list(active.items()):
            if lo == hi:
                out[t] = lo
                del active[t]
        if not active:
            break
        tids = list(active)
        tdf = spark.createDataFrame(
            [(i, t[0], float(lo), float(hi)) for i, (t, (lo, hi, _)) in enumerate(active.items())],
            f"tid int, {key} {values.schema[key].dataType.simpleString()}, lo double, hi double")
        j = values.join(F.broadcast(tdf), key).filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        b = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(bins)),
                    F.lit(bins - 1))
        hist = (j.groupBy("tid", b.alias("b"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"))
                 .collect())
        per: dict[int, list] = {}
        for row in hist:
            per.setdefault(row["tid"], []).append((row["b"], row["n"], row["mn"], row["mx"]))
        leaves = []
        for i, t in enumerate(tids):
            lo, hi, r = active[t]
            acc = 0
            for bb, n, mn, mx in sorted(per.get(i, [])):
                if r < acc + n:
                    nr = r - acc
                    if mn == mx:
                        out[t] = mn
                    elif n <= leaf:
                        leaves.append((t, mn, mx, nr))
                    else:
                        state[t] = (mn, mx, nr)
                    break
                acc += n
        if leaves:
            # all leaves in one pass: each leaf range holds at most ``leaf`` values
            ldf = spark.createDataFrame(
                [(i, t[0], float(mn), float(mx)) for i, (t, mn, mx, _) in enumerate(leaves)],
                f"lid int, {key} {values.schema[key].dataType.simpleString()}, lo double, hi double")
            got = (values.join(F.broadcast(ldf), key)
                         .filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                         .groupBy("lid").agg(F.sort_array(F.collect_list("v")).alias("vs")).collect())
            by = {r["lid"]: r["vs"] for r in got}
            for i, (t, _mn, _mx, nr) in enumerate(leaves):
                out[t] = by[i][nr]
    return out


def exact_quantiles(values: DataFrame, key: str, probs: list[float]) -> DataFrame:
    """``key, q_<i>`` per key for each probability in ``probs`` (pandas linear)."""
    spark = values.sparkSession
    # every pass reads this projection; persisted (recomputed from lineage if lost)
    vals = values.select(key, F.col("v").cast("double").alias("v")).filter(F.col("v").isNotNull()).persist()
    stats = vals.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"),
                                  F.max("v").alias("hi")).collect()
    counts = {r[key]: r["n"] for r in stats}
    ext = {r[key]: (r["lo"], r["hi"]) for r in stats}
    targets = {}
    for k, n in counts.items():
        for q in probs:
            h = (n - 1) * q
            for rk in {math.floor(h), math.ceil(h)}:
                targets[(k, rk)] = rk
    got = order_statistics(vals, key, targets, ext=ext)
    vals.unpersist()
    rows = []
    for k, n in counts.items():
        row = [k]
        for q in probs:
            h = (n - 1) * q
            lo, hi = math.floor(h), math.ceil(h)
            a, b = got[(k, lo)], got[(k, hi)]
            row.append(a + (h - lo) * (b - a))
        rows.append(tuple(row))
    schema = f"{key} {values.schema[key].dataType.simpleString()}, " + ", ".join(
        f"q_{i} double" for i in range(len(probs)))
    return spark.createDataFrame(rows, schema)


ACCURACY = 10_000     # of the mergeable sketch: a rank is off by n / ACCURACY at most
GRID = 1000           # sketch quantiles per scan
READ = 100_000        # values of a bracket that are read as they are


def column_quantiles(df: DataFrame, cols: dict, probs: list[float], grid: int = GRID, read: int = READ) -> dict:
    """{name: (count, mean, min, max, [quantiles])} of several numeric columns
    (name -> Column) at once; columns without a value are left out.

    The first scan gives the moments and a mergeable sketch of every column;
    two of its quantiles bracket each rank. Further scans count exactly what
    lies below and inside each bracket and either read its values, if they
    are few, or sketch it again, so brackets shrink by about ``grid`` a scan:
    two scans up to some 10^8 rows, three up to 10^11. Every scan is one
    aggregate without grouping, unpivoting or sorting of the table; a rank
    that the counts place outside its bracket is sought beside it."""
    names = list(cols)
    d = df.select(*[cols[c].cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    points = [k / grid for k in range(grid + 1)]

    def sketch(v):
        return F.percentile_approx(v, F.array(*[F.lit(p) for p in points]), F.lit(ACCURACY))

    r = d.agg(*[f(f"c{i}").alias(f"{k}{i}") for i in range(len(names))
                for k, f in (("n", F.count), ("a", F.avg), ("lo", F.min), ("hi", F.max), ("s", sketch))]).first()
    slack = 2 / ACCURACY

    def bracket(knots, share):
        """Sketch values (they occur in the column) around a share."""
        a, b = math.floor((share - slack) * grid), math.ceil((share + slack) * grid)
        return knots[max(a, 0)], knots[min(b, grid)]

    got: dict[tuple, float] = {}
    open_: dict[tuple, tuple] = {}   # (column, rank) -> (lo, hi, values expected, outer lo, outer hi)
    for i in range(len(names)):
        n, lo, hi = r[f"n{i}"], r[f"lo{i}"], r[f"hi{i}"]
        for k in {f((n - 1) * q) for q in probs for f in (math.floor, math.ceil)} if n else ():
            a, b = bracket(r[f"s{i}"], k / max(1, n - 1))
            open_[i, k] = (a, b, n * (1 / grid + 2 * slack), lo, hi)
    while open_:
        # Ranks that share a bracket share its counts.
        spans: dict[tuple, float] = {}
        for (i, _), (a, b, size, *_) in open_.items():
            spans[i, a, b] = max(size, spans.get((i, a, b), 0))
        keys = list(spans)
        aggs = []
        for t, (i, a, b) in enumerate(keys):
            v = F.col(f"c{i}")
            inside = F.when((v >= a) & (v <= b), v)
            aggs += [F.count(F.when(v < a, v)).alias(f"b{t}"), F.count(inside).alias(f"n{t}")]
            if a < b:
                aggs.append((F.sort_array(F.collect_list(inside)) if spans[keys[t]] <= read else sketch(inside)).alias(f"v{t}"))
        row = d.agg(*aggs).first()
        nxt = {}
        for (i, k), (a, b, _, low, high) in open_.items():
            t = keys.index((i, a, b))
            below, n = row[f"b{t}"], row[f"n{t}"]
            if k < below:
                end = math.nextafter(a, -math.inf)
                nxt[i, k] = (low, end, below, low, end)
            elif k >= below + n:
                start = math.nextafter(b, math.inf)
                nxt[i, k] = (start, high, r[f"n{i}"] - below - n, start, high)
            elif a == b:
                got[i, k] = a
            elif spans[i, a, b] <= read:
                got[i, k] = row[f"v{t}"][k - below]
            else:
                lo, hi = bracket(row[f"v{t}"], (k - below) / max(1, n - 1))
                # Few distinct values: the sketch may not shrink the bracket; then its least is tried alone.
                nxt[i, k] = (a, a, n, a, b) if (lo, hi) == (a, b) else (lo, hi, n * (1 / grid + 2 * slack), a, b)
        open_ = nxt
    out = {}
    for i, c in enumerate(names):
        n = r[f"n{i}"]
        if n:
            qs = []
            for q in probs:
                h = (n - 1) * q
                a, b = got[i, math.floor(h)], got[i, math.ceil(h)]
                qs.append(a + (h - math.floor(h)) * (b - a))
            out[c] = (n, r[f"a{i}"], r[f"lo{i}"], r[f"hi{i}"], qs)
    return out
