"""Grouped summaries, profiles, sorts and sampling.

Each operator is one ``groupBy().agg()`` with conditional aggregates
(partial aggregation happens map-side, so a hot group costs one row per
map task in the shuffle), or a window over a one-row global aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as X


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


# ------------------------------------------------------------- A7, A8, A9

def lead_by_group(df: DataFrame, group_col: str, status: Column, year: Column | None,
                  cur_year: int, out_group: str | None = None) -> DataFrame:
    """A7 status cross-tab (Lead / Non-Lead / Unknown, zero-filled, null key
    dropped) + A8 totals and rates + A9 year stats over years in
    [1800, cur_year] (null when a group has no valid year)."""
    out_group = out_group or group_col
    s = status
    aggs = [_count_if(s == X.LEAD).alias(X.LEAD),
            _count_if(s == X.NON_LEAD).alias(X.NON_LEAD),
            _count_if(s == X.UNKNOWN).alias(X.UNKNOWN)]
    if year is not None:
        yv = F.when(X.year_valid(year, cur_year, "a"), year)
        aggs += [F.avg(yv).alias("avg_year_built"), F.count(yv).alias("_ny")]
    g = df.filter(F.col(group_col).isNotNull()).groupBy(F.col(group_col).alias(out_group)).agg(*aggs)
    lead, non, unk = F.col(f"`{X.LEAD}`"), F.col(f"`{X.NON_LEAD}`"), F.col(f"`{X.UNKNOWN}`")
    g = (g.withColumn("total_points", lead + non + unk)
          .withColumn("known_points", lead + non))
    tot, known = F.col("total_points"), F.col("known_points")
    g = (g.withColumn("pct_lead_total", X.safe_ratio(lead, tot))
          .withColumn("pct_nonlead_total", X.safe_ratio(non, tot))
          .withColumn("pct_unknown", X.safe_ratio(unk, tot))
          .withColumn("pct_lead_known", X.safe_ratio(lead, known))
          .withColumn("pct_nonlead_known", X.safe_ratio(non, known)))
    if year is not None:
        g = (g.withColumn("count_year_samples", F.nullif(F.col("_ny"), F.lit(0)))
              .withColumn("avg_house_age", F.lit(float(cur_year)) - F.col("avg_year_built"))
              .drop("_ny"))
    return g


def rename_earlier_summary(df: DataFrame) -> DataFrame:
    """The earlier column names of the same lead summary."""
    m = {"pct_lead_known": "pct_known_lead", "pct_nonlead_known": "pct_known_nonlead",
         "pct_lead_total": "pct_known_lead_total", "pct_nonlead_total": "pct_known_nonlead_total"}
    cols = [F.col(f"`{c}`").alias(m.get(c, c)) for c in df.columns
            if c not in ("avg_year_built", "count_year_samples", "avg_house_age")]
    return df.select(*cols)


# ------------------------------------------------------------------ A12

IMPUTED_SIDES = ("bothsides", "custmaterial", "utilmaterial")


def imputed_summary(df: DataFrame, group_col: str, cats: dict[str, Column]) -> DataFrame:
    """Per group total, and count + percent (1 decimal, half-even) of
    Lead/GRR and Non-Lead for each imputed column, 0-filled. ``cats`` maps
    side name -> imputed category column."""
    aggs = [F.count(F.lit(1)).alias("total_count")]
    for side, col in cats.items():
        aggs.append(_count_if(col == X.LEAD_GRR).alias(f"lead_count_{side}_imputed"))
        aggs.append(_count_if(col == X.NON_LEAD).alias(f"non_lead_count_{side}_imputed"))
    g = df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(*aggs)
    for side in cats:
        for kind in ("lead", "non_lead"):
            n = F.col(f"{kind}_count_{side}_imputed")
            g = g.withColumn(f"{kind}_percent_{side}_imputed",
                             X.round_half_even(n / F.col("total_count") * 100.0, 1))
    return g


# ------------------------------------------------------------- A13-A15

def value_counts_pct(df: DataFrame, col: str, decimals: int = 1) -> DataFrame:
    """``value, count, percent`` (percent of all rows, half-even),
    nulls counted as their own value."""
    g = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    tot = F.sum("count").over(Window.partitionBy())
    return g.withColumn("percent", X.round_half_even(F.col("count") / tot * 100.0, decimals))


def grouped_min_max_mean(df: DataFrame, group_col: str, cols: list[str]) -> DataFrame:
    """``min, max, mean`` of each column per group (columns flattened
    ``<col>_min`` ...); null group kept out as pandas groupby does."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_mean")]
    return df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(*aggs)


def top_k(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """O2: the k largest non-null values (``TakeOrderedAndProject``)."""
    return df.filter(F.col(col).isNotNull()).select(col).orderBy(F.col(col).desc()).limit(k)


# ------------------------------------------------------------ A10, A11

def mean_count_by(df: DataFrame, group_col: str, value: Column, mean_name: str, count_name: str) -> DataFrame:
    """``avg`` and ``count`` of a value per non-null group."""
    return (df.filter(F.col(group_col).isNotNull() & value.isNotNull())
              .groupBy(group_col).agg(F.avg(value).alias(mean_name), F.count(value).alias(count_name)))


# ------------------------------------------------------------ A16, A17

def numeric_profile(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """Long-format profile ``variable, count, mean, median, min, p10, p90,
    max`` per numeric column; columns with no value are skipped. One scan for
    the moments and a few for exact order statistics; ``approximate`` takes
    all from one scan with a quantile sketch."""
    from .quantiles import column_quantiles
    probs = [0.5, 0.1, 0.9]
    values = {c: X.to_double(c) for c in cols}
    if approximate:
        r = df.select(*[v.alias(c) for c, v in values.items()]).agg(*[F.struct(
            F.count(f"`{c}`"), F.avg(f"`{c}`"), F.min(f"`{c}`"), F.max(f"`{c}`"),
            F.percentile_approx(f"`{c}`", probs, 10_000)).alias(c) for c in cols]).first()
        found = {c: tuple(r[c]) for c in cols if r[c][0]}
    else:
        found = column_quantiles(df, values, probs)
    rows = [(c, n, mean, q[0], lo, q[1], q[2], hi) for c, (n, mean, lo, hi, q) in found.items()]
    return df.sparkSession.createDataFrame(
        rows, "variable string, count long, mean double, median double, min double, p10 double, p90 double, max double")


def categorical_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """``variable, category, count, percent`` (share 0-1 of all rows);
    missing shown as ``<NA>``."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.coalesce(F.col(c).cast("string"), F.lit("<NA>")).alias("category"))
        for c in cols])).alias("r")).select("r.variable", "r.category")
    g = long.groupBy("variable", "category").agg(F.count(F.lit(1)).alias("count"))
    # one row per variable (a column name), joined back; no window gathers
    # the distinct values of a variable
    tot = g.groupBy("variable").agg(F.sum("count").alias("_n"))
    return g.join(F.broadcast(tot), "variable").withColumn("percent", F.col("count") / F.col("_n")).drop("_n")


# ------------------------------------------------------------------ A18

# Fixed year-built bin labels and their upper bounds (inclusive).
YEAR_BINS = [("≤1919", 1919), ("1920–1939", 1939), ("1940s", 1949), ("1950s", 1959),
             ("1960s", 1969), ("1970s", 1979), ("1980s", 1989), ("1990s", 1999),
             ("2000–2007", 2007), ("2008+", None)]


def year_bin(y: Column) -> Column:
    chain = None
    for label, hi in YEAR_BINS:
        if hi is None:
            chain = chain.otherwise(F.lit(label))
        else:
            chain = F.when(y <= hi, F.lit(label)) if chain is None else chain.when(y <= hi, F.lit(label))
    return F.when(y.isNull(), F.lit(None).cast("string")).otherwise(chain)


def year_bins(df: DataFrame, year: Column, status: Column) -> DataFrame:
    """Per bin ``count`` (known points), ``lead_rate_known``, ``unknown_rate``."""
    g = (df.withColumn("year_bin", year_bin(year)).filter(F.col("year_bin").isNotNull())
           .groupBy("year_bin").agg(
               _count_if(status == X.LEAD).alias("_l"), _count_if(status == X.NON_LEAD).alias("_n"),
               _count_if(status == X.UNKNOWN).alias("_u")))
    known = F.col("_l") + F.col("_n")
    tot = known + F.col("_u")
    return g.select("year_bin", known.alias("count"),
                    X.safe_ratio(F.col("_l"), known).alias("lead_rate_known"),
                    X.safe_ratio(F.col("_u"), tot).alias("unknown_rate"))


# ------------------------------------------------------------------ A20

def column_facts(df: DataFrame, col: str) -> DataFrame:
    """Existence, distinct and null counts over a column in one pass."""
    return df.agg(F.bool_or(F.col(col).isNotNull()).alias("any_value"),
                  F.count_distinct(col).alias("n_distinct"),
                  _count_if(F.col(col).isNull()).alias("n_null"),
                  F.count(col).alias("n_notnull"))


# ------------------------------------------------------------------ O4

# Hash ranges that one pass counts, and rows of the crossing range that are ranked.
SAMPLE_RANGES = 4096


def _least_by_hash(df: DataFrame, h: Column, key: str, n: int, low: int, high: int) -> DataFrame:
    """The ``n`` rows of least ``h`` (low <= h < high), ties by key. Counts
    per hash range narrow the range that holds the n-th row (3 passes over the
    key at 10^11 rows); lesser hashes pass by a filter, and only the rows of
    the crossing range are ranked. Where one hash alone holds more rows than
    that (copies of one key), n rows of each task at most are compared."""
    rows, cols, taken = df.withColumn("_h", h), df.columns, 0
    while True:
        width = -(-(high - low) // SAMPLE_RANGES)
        here = rows.where(F.col("_h").between(low, high - 1))
        counts = here.groupBy(F.expr(f"(_h - {low}L) div {width}L").alias("r")).agg(F.count(F.lit(1)).alias("m"))
        crossing = None
        for r in sorted(counts.collect()):
            if taken + r["m"] > n:
                crossing = r
                break
            taken += r["m"]
        if crossing is None:
            return df
        low, high = low + crossing["r"] * width, min(high, low + (crossing["r"] + 1) * width)
        if crossing["m"] <= SAMPLE_RANGES or high - low == 1:
            break
    edge = rows.where(F.col("_h").between(low, high - 1))
    if crossing["m"] <= SAMPLE_RANGES:
        edge = edge.withColumn("_k", F.row_number().over(Window.orderBy("_h", key))).where(F.col("_k") <= n - taken)
    else:
        edge = edge.orderBy(key).limit(n - taken)
    return rows.where(F.col("_h") < low).select(*cols).unionAll(edge.select(*cols))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, without replacement, chosen by a
    seeded hash of the key (deterministic)."""
    return _least_by_hash(df, F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 2), key, n, 0, 1 << 62)


def value_counts_by_variable(long: DataFrame, decimals: int = 1) -> DataFrame:
    """A13 over several columns at once: ``long`` has ``variable, value``;
    returns ``variable, value, count, percent`` (percent of all rows)."""
    g = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("count"))
    # one row per variable (a column name), joined back; no window gathers
    # the distinct values of a variable
    tot = long.groupBy("variable").agg(F.count(F.lit(1)).alias("_n"))
    return g.join(F.broadcast(tot), "variable").withColumn(
        "percent", X.round_half_even(F.col("count") / F.col("_n") * 100.0, decimals)).drop("_n")


def arith_hash_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """O4 with a portable arithmetic hash of an integer key (reproducible in
    any SQL engine): ``(key * 7919 + seed * 104729) mod 1000003``, ties by key."""
    h = (F.col(key) * F.lit(7919) + F.lit(seed * 104729)) % F.lit(1000003)
    return _least_by_hash(df, F.coalesce(h, F.lit(-1000003)), key, n, -1000003, 1000003)


def first_by_position(df: DataFrame, key: str, position: str, cols: list[str]) -> DataFrame:
    """Per key, the row with the smallest position (keep-first dedup).
    ``min_by`` is a partial aggregate, so a hot key costs one row per task."""
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(position))
    return df.groupBy(key).agg(best.alias("_b"), F.min(position).alias(position)).select(
        key, *[F.col(f"_b.{c}").alias(c) for c in cols], position)
