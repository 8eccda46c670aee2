"""Size checks for broadcast decisions and grid-cell sizing.

A side is broadcast only after a one-row aggregate proves its size is
under a limit; otherwise the join stays a shuffle join and AQE may still
convert it at runtime from real shuffle statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024   # bytes
ROW_OVERHEAD = 64                           # bytes per row, conservative
EDGE_BYTES = 40                             # one STRUCT<x1,y1,x2,y2> entry


def estimate_bytes(df: DataFrame, array_cols=None, string_cols=None) -> int:
    """Upper-bound estimate of ``df``'s in-memory size from one aggregate:
    fixed-width columns by type width, strings and binaries by their summed
    lengths, arrays by their summed sizes (all measured, not assumed)."""
    fields = df.schema.fields
    if string_cols is None:
        string_cols = [f.name for f in fields if f.dataType.typeName() in ("string", "binary")]
    if array_cols is None:
        array_cols = [f.name for f in fields if f.dataType.typeName() == "array"]
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in array_cols:
        aggs.append(F.coalesce(F.sum(F.size(c)), F.lit(0)).alias(f"a_{c}"))
    for c in string_cols:
        aggs.append(F.coalesce(F.sum(F.length(c)), F.lit(0)).alias(f"s_{c}"))
    r = df.agg(*aggs).first()
    n = r["n"]
    fixed = sum(8 for f in df.schema.fields if f.name not in array_cols and f.name not in string_cols)
    total = n * (ROW_OVERHEAD + fixed)
    for c in array_cols:
        total += r[f"a_{c}"] * EDGE_BYTES
    for c in string_cols:
        total += r[f"s_{c}"] * 2 + n * 8
    return int(total)


def broadcast_if_bounded(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT,
                         array_cols=None, string_cols=None) -> DataFrame:
    """``broadcast(df)`` when its measured size is under ``limit``, else ``df``."""
    if limit <= 0:
        return df
    size = estimate_bytes(df, array_cols, string_cols)
    return F.broadcast(df) if size <= limit else df


def default_cell_size(measures: DataFrame, factor: float = 1.0) -> float:
    """Median polygon bbox side (one aggregate over the polygon layer)."""
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    v = measures.agg(F.percentile_approx(side, 0.5).alias("m")).first()["m"]
    if v is None or not v > 0:
        return 1.0
    return float(v) * factor


def col_or_lit(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


TARGET_CELLS = 1 << 18      # polygon-cell rows aimed for by the PIP grid
MAX_CELLS_PER_SIDE = 32     # at most this many boundary cells along a polygon
MIN_CELLS_PER_SIDE = 4


def cells_per_side(n_polygons: int) -> float:
    """Boundary cells along a polygon's longer side in point-in-polygon
    joins: many, so that most points fall into cells wholly inside or outside
    a polygon (no exact test needed), as far as the polygon-cell table stays
    near ``TARGET_CELLS`` rows."""
    return max(MIN_CELLS_PER_SIDE, min(MAX_CELLS_PER_SIDE, (TARGET_CELLS / max(1, n_polygons)) ** 0.5))
