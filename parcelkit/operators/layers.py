"""Map-layer tables: the data half of the maps (V1-V7).

Rendering (HTML tiles, legends, PDF) is out of scope; these operators emit
the tables a renderer consumes: colour domains, per-row colours, display
text, quantile classes, density grids and boundary layers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import column_quantiles

# Fixed colour stops and no-data colours of the reference maps.
ORANGES = ["#fee8c8", "#fdbb84", "#e34a33"]
BLUES5 = ["#eff3ff", "#bdd7e7", "#6baed6", "#3182bd", "#08519c"]
AGE_BLUES = ["#f7fbff", "#6baed6", "#08306b"]
NODATA_FILL = "#bdbdbd"
NODATA_STROKE = "#969696"
BYTE_SCALE = 255.9999   # float channel -> byte, truncated


def colour_domain(df: DataFrame, value_col: str, rule: str = "plain") -> tuple[float, float]:
    """V1: (vmin, vmax) = 5th / 95th percentile (linear); if equal, min / max.
    ``rule='age'`` also falls back on non-finite bounds and widens an empty
    range to (v, v + 1). Two numbers reach the driver; no task holds the
    column."""
    v = df.select(F.nanvl(F.col(value_col).cast("double"), F.lit(None)).alias("v"))
    _, _, mn, mx, (lo, hi) = column_quantiles(v, {"v": F.col("v")}, [0.05, 0.95]).get(
        "v", (0, None, None, None, (float("nan"), float("nan"))))
    if rule == "age":
        if not (math.isfinite(lo) and math.isfinite(hi)) or lo == hi:
            lo, hi = mn or 0.0, mx or 1.0
            if lo == hi:
                hi = lo + 1
    elif lo == hi:
        lo, hi = mn, mx
    return float(lo), float(hi)


def _rgb(hexstr: str) -> tuple[float, float, float]:
    h = hexstr.lstrip("#")
    return tuple(int(h[i:i + 2], 16) / 255.0 for i in (0, 2, 4))


def linear_colour(value: Column, stops: list[str], vmin: float, vmax: float, nodata: str = NODATA_FILL) -> Column:
    """V2: linear colour over equally spaced stops on [vmin, vmax], clamped at
    both ends; null/NaN -> ``nodata``. Returns ``#rrggbb``."""
    cols = [_rgb(s) for s in stops]
    n = len(cols)
    idx = [vmin + (vmax - vmin) * i / (n - 1) for i in range(n)]
    x = value.cast("double")

    def channel(j: int) -> Column:
        expr = F.when(x <= F.lit(idx[0]), F.lit(cols[0][j]))
        for i in range(1, n):
            if idx[i - 1] < idx[i]:
                p = (x - F.lit(idx[i - 1])) / F.lit(idx[i] - idx[i - 1])
            else:
                p = F.lit(1.0)
            seg = (F.lit(1.0) - p) * F.lit(cols[i - 1][j]) + p * F.lit(cols[i][j])
            expr = expr.when(x < F.lit(idx[i]), seg)
        expr = expr.otherwise(F.lit(cols[-1][j]))
        return F.lower(F.lpad(F.hex(F.floor(expr * F.lit(BYTE_SCALE))), 2, "0"))

    hexcol = F.concat(F.lit("#"), channel(0), channel(1), channel(2))
    return F.when(x.isNull() | F.isnan(x), F.lit(nodata)).otherwise(hexcol)


def percent_text(value: Column, scale_100: bool, missing: str = "No data") -> Column:
    """One-decimal percent text (x100 when values are proportions)."""
    v = value.cast("double") * (100.0 if scale_100 else 1.0)
    r = F.rint(v * 10.0) / 10.0
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(missing)).otherwise(
        F.concat(r.cast("string"), F.lit("%")))


def quantile_bins(df: DataFrame, value_col: str, k: int = 5) -> list[float]:
    """V5 bin edges: the i/k quantiles (linear), i = 1..k."""
    return quantiles(df, value_col, [i / k for i in range(1, k + 1)])


def quantiles(df: DataFrame, value_col: str, probs: list[float]) -> list[float]:
    """Exact quantiles (linear) of a column; no task holds the column."""
    return list(column_quantiles(df, {"v": F.col(value_col)}, probs)["v"][4])


def quantile_class(value: Column, bins: list[float]) -> Column:
    """Right-closed classes: the first bin edge >= value."""
    expr = None
    for i, b in enumerate(bins):
        expr = F.when(value <= F.lit(b), F.lit(i)) if expr is None else expr.when(value <= F.lit(b), F.lit(i))
    return expr.otherwise(F.lit(len(bins) - 1))


def point_density(points: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """V4: ``x, y, weight``: points counted per square cell (partial
    aggregation map-side), at the cell's centre."""
    c = F.lit(float(cell))
    g = points.groupBy(F.floor(F.col(x) / c).alias("_gx"), F.floor(F.col(y) / c).alias("_gy")).agg(
        F.count(F.lit(1)).alias("weight"))
    return g.select(((F.col("_gx") + 0.5) * c).alias("x"), ((F.col("_gy") + 0.5) * c).alias("y"), "weight")


def point_layer(points: DataFrame, x: str = "x", y: str = "y", label_cols: list[str] = ()) -> DataFrame:
    """V4: ``x, y, label``: every point with its display text. Whether a map
    shows points or their density is the caller's choice (O5)."""
    lab = F.concat_ws("; ", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None")))
                              for c in label_cols]) if label_cols else F.lit(None).cast("string")
    return points.select(F.col(x).alias("x"), F.col(y).alias("y"), lab.alias("label"))


def ring_geojson(vertices: DataFrame, gid: str = "gid", ord_col: str = "k", decimals: int = 3) -> DataFrame:
    """K3 helper: one GeoJSON Polygon string per single-ring polygon, vertices
    in ring order, closed, fixed decimals. The vertex list of one polygon is
    that polygon's own geometry value."""
    fmt = f"%.{decimals}f"
    pt = F.format_string(f"[{fmt},{fmt}]", F.col("x"), F.col("y"))
    g = vertices.groupBy(gid).agg(F.sort_array(F.collect_list(F.struct(F.col(ord_col).alias("o"), pt.alias("p")))).alias("v"))
    pts = F.transform("v", lambda s: s["p"])
    ring = F.concat(F.array_join(pts, ","), F.lit(","), F.element_at(pts, 1))
    return g.select(gid, F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}")).alias("geojson"))
