"""Geometry as plain columns.

A point is two DOUBLE columns ``x, y``. A polygon is a set of directed
edges ``(x1, y1, x2, y2)`` with shells counter-clockwise and holes
clockwise, either as rows (one per edge) or as an ``ARRAY<STRUCT<...>>``
column. With that orientation every measure below is a plain sum over
edges, so holes and multipart polygons need no special case.

Projections (G2) are closed-form Column expressions: EPSG:4326 <-> 5070
(CONUS Albers equal area, GRS80) and 4326 <-> 3857 (spherical Mercator).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed projection parameters (EPSG:5070 and EPSG:3857).
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
ALBERS_LAT1 = 29.5
ALBERS_LAT2 = 45.5
ALBERS_LAT0 = 23.0
ALBERS_LON0 = -96.0
MERCATOR_R = 6378137.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- projections

class _Albers:
    """Driver-side constants of the Albers equal-area conic (Snyder 1987)."""

    def __init__(self, a=GRS80_A, inv_f=GRS80_INV_F, lat1=ALBERS_LAT1, lat2=ALBERS_LAT2,
                 lat0=ALBERS_LAT0, lon0=ALBERS_LON0):
        f = 1.0 / inv_f
        self.a = a
        self.e2 = 2 * f - f * f
        self.e = math.sqrt(self.e2)
        self.lon0 = math.radians(lon0)

        def q(phi):
            s = math.sin(phi)
            es = self.e * s
            return (1 - self.e2) * (s / (1 - self.e2 * s * s)
                                    - math.log((1 - es) / (1 + es)) / (2 * self.e))

        def m(phi):
            s = math.sin(phi)
            return math.cos(phi) / math.sqrt(1 - self.e2 * s * s)

        p1, p2, p0 = map(math.radians, (lat1, lat2, lat0))
        m1, m2 = m(p1), m(p2)
        q1, q2, q0 = q(p1), q(p2), q(p0)
        self.n = (m1 * m1 - m2 * m2) / (q2 - q1)
        self.C = m1 * m1 + self.n * q1
        self.rho0 = a * math.sqrt(self.C - self.n * q0) / self.n
        self.qp = q(math.pi / 2)

    def q_col(self, phi: Column) -> Column:
        s = F.sin(phi)
        es = F.lit(self.e) * s
        return F.lit(1 - self.e2) * (s / (F.lit(1.0) - F.lit(self.e2) * s * s)
                                     - F.log((F.lit(1.0) - es) / (F.lit(1.0) + es)) / F.lit(2 * self.e))


ALBERS = _Albers()


def lonlat_to_albers(lon, lat) -> Column:
    """4326 -> 5070. Returns ``struct(x, y)`` in metres."""
    A = ALBERS
    phi = F.radians(_c(lat))
    theta = F.lit(A.n) * (F.radians(_c(lon)) - F.lit(A.lon0))
    rho = F.lit(A.a) * F.sqrt(F.lit(A.C) - F.lit(A.n) * A.q_col(phi)) / F.lit(A.n)
    return F.struct((rho * F.sin(theta)).alias("x"),
                    (F.lit(A.rho0) - rho * F.cos(theta)).alias("y"))


def albers_to_lonlat(x, y, iterations: int = 6) -> Column:
    """5070 -> 4326. Latitude by fixed-point iteration on q, run as
    ``aggregate`` over a short sequence so each step binds the previous
    latitude once (no exponential expression growth)."""
    A = ALBERS
    x, y = _c(x), _c(y)
    dy = F.lit(A.rho0) - y
    rho = F.sqrt(x * x + dy * dy)
    theta = F.atan2(x, dy) if A.n > 0 else F.atan2(-x, -dy)
    q = (F.lit(A.C) - (rho * rho * F.lit(A.n * A.n)) / F.lit(A.a * A.a)) / F.lit(A.n)
    e, e2 = A.e, A.e2

    def step(phi, _i):
        s = F.sin(phi)
        es = F.lit(e) * s
        one_m = F.lit(1.0) - F.lit(e2) * s * s
        return phi + (one_m * one_m) / (F.lit(2.0) * F.cos(phi)) * (
            q / F.lit(1 - e2) - s / one_m
            + F.log((F.lit(1.0) - es) / (F.lit(1.0) + es)) / F.lit(2 * e))

    phi = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), F.asin(q / F.lit(2.0)), step)
    lon = F.degrees(theta / F.lit(A.n) + F.lit(A.lon0))
    return F.struct(lon.alias("x"), F.degrees(phi).alias("y"))


def lonlat_to_mercator(lon, lat) -> Column:
    """4326 -> 3857."""
    R = F.lit(MERCATOR_R)
    return F.struct((R * F.radians(_c(lon))).alias("x"),
                    (R * F.log(F.tan(F.lit(math.pi / 4) + F.radians(_c(lat)) / F.lit(2.0)))).alias("y"))


def mercator_to_lonlat(x, y) -> Column:
    """3857 -> 4326."""
    R = F.lit(MERCATOR_R)
    return F.struct(F.degrees(_c(x) / R).alias("x"),
                    F.degrees(F.lit(2.0) * F.atan(F.exp(_c(y) / R)) - F.lit(math.pi / 2)).alias("y"))


PROJECTIONS = {
    (4326, 5070): lonlat_to_albers,
    (5070, 4326): albers_to_lonlat,
    (4326, 3857): lonlat_to_mercator,
    (3857, 4326): mercator_to_lonlat,
}


def transform_xy(x, y, src: int, dst: int) -> Column:
    """Reproject a point; identity when src == dst."""
    if src == dst:
        return F.struct(_c(x).alias("x"), _c(y).alias("y"))
    if (src, dst) in PROJECTIONS:
        return PROJECTIONS[(src, dst)](x, y)
    if (src, dst) in ((3857, 5070), (5070, 3857)):
        mid = transform_xy(x, y, src, 4326)
        return transform_xy(mid["x"], mid["y"], 4326, dst)
    raise ValueError(f"unsupported projection {src} -> {dst}")


# ------------------------------------------------------------ edge expressions
# Predicates over edges STRUCT<x1,y1,x2,y2>, alone or in arrays, as SQL text
# so they are usable in join conditions.

def seg_point_dist2_sql(e: str, x: str, y: str) -> str:
    """Squared distance from point (x, y) to segment e (struct x1,y1,x2,y2)."""
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    t = (f"greatest(0e0, least(1e0, coalesce((({x} - {e}.x1) * {dx} + ({y} - {e}.y1) * {dy}) "
         f"/ nullif({dx} * {dx} + {dy} * {dy}, 0e0), 0e0)))")
    px, py = f"({e}.x1 + {t} * {dx})", f"({e}.y1 + {t} * {dy})"
    return f"(({x} - {px}) * ({x} - {px}) + ({y} - {py}) * ({y} - {py}))"


def ensure_crs(df, x: str, y: str, epsg: int):
    """G1: the SRID travels as metadata on the ``x`` column. Absent -> set to
    ``epsg`` (no change of values); different -> reproject ``x, y`` in place."""
    cur = df.schema[x].metadata.get("srid")
    if cur is not None and int(cur) != epsg:
        p = transform_xy(x, y, int(cur), epsg)
        df = df.withColumn("_p", p).withColumn(x, F.col("_p.x")).withColumn(y, F.col("_p.y")).drop("_p")
    return df.withColumn(x, F.col(x).alias(x, metadata={"srid": epsg}))


def srid_of(df, x: str = "x"):
    v = df.schema[x].metadata.get("srid")
    return None if v is None else int(v)


# Point tests inside one grid cell. The path from the cell's lower left corner
# goes up the cell's left side x = X0 to the point's height and then right to
# the point; both legs stay in the cell, so only edges inside it are crossed.
# Edges are given upward (y1 <= y2) with a lean:
#   NaN  right of X0,
#   -1   crosses X0 and leans right (x1 < x2),
#   1    crosses X0 and leans left.
# The sign makes "crosses X0 below the bend" one comparison, false for NaN.
# Both legs' crossings are decided by one orientation, that of the path's
# bend, so an edge near the bend is never counted by one leg and missed by the
# other. Coordinates count as moved by an infinitesimal amount to the right
# and, by a larger one, up: that settles edges through the bend and vertices
# on the lines. A missing edge is all NaN: it is neither crossed nor touched.

def edge_lean(x1, x2, x0):
    """Lean of an upward edge (columns); null if it lies left of x0."""
    return (F.when((x1 > x0) & (x2 > x0), F.lit(float("nan"))).when((x1 <= x0) & (x2 <= x0), None)
            .when(x1 < x2, F.lit(-1.0)).otherwise(F.lit(1.0)))


def _side_sql(p: str, x: str, y: str) -> str:
    return f"(({p}x2 - {p}x1) * ({y} - {p}y1) - ({p}y2 - {p}y1) * ({x} - {p}x1))"


def below_sql(p: str, x0: str, y: str) -> str:
    """The edge with field prefix ``p`` crosses x = ``x0`` below ``y``."""
    return f"({p}k * {_side_sql(p, x0, y)} <= 0e0)"


def path_crossed_sql(p: str, x0: str, x: str, y: str) -> str:
    """The path to (``x``, ``y``) crosses the edge an odd number of times."""
    below = below_sql(p, x0, y)
    right = f"({p}y1 <= {y} AND {y} < {p}y2 AND {_side_sql(p, x, y)} < 0e0)"
    return f"({below} <> ({right} AND {below} = ({p}k < 0e0)))"


def on_edge_sql(p: str, x: str, y: str) -> str:
    return (f"({_side_sql(p, x, y)} = 0e0 AND {y} BETWEEN {p}y1 AND {p}y2 "
            f"AND {x} BETWEEN least({p}x1, {p}x2) AND greatest({p}x1, {p}x2))")


def point_in_cell_sql(edges: str, parity: str, x0: str, x: str, y: str, predicate: str = "within") -> str:
    """Point test against the edges of one cell (an array); ``parity``: that
    of the cell's corner, less the edges that cross x0 below it. ``within``:
    interior only; ``intersects``: interior or boundary."""
    n = f"size(filter({edges}, e -> {path_crossed_sql('e.', x0, x, y)}))"
    inside, on = f"(({parity} + {n}) % 2 = 1)", f"exists({edges}, e -> {on_edge_sql('e.', x, y)})"
    if predicate == "within":
        return f"({inside} AND NOT {on})"
    if predicate == "intersects":
        return f"({inside} OR {on})"
    raise ValueError(predicate)
