"""Polygon layers as edge rows.

Input is a vertex table ``(gid, part, role, ord, x, y)`` - one row per ring
vertex, ``role`` 'shell' or 'hole', ring order by ``ord``; an optional
``ring`` column numbers several holes of one part. Rings may be given
closed or open, in either direction, with repeated vertices.

All work is row-wise with windows partitioned by ring, so no polygon is
ever collected into one value; the edge table is the canonical form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EDGE_COLS = ["x1", "y1", "x2", "y2"]


def vertices_from_nodes(nodes: DataFrame, gid="gid", ord_col="k") -> DataFrame:
    """Single-ring polygons given as ``(gid, k, x, y)`` -> vertex table."""
    return nodes.select(F.col(gid).alias("gid"), F.lit(0).alias("part"), F.lit("shell").alias("role"),
                        F.col(ord_col).alias("ord"), "x", "y")


def _ring_keys(v: DataFrame) -> list[str]:
    keys = ["gid", "part", "role"]
    if "ring" in v.columns:
        keys.append("ring")
    return keys


def edges_from_vertices(v: DataFrame) -> DataFrame:
    """G3 ring cleaning + orientation: returns ``(gid, x1, y1, x2, y2)`` with
    shells counter-clockwise and holes clockwise; zero-length edges (closing
    duplicates, repeated vertices) dropped."""
    keys = _ring_keys(v)
    w = Window.partitionBy(*keys).orderBy("ord")
    wr = Window.partitionBy(*keys)
    e = (v.withColumn("x2", F.coalesce(F.lead("x").over(w), F.first("x").over(w.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))))
          .withColumn("y2", F.coalesce(F.lead("y").over(w), F.first("y").over(w.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))))
          .withColumnRenamed("x", "x1").withColumnRenamed("y", "y1")
          .filter(~((F.col("x1") == F.col("x2")) & (F.col("y1") == F.col("y2")))))
    # signed (doubled) ring area around a ring-local origin, for the direction test
    e = e.withColumn("_ox", F.min("x1").over(wr)).withColumn("_oy", F.min("y1").over(wr))
    cross = ((F.col("x1") - F.col("_ox")) * (F.col("y2") - F.col("_oy"))
             - (F.col("x2") - F.col("_ox")) * (F.col("y1") - F.col("_oy")))
    e = e.withColumn("_sa", F.sum(cross).over(wr))
    flip = ((F.col("role") == "shell") & (F.col("_sa") < 0)) | ((F.col("role") == "hole") & (F.col("_sa") > 0))
    return e.select(
        "gid",
        F.when(flip, F.col("x2")).otherwise(F.col("x1")).alias("x1"),
        F.when(flip, F.col("y2")).otherwise(F.col("y1")).alias("y1"),
        F.when(flip, F.col("x1")).otherwise(F.col("x2")).alias("x2"),
        F.when(flip, F.col("y1")).otherwise(F.col("y2")).alias("y2"),
    )


def polygon_measures(edges: DataFrame) -> DataFrame:
    """G4, G6, G10 per polygon: ``gid, xmin, ymin, xmax, ymax, area, cx, cy``.

    Area and centroid are shoelace sums over the oriented edges around the
    polygon's lower-left bbox corner (large projected coordinates would
    otherwise cancel). Partial sums combine map-side (one shuffle by gid).
    """
    g = edges.groupBy("gid").agg(
        F.least(F.min("x1"), F.min("x2")).alias("xmin"), F.least(F.min("y1"), F.min("y2")).alias("ymin"),
        F.greatest(F.max("x1"), F.max("x2")).alias("xmax"), F.greatest(F.max("y1"), F.max("y2")).alias("ymax"))
    j = edges.join(g, "gid")
    ax1, ay1 = F.col("x1") - F.col("xmin"), F.col("y1") - F.col("ymin")
    ax2, ay2 = F.col("x2") - F.col("xmin"), F.col("y2") - F.col("ymin")
    cr = ax1 * ay2 - ax2 * ay1
    m = j.groupBy("gid", "xmin", "ymin", "xmax", "ymax").agg(
        (F.sum(cr) / 2).alias("area"),
        F.sum((ax1 + ax2) * cr).alias("_sx"), F.sum((ay1 + ay2) * cr).alias("_sy"))
    return m.select(
        "gid", "xmin", "ymin", "xmax", "ymax", "area",
        (F.col("xmin") + F.col("_sx") / (6 * F.nullif(F.col("area"), F.lit(0.0)))).alias("cx"),
        (F.col("ymin") + F.col("_sy") / (6 * F.nullif(F.col("area"), F.lit(0.0)))).alias("cy"))


def polygon_edge_arrays(edges: DataFrame) -> DataFrame:
    """``gid, edges ARRAY<STRUCT<x1,y1,x2,y2>>`` (one row per polygon)."""
    return edges.groupBy("gid").agg(F.collect_list(F.struct(*EDGE_COLS)).alias("edges"))


def invalid_rings(v: DataFrame, cell: float) -> DataFrame:
    """G3 report: rings with properly crossing edges (self-crossing).

    Candidate edge pairs come from an equi-join on (ring, grid cell) over the
    cells each edge's bbox covers; a pair is kept only in the cell holding the
    lower-left corner of the two bboxes' overlap, so no pair repeats and no
    ring is compared all-against-all.
    """
    keys = _ring_keys(v)
    w = Window.partitionBy(*keys).orderBy("ord")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    c = F.lit(float(cell))
    e = (v.withColumn("i", F.row_number().over(w))
          .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
          .withColumn("x2", F.coalesce(F.lead("x").over(w), F.first("x").over(full)))
          .withColumn("y2", F.coalesce(F.lead("y").over(w), F.first("y").over(full)))
          .select(*keys, "i", "n", F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2"))
    e = (e.withColumn("bx0", F.least("x1", "x2")).withColumn("by0", F.least("y1", "y2"))
          .withColumn("bx1", F.greatest("x1", "x2")).withColumn("by1", F.greatest("y1", "y2"))
          .withColumn("gx", F.explode(F.sequence(F.floor(F.col("bx0") / c), F.floor(F.col("bx1") / c))))
          .withColumn("gy", F.explode(F.sequence(F.floor(F.col("by0") / c), F.floor(F.col("by1") / c)))))
    a, b = e.alias("a"), e.alias("b")
    cond = ([F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
            + [F.col("a.gx") == F.col("b.gx"), F.col("a.gy") == F.col("b.gy"), F.col("a.i") + 1 < F.col("b.i")])

    def orient(px, py, qx, qy, rx, ry):
        return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))

    A1x, A1y, A2x, A2y = (F.col(f"a.{k}") for k in EDGE_COLS)
    B1x, B1y, B2x, B2y = (F.col(f"b.{k}") for k in EDGE_COLS)
    proper = ((orient(A1x, A1y, A2x, A2y, B1x, B1y) * orient(A1x, A1y, A2x, A2y, B2x, B2y) < 0)
              & (orient(B1x, B1y, B2x, B2y, A1x, A1y) * orient(B1x, B1y, B2x, B2y, A2x, A2y) < 0))
    not_wrap = ~((F.col("a.i") == 1) & (F.col("b.i") == F.col("a.n")))
    home = ((F.col("a.gx") == F.floor(F.greatest("a.bx0", "b.bx0") / c))
            & (F.col("a.gy") == F.floor(F.greatest("a.by0", "b.by0") / c)))
    pairs = a.join(b, cond).filter(home & proper & not_wrap)
    return pairs.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n_crossings"))
