"""Spatial joins as equi-joins on grid cells.

Catalyst only sees equi-joins on integer cell keys ``(cx, cy)`` plus a
residual exact test, so the point side is never replicated or compared
against the whole polygon layer:

* J1/J2 point in polygon: nested cells, divided where polygons are small, so
  each point lies in exactly one undivided cell. Each polygon contributes one
  row per such cell that it fills or that its boundary touches; a boundary
  row carries the edges inside the cell and the parity of the cell's corner.
  The crossing-parity and boundary tests run over those few edges, along a
  path inside the cell, as the join's residual condition.
* J3 overlay: candidate polygon pairs from cell equi-joins of the two box
  layers on the grid that fits the larger box (a pair is kept only in the
  cell holding the lower-left corner of the two boxes' overlap - no
  ``distinct``), then edge pairs from an
  equi-join on (pair, x-slab) with the same home-slab rule, and the exact
  intersection area as a sum of signed trapezoid integrals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geom import below_sql, edge_lean, point_in_cell_sql, seg_point_dist2_sql
from ..session import materialize
from .polygons import EDGE_COLS, polygon_measures
from .sizing import DEFAULT_BROADCAST_LIMIT, EDGE_BYTES, ROW_OVERHEAD, broadcast_if_bounded, cells_per_side, default_cell_size

CELL_EDGES = 4   # edges aimed for in a boundary cell of a polygon with very many


# ----------------------------------------------------------------- J1 / J2

FAN = 4          # a cell divides into FAN x FAN cells of the next level
MAX_LEVEL = 16
MARGIN = 1e-6    # of a cell: edges this near count as touching it
FAN_OUT = 2.0    # entries a cell, from which the points are spread over all cores first
TASKS_PER_CORE = 8


@dataclass(frozen=True)
class Grid:
    """Nested cells: level s has cells of size ``size / FAN**s``. The origin
    lies off the data by an irrational share of a cell, so that cell sides do
    not fall on coordinates that data share (integers, say)."""
    ox: float
    oy: float
    size: float
    levels: int     # finest level in use
    nx: float       # extent in cells of level 0
    ny: float

    def units(self, x, y, level=0):
        """Column expressions of x, y in cells of a level (a number or column)."""
        k = F.pow(F.lit(float(FAN)), level) if isinstance(level, Column) else F.lit(float(FAN ** level))
        return (x - F.lit(self.ox)) / F.lit(self.size) * k, (y - F.lit(self.oy)) / F.lit(self.size) * k


def _level_table(edges: DataFrame, measures: DataFrame, cell: float | None) -> tuple[DataFrame, Grid]:
    """``gid, _t`` (the level of each polygon's boundary cells) and the grid.

    A polygon's boundary cells follow its own size and its number of edges,
    not the layer's: about ``fine`` of them lie along its longer side (half
    to twice as many, as levels go by factors of FAN). Level 0 is
    where the largest boundary cells need one division, and no finer than a
    sixteenth of the largest polygon, so every polygon covers a bounded number
    of its cells. Two one-row aggregates over the polygon layer."""
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    m = measures.join(edges.groupBy("gid").agg(F.count(F.lit(1)).alias("_n")), "gid").withColumn("_side", side)
    r = m.agg(F.count(F.lit(1)).alias("n"), F.max("_side").alias("s"), F.min("xmin").alias("x0"), F.min("ymin").alias("y0"),
              F.max("xmax").alias("x1"), F.max("ymax").alias("y1")).first()
    if not r["n"] or not r["s"] or r["s"] <= 0:
        return m.select("gid", F.lit(1).alias("_t")), Grid(0.0, 0.0, 1.0, 1, 0.0, 0.0)
    if cell:
        want, top, least = F.lit(float(cell)), float(cell), float(cell)
    else:
        fine = F.greatest(F.lit(float(cells_per_side(r["n"]))), F.col("_n") / F.lit(float(4 * CELL_EDGES)))
        want = F.when(F.col("_side") > 0, F.col("_side") / fine)
        w = m.agg(F.max(want).alias("hi"), F.min(want).alias("lo")).first()
        top, least = w["hi"], w["lo"]
    size = max(FAN * top, 0.0 if cell else r["s"] / 16)
    levels = min(MAX_LEVEL, max(1, round(math.log(size / least, FAN))))
    t = F.round(F.log(F.lit(float(size)) / want) / F.lit(math.log(FAN)))
    lv = m.select("gid", F.least(F.lit(levels), F.greatest(F.lit(1), F.coalesce(t, F.lit(1)))).cast("int").alias("_t"))
    ox, oy = r["x0"] - size * (3 - 5 ** 0.5) / 2, r["y0"] - size * (2 ** 0.5 - 1)
    return lv, Grid(ox, oy, size, levels, (r["x1"] - ox) / size + 1, (r["y1"] - oy) / size + 1)


def _span(lo, hi):
    return F.explode(F.sequence(F.floor(lo).cast("long"), F.floor(hi).cast("long")))


def _up(col, by):
    """A cell number some levels up (``by`` levels: a column)."""
    return F.floor(F.col(col) / F.pow(F.lit(float(FAN)), by)).cast("long")


def _children(df: DataFrame, level) -> DataFrame:
    kids = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(FAN) for j in range(FAN)])
    return (df.withColumn("_k", F.explode(kids)).withColumn("_lv", (level + 1).cast("int"))
            .withColumn("_cx", F.col("_cx") * FAN + F.col("_k.i")).withColumn("_cy", F.col("_cy") * FAN + F.col("_k.j"))
            .drop("_k"))


_CELL = ["_gid", "_lv", "_cx", "_cy"]


def boundary_cells(edges: DataFrame, levels: DataFrame, grid: Grid) -> DataFrame:
    """``_gid, _lv, _cx, _cy, _edges``: the cells of a polygon's own level
    that its edges touch, each with just those edges. An edge goes through
    its columns, and in each through the rows it meets there: its cells grow
    with its length."""
    e = edges.join(levels, "gid")
    (a1, b1), (a2, b2) = (grid.units(F.col(f"x{i}"), F.col(f"y{i}"), F.col("_t")) for i in (1, 2))
    e = e.withColumn("_a1", a1).withColumn("_b1", b1).withColumn("_a2", a2).withColumn("_b2", b2)
    m = F.lit(MARGIN)
    lo, hi = F.least("_a1", "_a2"), F.greatest("_a1", "_a2")
    e = e.withColumn("_cx", _span(lo - m, hi + m))
    slope = (F.col("_b2") - F.col("_b1")) / F.nullif(F.col("_a2") - F.col("_a1"), F.lit(0.0))

    def at(x):
        y = F.col("_b1") + (x - F.col("_a1")) * slope
        return F.least(F.greatest(y, F.least("_b1", "_b2")), F.greatest("_b1", "_b2"))

    p, q = at(F.greatest(lo, F.col("_cx") - m)), at(F.least(hi, F.col("_cx") + 1 + m))
    upright = F.col("_a1") == F.col("_a2")
    e = (e.withColumn("_p", F.when(upright, F.col("_b1")).otherwise(p)).withColumn("_q", F.when(upright, F.col("_b2")).otherwise(q))
          .withColumn("_cy", _span(F.least("_p", "_q") - m, F.greatest("_p", "_q") + m)))
    return e.groupBy(F.col("gid").alias("_gid"), F.col("_t").alias("_lv"), "_cx", "_cy").agg(
        F.collect_list(F.struct(*EDGE_COLS)).alias("_edges"))


def _corner_parity(cells: DataFrame, edges: DataFrame, levels: DataFrame, grid: Grid) -> DataFrame:
    """``cells`` with ``_par``: whether their lower left corner lies inside
    their polygon. Along a row's lower line the polygon's crossings are
    counted from the left: one window per polygon, level and row."""
    e = edges.join(levels, "gid").withColumn("_lv", F.explode(F.sequence(F.lit(0), F.col("_t"))))
    (a1, b1), (a2, b2) = (grid.units(F.col(f"x{i}"), F.col(f"y{i}"), F.col("_lv")) for i in (1, 2))
    e = e.withColumn("_a1", a1).withColumn("_b1", b1).withColumn("_a2", a2).withColumn("_b2", b2)
    first, last = F.ceil(F.least("_b1", "_b2")), F.ceil(F.greatest("_b1", "_b2")) - 1
    e = e.where(first <= last).withColumn("_cy", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    x = F.col("_a1") + (F.col("_cy") - F.col("_b1")) * (F.col("_a2") - F.col("_a1")) / (F.col("_b2") - F.col("_b1"))
    crossings = e.select(F.col("gid").alias("_gid"), "_lv", F.floor(x).cast("long").alias("_cx"), "_cy", F.lit(1).alias("_ev"))
    both = cells.withColumn("_ev", F.lit(0)).unionByName(crossings, allowMissingColumns=True)
    w = Window.partitionBy("_gid", "_lv", "_cy").orderBy("_cx").rangeBetween(Window.unboundedPreceding, -1)
    return (both.withColumn("_par", (F.coalesce(F.sum("_ev").over(w), F.lit(0)) % 2).cast("int"))
            .where(F.col("_ev") == 0).drop("_ev"))


def polygon_cells(edges: DataFrame, measures: DataFrame, cell: float | None = None) -> tuple[DataFrame, DataFrame, Grid]:
    """(cells, divided, grid) of a polygon layer.

    ``cells``: one row per undivided cell, ``_lv, _cx, _cy``, with the ids of
    the polygons that it lies wholly inside of (``_in``, no test of its
    points) and those whose boundary touches it (``_rim``): each with its
    edges inside the cell, its corner's x and the corner's parity.
    ``divided``: the cells that hold boundary cells of a finer level. Cells
    without a boundary stay as large as they are, so a polygon's entries grow
    with its boundary."""
    levels, grid = _level_table(edges, measures, cell)
    rim = materialize(boundary_cells(edges, levels, grid), "pip-rim")
    own = (rim.withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_lv") - 1)))
           .select("_gid", F.col("_s").alias("_lv"), _up("_cx", F.col("_lv") - F.col("_s")).alias("_cx"),
                   _up("_cy", F.col("_lv") - F.col("_s")).alias("_cy")).distinct())
    own = materialize(own, "pip-own")
    box = measures.select(F.col("gid").alias("_gid"), F.lit(0).alias("_lv"), *[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    (u0, v0), (u1, v1) = grid.units(F.col("xmin"), F.col("ymin")), grid.units(F.col("xmax"), F.col("ymax"))
    base = box.withColumn("_cx", _span(u0, u1)).withColumn("_cy", _span(v0, v1)).select(*_CELL)
    whole = base.unionByName(_children(own, F.col("_lv")).select(*_CELL))
    whole = whole.join(own.unionByName(rim.select(*_CELL)), _CELL, "left_anti")
    step = F.lit(grid.size) / F.pow(F.lit(float(FAN)), F.col("_lv"))
    rim = rim.withColumn("_x0", F.lit(grid.ox) + F.col("_cx") * step).withColumn("_y0", F.lit(grid.oy) + F.col("_cy") * step)
    rim = rim.withColumn("_edges", F.filter(F.transform("_edges", _upward), lambda e: e["k"].isNotNull()))
    none = F.array().cast(rim.schema["_edges"].dataType)
    rows = _corner_parity(rim.withColumn("_full", F.lit(False)).unionByName(
        whole.withColumn("_edges", none).withColumn("_full", F.lit(True)), allowMissingColumns=True), edges, levels, grid)
    under = F.size(F.expr(f"filter(_edges, e -> {below_sql('e.', '_x0', '_y0')})"))
    rows = (rows.where(~F.col("_full") | (F.col("_par") == 1))
            .withColumn("_par", F.when(F.col("_full"), 1).otherwise((F.col("_par") + under) % 2).cast("int")).drop("_y0"))
    divided = materialize(own.select("_lv", "_cx", "_cy").distinct(), "pip-divided")
    # Cells that another polygon divides: their rows go to the cells below.
    own_cell = F.array(F.struct("_lv", "_cx", "_cy"))
    below = F.array(*[F.struct((F.col("_lv") + 1).alias("_lv"), (F.col("_cx") * FAN + i).alias("_cx"),
                               (F.col("_cy") * FAN + j).alias("_cy")) for i in range(FAN) for j in range(FAN)])
    for s in range(grid.levels):
        cut = divided.where(F.col("_lv") == s).withColumn("_cut", F.lit(True))
        rows = rows.join(cut, ["_lv", "_cx", "_cy"], "left")
        rows = (rows.withColumn("_c", F.explode(F.when(F.col("_cut"), below).otherwise(own_cell)))
                .select("_gid", *[F.col("_c")[k].alias(k) for k in ("_lv", "_cx", "_cy")], "_edges", "_full", "_par", "_x0"))
    entry = F.struct(F.col("_gid").alias("gid"), F.col("_par").alias("par"), F.col("_x0").alias("x0"), F.col("_edges").alias("edges"))
    cells = rows.groupBy("_lv", "_cx", "_cy").agg(
        F.collect_list(F.when(F.col("_full"), F.col("_gid"))).alias("_in"),
        F.collect_list(F.when(~F.col("_full"), entry)).alias("_rim"))
    return cells, divided, grid


def _upward(e: Column) -> Column:
    """An edge as the cell tests take it: upward, with its lean."""
    turn = (e["y1"] > e["y2"]) | ((e["y1"] == e["y2"]) & (e["x1"] > e["x2"]))

    def pick(a, b):
        return F.when(turn, e[b]).otherwise(e[a])

    x1, x2 = pick("x1", "x2"), pick("x2", "x1")
    return F.struct(x1.alias("x1"), pick("y1", "y2").alias("y1"), x2.alias("x2"), pick("y2", "y1").alias("y2"),
                    edge_lean(x1, x2, F.col("_x0")).alias("k"))


class PipIndex:
    """A polygon layer's cell table for point-in-polygon joins, built and
    written once (shared checkpoint folder); its size is measured once so
    every join against it can decide on broadcasting without another pass."""

    def __init__(self, edges: DataFrame, measures: DataFrame | None = None, cell: float | None = None):
        if measures is None:
            measures = polygon_measures(edges)
        cells, self.divided, self.grid = polygon_cells(edges, measures, cell)
        self.cells = materialize(cells, "pip-cells")
        edges_in = F.expr("aggregate(_rim, 0, (n, r) -> n + size(r.edges))")
        r = self.cells.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (
            (F.size("_in"), "i"), (F.size("_rim"), "r"), (edges_in, "e"))]).first()
        self.n_cells, self.n_entries, self.n_edges = int(r["n"]), int(r["i"] + r["r"]), int(r["e"])
        self.n_divided = self.divided.count()
        self.size_bytes = (self.n_cells * (ROW_OVERHEAD + 5 * 8) + int(r["i"]) * 8 + int(r["r"]) * 56
                           + self.n_edges * (EDGE_BYTES + 8))

    @property
    def fan_out(self) -> float:
        """Polygons a cell lists on average: about the hits of a point."""
        return self.n_entries / max(1, self.n_cells)

    def locate(self, points: DataFrame, x: str, y: str, broadcast_limit: int, spread: bool) -> DataFrame:
        """``points`` with the key of the undivided cell they lie in
        (``_plv, _pcx, _pcy``): level by level, a lookup whether the cell is
        divided. A point outside the layer or without a coordinate has no
        cell; with ``spread`` such points get keys of their own kind, so that
        a shuffle does not bring them all into one task."""
        g = self.grid
        u, v = g.units(F.col(x), F.col(y))
        inside = (~F.isnan(x) & ~F.isnan(y) & (u >= 0) & (v >= 0) & (u < F.lit(g.nx)) & (v < F.lit(g.ny)))
        p = points.withColumn("_u", F.when(inside, u)).withColumn("_v", F.when(inside, v))
        p = p.withColumn("_qx", F.col(x).cast("double")).withColumn("_qy", F.col(y).cast("double"))
        small = self.n_divided * ROW_OVERHEAD <= broadcast_limit
        level = F.lit(g.levels)
        for s in range(g.levels):
            k = float(FAN ** s)
            cut = self.divided.where(F.col("_lv") == s).select(F.col("_cx").alias("_dx"), F.col("_cy").alias("_dy"),
                                                              F.lit(True).alias(f"_d{s}"))
            at = (F.floor(F.col("_u") * k) == F.col("_dx")) & (F.floor(F.col("_v") * k) == F.col("_dy"))
            p = p.join(F.broadcast(cut) if small else cut, at, "left").drop("_dx", "_dy")
        for s in reversed(range(g.levels)):
            level = F.when(F.col(f"_d{s}").isNull(), s).otherwise(level)
        p = p.withColumn("_plv", level.cast("int")).drop(*[f"_d{s}" for s in range(g.levels)])
        k = F.pow(F.lit(float(FAN)), F.col("_plv"))
        p = p.withColumn("_pcx", F.floor(F.col("_u") * k)).withColumn("_pcy", F.floor(F.col("_v") * k))
        if spread:
            p = (p.withColumn("_plv", F.when(F.col("_pcx").isNull(), -1).otherwise(F.col("_plv")))
                  .withColumn("_pcy", F.coalesce(F.col("_pcy"), F.lit(0)))
                  .withColumn("_pcx", F.coalesce(F.col("_pcx"), F.xxhash64(*points.columns))))
        return p.drop("_u", "_v")


def pip_hits(points: DataFrame, index: PipIndex, hits: str, *, x: str = "x", y: str = "y", predicate: str = "within",
             broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """``points`` with column ``hits``: the ids of the polygons each lies in
    (null or empty: none). A point meets one cell row (its join key is unique
    there), whose entries are tested in the row. The point side is not
    shuffled when the cells are broadcast; one row per point goes out."""
    sent = 0 < index.size_bytes <= broadcast_limit
    p = index.locate(points, x, y, broadcast_limit, spread=not sent)
    key = [F.col("_plv") == F.col("_lv"), F.col("_pcx") == F.col("_cx"), F.col("_pcy") == F.col("_cy")]
    j = p.join(F.broadcast(index.cells) if sent else index.cells, key, "left")
    test = point_in_cell_sql("r.edges", "r.par", "r.x0", "_qx", "_qy", predicate)
    found = F.when(F.size("_rim") > 0, F.expr(f"concat(_in, transform(filter(_rim, r -> {test}), r -> r.gid))")).otherwise(F.col("_in"))
    return j.select(*[F.col(f"`{c}`") for c in points.columns], found.alias(hits))


def spread_points(points: DataFrame, *indexes: PipIndex) -> DataFrame:
    """``points`` over all cores, if they lie in several polygons each. The
    points come in as many partitions as their files have row groups (a
    million rows make one), and every hit is a row more: without this step,
    one task would write all rows of a row group's points."""
    if points.isStreaming or max(i.fan_out for i in indexes) < FAN_OUT:
        return points
    sc = points.sparkSession.sparkContext
    return points.repartition(TASKS_PER_CORE * sc.defaultParallelism)


def unfold_hits(points: DataFrame, hits: str, gid_col: str, attrs: DataFrame | None = None, how: str = "left",
                broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """One row per point and id of its ``hits`` (kept), with the polygons'
    ``attrs``; ``how='left'``: one row of nulls for a point without any."""
    j = points.select("*", (F.explode_outer if how == "left" else F.explode)(hits).alias(gid_col))
    if attrs is None:
        return j
    a = attrs.withColumnRenamed("gid", "_gid")
    return j.join(broadcast_if_bounded(a, broadcast_limit), F.col(gid_col) == F.col("_gid"), "left").drop("_gid")


def pip_join(points: DataFrame, edges, attrs: DataFrame | None = None, *,
             x: str = "x", y: str = "y", predicate: str = "within", how: str = "left",
             cell: float | None = None, measures: DataFrame | None = None,
             broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, gid_col: str = "gid") -> DataFrame:
    """J1 (``within``: boundary excluded) / J2 (``intersects``) point-in-polygon join.

    ``edges`` is an edge DataFrame or a prebuilt ``PipIndex``.
    ``how='left'``: every point kept; a point in no polygon gets one row of
    nulls, a point in k polygons k rows. ``attrs`` (keyed by ``gid``) are
    looked up last. Returns the point columns + ``gid_col`` + attribute
    columns. Several layers over the same points: ``pip_hits`` for each
    first, then ``unfold_hits``, so that no point is located twice.
    """
    index = edges if isinstance(edges, PipIndex) else PipIndex(edges, measures, cell)
    p = pip_hits(spread_points(points, index), index, "_hits", x=x, y=y, predicate=predicate, broadcast_limit=broadcast_limit)
    return unfold_hits(p, "_hits", gid_col, attrs, how, broadcast_limit).drop("_hits")


# ---------------------------------------------------------------------- J3

def _boxes(measures: DataFrame, prefix: str, least: float | None) -> DataFrame:
    """Boxes with the level of the grid that fits them: cells of 2**level are
    no smaller than the box (or than ``least``), so it touches four at most."""
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"),
                      F.lit(least or 0.0), F.lit(2.0 ** -200))
    return measures.select(*[F.col(k).alias(prefix + k) for k in ("gid", "xmin", "ymin", "xmax", "ymax")],
                           F.ceil(F.log2(side)).cast("int").alias(prefix + "own"))


def _box_cells(boxes: DataFrame, prefix: str, level: Column) -> DataFrame:
    """One row per box and cell of ``level`` that it touches."""
    size = F.pow(F.lit(2.0), F.col("_l"))
    b = boxes.withColumn("_l", level)
    for axis in "xy":
        b = b.withColumn("_g" + axis, _span(F.col(f"{prefix}{axis}min") / size, F.col(f"{prefix}{axis}max") / size))
    return b


def candidate_pairs(meas_a: DataFrame, meas_b: DataFrame, cell: float | None = None) -> DataFrame:
    """Polygon pairs whose bboxes overlap (closed boxes): ``a_gid, b_gid``
    plus both bboxes; each pair appears once.

    A pair meets on the grid that fits the larger box. So each box stands in
    the cells of its own level, and in those of the other layer's larger
    levels: four a level at most, however unlike the sizes. Two equi-joins:
    larger a with b up to its size, larger b with smaller a. In each only the
    cell holding the lower-left corner of the boxes' overlap counts."""
    a, b = _boxes(meas_a, "a_", cell), _boxes(meas_b, "b_", cell)
    levels = {p: [r[0] for r in d.select(p + "own").distinct().collect()] for p, d in (("a_", a), ("b_", b))}

    def raised(boxes, prefix, others, strictly):
        own = F.col(prefix + "own")
        up = F.array(*[F.lit(int(v)) for v in sorted(others)]).cast("array<int>")
        keep = F.filter(up, lambda v: v > own if strictly else v >= own)
        return _box_cells(boxes.withColumn("_up", F.explode(keep)), prefix, F.col("_up")).drop("_up")

    lx, ly = F.greatest("a_xmin", "b_xmin"), F.greatest("a_ymin", "b_ymin")
    size = F.pow(F.lit(2.0), F.col("_l"))
    home = ((F.col("_gx") == F.floor(lx / size)) & (F.col("_gy") == F.floor(ly / size))
            & (lx <= F.least("a_xmax", "b_xmax")) & (ly <= F.least("a_ymax", "b_ymax")))
    key = ["_l", "_gx", "_gy"]
    large_a = _box_cells(a, "a_", F.col("a_own")).join(raised(b, "b_", levels["a_"], False), key)
    large_b = raised(a, "a_", levels["b_"], True).join(_box_cells(b, "b_", F.col("b_own")), key)
    return large_a.unionByName(large_b).filter(home).drop(*key, "a_own", "b_own")


def _trapezoid_pair_area(dx0, dx1) -> F.Column:
    """Signed contribution of one edge pair over their shared x-range:
    ``s_e * s_f * integral of min(y_e, y_f)`` with heights taken relative to
    the pair's local origin (the y0 terms cancel over closed rings)."""
    ax1, ay1, ax2, ay2 = (F.col("ea_" + k) for k in EDGE_COLS)
    bx1, by1, bx2, by2 = (F.col("eb_" + k) for k in EDGE_COLS)
    w = dx1 - dx0

    def at(x1, y1, x2, y2, xv):
        return y1 + (xv - x1) * (y2 - y1) / (x2 - x1)

    f0, f1 = at(ax1, ay1, ax2, ay2, dx0), at(ax1, ay1, ax2, ay2, dx1)
    g0, g1 = at(bx1, by1, bx2, by2, dx0), at(bx1, by1, bx2, by2, dx1)
    d0, d1 = f0 - g0, f1 - g1
    mean_part = (f0 + f1 + g0 + g1) / 4
    ad = F.abs(d0) + F.abs(d1)
    corr = F.when(d0 * d1 >= 0, ad / 4).otherwise((d0 * d0 + d1 * d1) / (4 * ad))
    sa = F.when(ax1 > ax2, F.lit(1.0)).otherwise(F.lit(-1.0))
    sb = F.when(bx1 > bx2, F.lit(1.0)).otherwise(F.lit(-1.0))
    return sa * sb * w * (mean_part - corr)


def slab_width(edges_a: DataFrame, edges_b: DataFrame) -> float:
    """Mean x-extent of the edges of both layers. With slabs of that width an
    edge lies in two slabs on average whatever the lengths: the edge-slab rows
    of a layer are at most its edges plus all extents over the mean."""
    both = edges_a.select("x1", "x2").unionByName(edges_b.select("x1", "x2")).filter(F.col("x1") != F.col("x2"))
    w = both.agg(F.avg(F.abs(F.col("x2") - F.col("x1"))).alias("w")).first()["w"]
    return float(w) if w else 1.0


def edge_pairs(edges_a: DataFrame, meas_a: DataFrame, edges_b: DataFrame, meas_b: DataFrame,
               cell: float | None = None) -> DataFrame:
    """The edge pairs that share x inside the box overlap of their polygons:
    ``a_gid, b_gid, ox, oy, ea_*, eb_*, x0, x1``, each once. An equi-join on
    (polygon pair, x-slab); slabs are as narrow as edges, so edges meet only
    those above or below them and the pairs grow with the vertices."""
    pairs = candidate_pairs(meas_a, meas_b, cell)
    # pair-local origin: lower-left corner of the bbox overlap
    pairs = pairs.select("a_gid", "b_gid", F.greatest("a_xmin", "b_xmin").alias("ox"),
                         F.greatest("a_ymin", "b_ymin").alias("oy"), F.least("a_xmax", "b_xmax").alias("ux"))
    w = F.lit(slab_width(edges_a, edges_b))

    def sided(edges, pref):
        e = edges.filter(F.col("x1") != F.col("x2"))   # vertical edges bound no area
        e = e.select(F.col("gid").alias(pref + "gid"), *[F.col(k).alias(f"e{pref[0]}_{k}") for k in EDGE_COLS])
        return e.withColumn(pref + "lo", F.least(f"e{pref[0]}_x1", f"e{pref[0]}_x2")).withColumn(
            pref + "hi", F.greatest(f"e{pref[0]}_x1", f"e{pref[0]}_x2"))

    # No edge of either polygon lies at an x outside the boxes' overlap and
    # meets the other polygon, so an edge needs only its slabs inside it.
    lo, hi = F.greatest("a_lo", "ox"), F.least("a_hi", "ux")
    pa = (pairs.join(sided(edges_a, "a_"), "a_gid").filter(lo < hi)
          .withColumn("a_sx", F.explode(F.sequence(F.floor(lo / w), F.floor(hi / w)))))
    eb = sided(edges_b, "b_").withColumnRenamed("b_gid", "_bg")
    eb = eb.withColumn("b_sx", F.explode(F.sequence(F.floor(F.col("b_lo") / w), F.floor(F.col("b_hi") / w))))
    j = pa.join(eb, (F.col("b_gid") == F.col("_bg")) & (F.col("a_sx") == F.col("b_sx"))).drop("_bg")
    x0, x1 = F.greatest("a_lo", "b_lo"), F.least("a_hi", "b_hi")
    return j.filter((x0 < x1) & (F.col("a_sx") == F.floor(x0 / w))).withColumn("x0", x0).withColumn("x1", x1)


def overlay_areas(edges_a: DataFrame, meas_a: DataFrame, edges_b: DataFrame, meas_b: DataFrame,
                  cell: float | None = None, rel_tol: float = 1e-9) -> DataFrame:
    """Exact intersection areas ``a_gid, b_gid, inter_area`` of every
    polygon pair of two layers that overlap with positive area. Pieces below
    ``rel_tol`` times the smaller polygon's area (touching pairs) are dropped.
    """
    j = edge_pairs(edges_a, meas_a, edges_b, meas_b, cell)
    x0, x1 = F.col("x0"), F.col("x1")
    # shift to the pair-local origin before integrating
    for p in ("ea_", "eb_"):
        j = (j.withColumn(p + "x1", F.col(p + "x1") - F.col("ox")).withColumn(p + "x2", F.col(p + "x2") - F.col("ox"))
              .withColumn(p + "y1", F.col(p + "y1") - F.col("oy")).withColumn(p + "y2", F.col(p + "y2") - F.col("oy")))
    contrib = _trapezoid_pair_area(x0 - F.col("ox"), x1 - F.col("ox"))
    areas = j.groupBy("a_gid", "b_gid").agg(F.sum(contrib).alias("inter_area"))
    small = (areas.join(meas_a.select(F.col("gid").alias("a_gid"), F.col("area").alias("_aa")), "a_gid")
                  .join(meas_b.select(F.col("gid").alias("b_gid"), F.col("area").alias("_ab")), "b_gid"))
    return small.filter(F.col("inter_area") > F.lit(rel_tol) * F.least("_aa", "_ab")).select(
        "a_gid", "b_gid", "inter_area")


# ---------------------------------------------------------------------- J5

NEAR_EDGES = 32     # edges a point may be compared with on average: cells are divided no further
NEAR_FINE = 64.0    # nor below this part of the usual cell


def _divided(edges: DataFrame, size: float, ox: float, oy: float, within: bool) -> DataFrame:
    """``gid, x1, y1, x2, y2, _cx, _cy, u0, u1, w0, w1``: one row per edge and
    cell of ``size`` that it goes through (``within``: of the cells below its
    present one), with the box of the part in that cell. No edge is lost: its
    cells are moved into the present one where rounding puts them outside."""
    s = F.lit(size)
    a1, a2 = (F.col("x1") - F.lit(ox)) / s, (F.col("x2") - F.lit(ox)) / s
    b1, b2 = (F.col("y1") - F.lit(oy)) / s, (F.col("y2") - F.lit(oy)) / s
    e = edges.withColumns({"_a1": a1, "_a2": a2, "_b1": b1, "_b2": b2})
    if within:
        e = e.withColumnsRenamed({"_cx": "_px", "_cy": "_py"})

    def cells(lo, hi, parent):
        first, last = F.floor(lo).cast("long"), F.floor(hi).cast("long")
        if within:
            least = F.col(parent) * FAN
            first, last = (F.least(F.greatest(c, least), least + (FAN - 1)) for c in (first, last))
        return F.explode(F.sequence(first, last))

    lo, hi = F.least("_a1", "_a2"), F.greatest("_a1", "_a2")
    e = e.withColumn("_cx", cells(lo, hi, "_px"))
    slope = (F.col("_b2") - F.col("_b1")) / F.nullif(F.col("_a2") - F.col("_a1"), F.lit(0.0))

    def at(u):
        y = F.col("_b1") + (u - F.col("_a1")) * slope
        return F.least(F.greatest(y, F.least("_b1", "_b2")), F.greatest("_b1", "_b2"))

    upright = F.col("_a1") == F.col("_a2")
    e = e.withColumns({"_u0": F.greatest(lo, F.col("_cx")), "_u1": F.least(hi, F.col("_cx") + 1)})
    p = F.when(upright, F.col("_b1")).otherwise(at(F.col("_u0")))
    q = F.when(upright, F.col("_b2")).otherwise(at(F.col("_u1")))
    e = e.withColumns({"_p": F.least(p, q), "_q": F.greatest(p, q)}).withColumn("_cy", cells(F.col("_p"), F.col("_q"), "_py"))
    w0, w1 = F.greatest("_p", F.col("_cy")), F.least("_q", F.col("_cy") + 1)
    return e.select("gid", *EDGE_COLS, "_cx", "_cy",
                    (F.lit(ox) + F.col("_u0") * s).alias("u0"), (F.lit(ox) + F.col("_u1") * s).alias("u1"),
                    (F.lit(oy) + w0 * s).alias("w0"), (F.lit(oy) + w1 * s).alias("w1"))


def _nearest_edges(points: DataFrame, edges: DataFrame, box: tuple, fine: float, pid: str, x: str, y: str) -> DataFrame:
    """``pid, gid, dist`` for points outside all polygons (``pid`` not null).

    From a few large cells down: of the cells left to a point, those go that
    lie farther than the far corner of another's edges, as no edge in them can
    be nearest; the rest are divided. Only cells left to some point are
    divided, so the cells follow the points' near edges, and a point meets
    the few edges that are about as near as the nearest, however far it is."""
    x0, y0, x1, y1 = box
    span = max(x1 - x0, y1 - y0) or 1.0
    size, n = span / FAN, points.count()
    slack = F.lit(1e-12 * span * span)
    px, py = F.col(x), F.col(y)

    def boxes(parts):
        return materialize(parts.groupBy("_cx", "_cy").agg(
            F.count(F.lit(1)).alias("_n"), *[f(c).alias(c) for f, c in ((F.min, "u0"), (F.max, "u1"), (F.min, "w0"), (F.max, "w1"))]),
            "near-boxes")

    def left(cells):
        """The point's cells that may hold its nearest edge."""
        dx, dy = F.greatest(F.col("u0") - px, px - F.col("u1"), F.lit(0.0)), F.greatest(F.col("w0") - py, py - F.col("w1"), F.lit(0.0))
        fx, fy = F.greatest(F.abs(px - F.col("u0")), F.abs(px - F.col("u1"))), F.greatest(F.abs(py - F.col("w0")), F.abs(py - F.col("w1")))
        c = cells.select(pid, x, y, "_cx", "_cy", "_n", (dx * dx + dy * dy).alias("_lo"), (fx * fx + fy * fy).alias("_hi"))
        c = c.withColumn("_most", F.min("_hi").over(Window.partitionBy(pid)))
        return materialize(c.where(F.col("_lo") <= F.col("_most") * F.lit(1 + 1e-9) + slack).select(pid, x, y, "_cx", "_cy", "_n"),
                           "near-cells")

    parts = materialize(_divided(edges.select("gid", *EDGE_COLS), size, x0, y0, False), "near-edges")
    cells = left(points.crossJoin(F.broadcast(boxes(parts))))
    while size > fine and (cells.agg(F.sum("_n")).first()[0] or 0) > NEAR_EDGES * n:
        size /= FAN
        live = broadcast_if_bounded(cells.select("_cx", "_cy").distinct())
        parts = materialize(_divided(parts.join(live, ["_cx", "_cy"], "left_semi"), size, x0, y0, True), "near-edges")
        below = broadcast_if_bounded(boxes(parts).withColumns({"_px": F.floor(F.col("_cx") / FAN), "_py": F.floor(F.col("_cy") / FAN)}))
        cells = left(cells.select(pid, x, y, F.col("_cx").alias("_px"), F.col("_cy").alias("_py")).join(below, ["_px", "_py"]))
    live = broadcast_if_bounded(cells.select("_cx", "_cy").distinct())
    parts = broadcast_if_bounded(parts.join(live, ["_cx", "_cy"], "left_semi").select("gid", *EDGE_COLS, "_cx", "_cy"))
    d2 = F.expr(seg_point_dist2_sql("struct(x1, y1, x2, y2)", f"`{x}`", f"`{y}`"))
    near = cells.join(parts, ["_cx", "_cy"]).groupBy(pid, "gid").agg(F.sqrt(F.min(d2)).alias("dist"))
    near = near.withColumn("_m", F.min("dist").over(Window.partitionBy(pid)))
    return near.filter(F.col("dist") == F.col("_m")).drop("_m")


def nearest_polygon(points: DataFrame, edges: DataFrame, *, pid: str = "pid", x: str = "x", y: str = "y",
                    measures: DataFrame | None = None, cell: float | None = None,
                    index: "PipIndex | None" = None) -> DataFrame:
    """For each point, the polygon(s) at minimum distance, ties kept:
    ``pid, gid, dist``. Points inside or on a polygon get distance 0.

    Exact search down a tree of cells that is built where the points need it
    (``_nearest_edges``); ``cell`` is the usual size of a cell. Steps are
    written to the shared checkpoint folder. A point with a missing coordinate
    gets one row of nulls, as in a left join; with no polygons every point does.
    """
    from ..session import ensure_checkpoint_dir
    spark = points.sparkSession
    ensure_checkpoint_dir(spark)
    if measures is None:
        measures = polygon_measures(edges)
    if cell is None:
        cell = default_cell_size(measures)
    known = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    pts = points.select(pid, x, y).filter(known)
    lost = points.filter(~known).select(pid, F.lit(None).cast("long").alias("gid"), F.lit(None).cast("double").alias("dist"))
    inside = (pip_join(pts, index if index is not None else PipIndex(edges, measures), None, x=x, y=y,
                       predicate="intersects", how="inner")
              .select(pid, "gid", F.lit(0.0).alias("dist")))
    ext = measures.agg(F.min("xmin").alias("a"), F.min("ymin").alias("b"),
                       F.max("xmax").alias("c"), F.max("ymax").alias("d")).first()
    if ext["a"] is None:
        return points.select(pid, F.lit(None).cast("long").alias("gid"), F.lit(None).cast("double").alias("dist"))
    todo = pts.join(inside.select(pid), pid, "left_anti").filter(F.col(pid).isNotNull()).distinct().checkpoint()
    if todo.isEmpty():
        return lost.unionByName(inside)
    return lost.unionByName(inside).unionByName(_nearest_edges(todo, edges, tuple(ext), float(cell) / NEAR_FINE, pid, x, y))
