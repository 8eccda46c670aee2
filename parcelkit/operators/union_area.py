"""Area of a tract inside the union of overlapping neighborhoods.

A sweep over vertical slabs, as joins, windows and sums keyed by (tract,
slab). Every edge is cut at the slab borders, so a tract with very many
vertices is spread over as many keys as its edges fill. In a slab the x of
all end points and of all crossings are the borders of bands. Inside a band
no two edges cross, so every cross-section has the same order of edges and a
length that is linear in x: the length at the middle times the width is exact.

The cross-section is read from below: a shell runs counter-clockwise and a
hole clockwise, so an edge to the right enters its polygon and one to the left
leaves it. Two running sums tell how many neighborhoods, and whether the
tract, cover the gap up to the next edge.

``union_layer`` makes the union of a whole layer once, by the same sweep with a
grid cell in the place of the tract. A cell wholly inside some polygon needs no
sweep, so where many polygons lie on top of each other their edges meet no
other edge: the work grows with the polygons and the union's outline, not with
the pairs that overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .polygons import EDGE_COLS

CELLS = 8     # cells along the mean side of a polygon, in the union of a layer
BLOCK = 8     # covered cells are put together in blocks of so many at most a side


def _y_at(x: Column, e: str = "") -> Column:
    """y of the edge (columns prefixed by ``e``) at x."""
    x1, y1, x2, y2 = (F.col(f"{e}{c}") for c in ("x1", "y1", "x2", "y2"))
    return y1 + (x - x1) * (y2 - y1) / (x2 - x1)


def tract_edges_with_neighborhoods(pairs: DataFrame, nbh_edges: DataFrame, tract_edges: DataFrame) -> DataFrame:
    """``b_gid, owner, x1, y1, x2, y2, lo, hi``: the sloped edges of each
    tract (owner null) and of its neighborhoods (owner a_gid), from the
    tract's lower left corner, with their x-range inside the tract's.
    Edges above the tract are left out; those below count as entered."""
    sloped = F.col("x1") != F.col("x2")
    t = (tract_edges.select(F.col("gid").alias("b_gid"), "x1", "y1", "x2", "y2")
         .join(pairs.select("b_gid").distinct(), "b_gid", "left_semi"))
    box = t.groupBy("b_gid").agg(F.min("x1").alias("ox"), F.min("y1").alias("oy"),
                                 F.max("x1").alias("ex"), F.max("y1").alias("ey"))
    n = nbh_edges.select(F.col("gid").alias("a_gid"), "x1", "y1", "x2", "y2")
    near = ((F.least("x1", "x2") < F.col("ex")) & (F.greatest("x1", "x2") > F.col("ox"))
            & (F.least("y1", "y2") < F.col("ey")))
    pb = pairs.select("a_gid", "b_gid").distinct().join(box, "b_gid")
    n = pb.join(n, (pb["a_gid"] == n["a_gid"]) & near).drop(n["a_gid"])
    cols = ["b_gid", "owner", "ox", "oy", "ex", "x1", "y1", "x2", "y2"]
    every = (t.join(box, "b_gid").withColumn("owner", F.lit(None).cast("long")).select(*cols)
             .unionAll(n.withColumn("owner", F.col("a_gid").cast("long")).select(*cols))).where(sloped)
    x1, x2 = F.col("x1") - F.col("ox"), F.col("x2") - F.col("ox")
    return every.select("b_gid", "owner", x1.alias("x1"), (F.col("y1") - F.col("oy")).alias("y1"),
                        x2.alias("x2"), (F.col("y2") - F.col("oy")).alias("y2"),
                        F.greatest(F.least(x1, x2), F.lit(0.0)).alias("lo"),
                        F.least(F.greatest(x1, x2), F.col("ex") - F.col("ox")).alias("hi"))


def slab_pieces(edges: DataFrame) -> DataFrame:
    """Edges cut at slab borders: the columns of ``edges`` with ``slab``. A
    slab is as wide as the mean edge of the tract's group. The tract's own
    boundary passes each x twice at least, so a group of n edges has n / 2
    slabs at most and its pieces are at most twice its edges, and a few."""
    width = edges.groupBy("b_gid").agg(F.avg(F.col("hi") - F.col("lo")).alias("step"))
    first, last = F.floor(F.col("lo") / F.col("step")), F.ceil(F.col("hi") / F.col("step")) - 1
    cut = edges.join(width, "b_gid").withColumn("slab", F.explode(F.sequence(first, F.greatest(first, last))))
    return cut.select("b_gid", "slab", "owner", "x1", "y1", "x2", "y2",
                      F.greatest("lo", F.col("slab") * F.col("step")).alias("lo"),
                      F.least("hi", (F.col("slab") + 1) * F.col("step")).alias("hi")).where("lo < hi")


def crossings(pieces: DataFrame) -> DataFrame:
    """``b_gid, slab, x`` where pieces of two polygons cross inside a slab and
    not below the tract."""
    def side(p: str) -> DataFrame:
        top, low = F.greatest("y1", "y2"), F.least("y1", "y2")
        return pieces.select("b_gid", "slab", *(F.col(c).alias(p + c) for c in ("x1", "y1", "x2", "y2", "lo", "hi")),
                             F.struct(F.col("owner").isNull(), "owner").alias(p + "own"),
                             top.alias(p + "top"), low.alias(p + "low")).where(F.col(p + "top") >= 0)

    xa, xb = F.greatest("p_lo", "q_lo"), F.least("p_hi", "q_hi")
    met = (side("p_").join(side("q_"), ["b_gid", "slab"])
           .where((F.col("p_own") < F.col("q_own")) & (xa < xb)
                  & (F.col("p_top") >= F.col("q_low")) & (F.col("q_top") >= F.col("p_low"))))
    met = met.withColumns({"xa": xa, "xb": xb})
    da = _y_at(F.col("xa"), "p_") - _y_at(F.col("xa"), "q_")
    db = _y_at(F.col("xb"), "p_") - _y_at(F.col("xb"), "q_")
    met = met.withColumns({"da": da, "db": db}).where(F.col("da") * F.col("db") < 0)
    return met.select("b_gid", "slab", (F.col("xa") + (F.col("xb") - F.col("xa")) * F.col("da") / (F.col("da") - F.col("db"))).alias("x"))


def _band_edges(pieces: DataFrame, *more: Column) -> DataFrame:
    """``b_gid, slab, xa, xb, y, t, n``: the pieces in each band with their y
    at its middle, and 1 or -1 where one enters or leaves the tract (t) or a
    neighborhood (n), else 0."""
    ends = pieces.select("b_gid", "slab", F.explode(F.array("lo", "hi")).alias("x"))
    borders = ends.unionAll(crossings(pieces)).distinct()
    bands = (borders.withColumn("xb", F.lead("x").over(Window.partitionBy("b_gid", "slab").orderBy("x")))
             .where("xb IS NOT NULL").withColumnRenamed("x", "xa"))
    enters = F.when(F.col("x1") < F.col("x2"), 1).otherwise(-1)
    return (bands.join(pieces, ["b_gid", "slab"]).where((F.col("lo") <= F.col("xa")) & (F.col("hi") >= F.col("xb")))
            .select("b_gid", "slab", "xa", "xb", _y_at((F.col("xa") + F.col("xb")) / 2).alias("y"),
                    F.when(F.col("owner").isNull(), enters).otherwise(0).alias("t"),
                    F.when(F.col("owner").isNull(), 0).otherwise(enters).alias("n"), *more))


def union_clipped_area(pairs: DataFrame, nbh_edges: DataFrame, tract_edges: DataFrame) -> DataFrame:
    """``b_gid, clipped_area`` = area(tract n union of its overlapping
    neighborhoods). ``pairs``: ``a_gid`` (neighborhood), ``b_gid`` (tract);
    repeated pairs count once."""
    pieces = materialize(slab_pieces(tract_edges_with_neighborhoods(pairs, nbh_edges, tract_edges)), "union-pieces")
    hits = _band_edges(pieces)
    band = Window.partitionBy("b_gid", "slab", "xa").orderBy("y")
    below = band.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gaps = hits.select("b_gid", (F.col("xb") - F.col("xa")).alias("w"), (F.lead("y").over(band) - F.col("y")).alias("h"),
                       F.sum("t").over(below).alias("t"), F.sum("n").over(below).alias("n"))
    return gaps.groupBy("b_gid").agg(
        F.sum(F.when((F.col("t") > 0) & (F.col("n") > 0), F.col("w") * F.col("h")).otherwise(0.0)).alias("clipped_area"))


# ------------------------------------------------------------ union of a layer

def _columns(edges: DataFrame, size: float, ox: float) -> DataFrame:
    """``edges`` with _cx: one row per sloped edge and column of the grid that
    it has a part in."""
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    first, last = (F.floor((c - F.lit(ox)) / F.lit(size)) for c in (lo, hi))
    return edges.select("gid", *EDGE_COLS).where("x1 <> x2").withColumn("_cx", F.explode(F.sequence(first, last)))


def covered_runs(edges: DataFrame, touched: DataFrame, size: float, ox: float, oy: float) -> DataFrame:
    """``_cx, lo, hi``: the runs of cells of each column that lie wholly inside
    some polygon, joined to the longest. ``touched``: ``gid, _cx, _cy`` of the
    cells with a part of the polygon's boundary. Between two of them a
    polygon's cells are all inside or all outside, which the edges below them
    at the middle of the column tell."""
    xc = F.lit(ox) + (F.col("_cx") + 0.5) * F.lit(size)
    passing = _columns(edges, size, ox).where((F.col("x1") <= xc) != (F.col("x2") <= xc)).select(
        "gid", "_cx", F.floor((_y_at(xc) - F.lit(oy)) / F.lit(size)).alias("_cy"),
        F.when(F.col("x1") < F.col("x2"), 1).otherwise(-1).alias("w"))
    cells = passing.unionByName(touched.withColumn("w", F.lit(0))).groupBy("gid", "_cx", "_cy").agg(F.sum("w").alias("w"))
    up = Window.partitionBy("gid", "_cx").orderBy("_cy")
    runs = (cells.select("_cx", (F.col("_cy") + 1).alias("lo"), (F.lead("_cy").over(up) - 1).alias("hi"),
                         F.sum("w").over(up).alias("w"))
            .where("w > 0 AND lo <= hi").groupBy("_cx", "lo").agg(F.max("hi").alias("hi")))
    col = Window.partitionBy("_cx").orderBy("lo")
    before = F.max("hi").over(col.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("opens", F.when(F.col("lo") <= before + 1, 0).otherwise(1))
    runs = runs.withColumn("i", F.sum("opens").over(col.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("_cx", "i").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("i")


def _blocks(runs: DataFrame) -> DataFrame:
    """``c0, c1, lo, hi``: the runs cut into blocks of BLOCK cells, with equal
    parts of neighboring columns put together."""
    first, last = F.floor(F.col("lo") / BLOCK), F.floor(F.col("hi") / BLOCK)
    cut = runs.withColumn("_b", F.explode(F.sequence(first, last))).select(
        "_cx", F.floor(F.col("_cx") / BLOCK).alias("_a"), F.greatest("lo", F.col("_b") * BLOCK).alias("lo"),
        F.least("hi", F.col("_b") * BLOCK + (BLOCK - 1)).alias("hi"))
    side = Window.partitionBy("_a", "lo", "hi").orderBy("_cx")
    cut = cut.withColumn("i", F.col("_cx") - F.row_number().over(side))
    return cut.groupBy("_a", "lo", "hi", "i").agg(F.min("_cx").alias("c0"), F.max("_cx").alias("c1")).drop("_a", "i")


def _cell_pieces(edges: DataFrame, touched: DataFrame, mixed: DataFrame, size: float, ox: float, oy: float) -> DataFrame:
    """``b_gid, slab, owner, x1, y1, x2, y2, lo, hi``, from the lower left
    corner of each cell (_cx, _cy) of ``mixed``, called b_gid and slab: the
    cell's bottom and top (owner null) and the edges of the polygons whose
    boundary is in it, as far as they lie in the cell or below it."""
    x0, x1 = F.lit(ox) + F.col("_cx") * F.lit(size), F.lit(ox) + (F.col("_cx") + 1) * F.lit(size)
    y0, y1 = F.lit(oy) + F.col("_cy") * F.lit(size), F.lit(oy) + (F.col("_cy") + 1) * F.lit(size)
    lo = F.greatest(F.least("x1", "x2") - x0, F.lit(0.0))
    hi = F.least(F.greatest("x1", "x2") - x0, x1 - x0)
    own = (touched.join(mixed, ["_cx", "_cy"]).join(_columns(edges, size, ox), ["gid", "_cx"])
           .select(F.col("_cx").alias("b_gid"), F.col("_cy").alias("slab"), F.col("gid").cast("long").alias("owner"),
                   (F.col("x1") - x0).alias("x1"), (F.col("y1") - y0).alias("y1"),
                   (F.col("x2") - x0).alias("x2"), (F.col("y2") - y0).alias("y2"), lo.alias("lo"), hi.alias("hi"),
                   (y1 - y0).alias("h"))
           .where((F.col("lo") < F.col("hi")) & (F.least(_y_at(F.col("lo")), _y_at(F.col("hi"))) < F.col("h"))).drop("h"))
    zero, w, h = F.lit(0.0), x1 - x0, y1 - y0
    sides = mixed.select(
        F.col("_cx").alias("b_gid"), F.col("_cy").alias("slab"), F.lit(None).cast("long").alias("owner"),
        F.explode(F.array(F.struct(zero.alias("x1"), zero.alias("y1"), w.alias("x2"), zero.alias("y2")),
                          F.struct(w.alias("x1"), h.alias("y1"), zero.alias("x2"), h.alias("y2")))).alias("e"),
        zero.alias("lo"), w.alias("hi"))
    return own.unionByName(sides.select("b_gid", "slab", "owner", "e.*", "lo", "hi"))


def _cell_parts(pieces: DataFrame) -> DataFrame:
    """``b_gid, slab, xa, xb, low, top``: disjoint parts of the union in each
    cell, between x = xa and xb, above the edge low and below the edge top.
    Parts of neighboring bands between the same edges are put together."""
    hits = _band_edges(pieces, _y_at(F.col("xa")).alias("ya"), _y_at(F.col("xb")).alias("yb"),
                       F.struct(*EDGE_COLS).alias("e"))
    band = Window.partitionBy("b_gid", "slab", "xa").orderBy("y", F.desc(F.col("t") + F.col("n")))
    below = band.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = hits.withColumn("inside", (F.sum("t").over(below) > 0) & (F.sum("n").over(below) > 0))
    turns = hits.withColumn("was", F.coalesce(F.lag("inside").over(band), F.lit(False))).where("inside <> was")
    at = Window.partitionBy("b_gid", "slab", "xa").orderBy("y", F.desc("inside"))
    parts = turns.select("b_gid", "slab", "xa", "xb", "inside", F.col("e").alias("low"), F.lead("e").over(at).alias("top"),
                         (F.lead("ya").over(at) - F.col("ya") + F.lead("yb").over(at) - F.col("yb")).alias("h")).where("inside AND h > 0")
    row = Window.partitionBy("b_gid", "slab", "low", "top").orderBy("xa")
    parts = parts.withColumn("opens", F.when(F.lag("xb").over(row) == F.col("xa"), 0).otherwise(1))
    parts = parts.withColumn("i", F.sum("opens").over(row.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy("b_gid", "slab", "low", "top", "i").agg(F.min("xa").alias("xa"), F.max("xb").alias("xb")).drop("i")


def union_layer(edges: DataFrame, cells: float = CELLS) -> tuple[DataFrame, DataFrame]:
    """The union of all polygons of a layer as a layer of disjoint trapezoids:
    their lower and upper edges (``gid, x1, y1, x2, y2``), and ``gid, xmin,
    ymin, xmax, ymax, area``. ``cells``: cells along the mean polygon's side."""
    from .spatial import _divided
    box = edges.groupBy("gid").agg(F.least(F.min("x1"), F.min("x2")).alias("a"), F.least(F.min("y1"), F.min("y2")).alias("b"),
                                   F.greatest(F.max("x1"), F.max("x2")).alias("c"), F.greatest(F.max("y1"), F.max("y2")).alias("d"))
    r = box.agg(F.avg(F.greatest(F.col("c") - F.col("a"), F.col("d") - F.col("b"))).alias("side"),
                F.min("a").alias("ox"), F.min("b").alias("oy")).first()
    size, ox, oy = (r["side"] or 1.0) / cells, r["ox"] or 0.0, r["oy"] or 0.0
    touched = materialize(_divided(edges.select("gid", *EDGE_COLS), size, ox, oy, False).select("gid", "_cx", "_cy").distinct(),
                          "union-touched")
    runs = materialize(covered_runs(edges, touched, size, ox, oy), "union-covered")
    # A touched cell is in a run if the runs that start at or below it reach it.
    upto = F.max("hi").over(Window.partitionBy("_cx").orderBy("_cy").rangeBetween(Window.unboundedPreceding, 0))
    both = touched.select("_cx", "_cy").distinct().withColumn("hi", F.lit(None).cast("long")).unionByName(
        runs.select("_cx", F.col("lo").alias("_cy"), "hi"))
    mixed = both.withColumn("upto", upto).where("hi IS NULL AND (upto IS NULL OR upto < _cy)").select("_cx", "_cy")
    pieces = materialize(_cell_pieces(edges, touched, materialize(mixed, "union-mixed"), size, ox, oy), "union-pieces")

    def y_of(line: str, x: Column) -> Column:
        return _y_at(x, line + ".")
    x0, y0 = F.lit(ox) + F.col("b_gid") * F.lit(size), F.lit(oy) + F.col("slab") * F.lit(size)
    xa, xb = F.col("xa"), F.col("xb")
    swept = _cell_parts(pieces).select((x0 + xa).alias("xmin"), (x0 + xb).alias("xmax"),
                                       (y0 + y_of("low", xa)).alias("la"), (y0 + y_of("low", xb)).alias("lb"),
                                       (y0 + y_of("top", xa)).alias("ta"), (y0 + y_of("top", xb)).alias("tb"))
    at = lambda o, c: F.lit(o) + c * F.lit(size)
    solid = _blocks(runs).select(at(ox, F.col("c0")).alias("xmin"), at(ox, F.col("c1") + 1).alias("xmax"),
                                 at(oy, F.col("lo")).alias("la"), at(oy, F.col("lo")).alias("lb"),
                                 at(oy, F.col("hi") + 1).alias("ta"), at(oy, F.col("hi") + 1).alias("tb"))
    parts = materialize(swept.unionByName(solid).where("xmin < xmax").withColumn("gid", F.monotonically_increasing_id()), "union-parts")
    line = lambda a, b, c, d: F.struct(*(F.col(v).alias(k) for v, k in zip((a, b, c, d), EDGE_COLS)))
    sides = parts.select("gid", F.explode(F.array(line("xmin", "la", "xmax", "lb"), line("xmax", "tb", "xmin", "ta"))).alias("e"))
    return sides.select("gid", "e.*"), parts.select(
        "gid", "xmin", F.least("la", "lb").alias("ymin"), "xmax", F.greatest("ta", "tb").alias("ymax"),
        ((F.col("ta") - F.col("la") + F.col("tb") - F.col("lb")) / 2 * (F.col("xmax") - F.col("xmin"))).alias("area"))
