"""Geometry properties on the literal hard-case shapes and the projections."""

import math

import numpy as np

import pytest
from pyspark.sql import functions as F

from parcelkit.functions import geom as G
from parcelkit.operators import polygons as P
from parcelkit.operators import spatial

ZONE_AREAS = {1: 3.00e6, 2: 3.75e6, 3: 1.50e6, 4: 0.50e6}


def test_zone_areas_and_orientation(spark, zones):
    e = P.edges_from_vertices(zones)
    m = {r["gid"]: r["area"] for r in P.polygon_measures(e).collect()}
    for gid, a in ZONE_AREAS.items():
        assert m[gid] == pytest.approx(a, rel=1e-12)


def test_centroid_of_square_with_hole(spark, zones):
    e = P.edges_from_vertices(zones.filter("gid = 2"))
    r = P.polygon_measures(e).first()
    # shell 2500..4500 minus hole 3000..3500: centroid shifts away from the hole
    sx = (4e6 * 3500 - 0.25e6 * 3250) / 3.75e6
    assert r["cx"] == pytest.approx(sx) and r["cy"] == pytest.approx(sx)


def test_overlay_self_symmetry_and_touching(spark, zones):
    e = P.edges_from_vertices(zones)
    m = P.polygon_measures(e)
    ov = {(r["a_gid"], r["b_gid"]): r["inter_area"] for r in spatial.overlay_areas(e, m, e, m, cell=700.0).collect()}
    for gid, a in ZONE_AREAS.items():
        assert ov[(gid, gid)] == pytest.approx(a, rel=1e-9)          # area(P n P) = area(P)
    assert (1, 4) not in ov and (4, 1) not in ov and (3, 4) not in ov  # touching only -> dropped
    for (a, b), v in ov.items():
        assert ov[(b, a)] == pytest.approx(v, rel=1e-9)               # symmetric


def test_overlay_cell_size_invariant(spark, zones):
    e = P.edges_from_vertices(zones)
    m = P.polygon_measures(e)
    r1 = sorted((r[0], r[1], round(r[2], 3)) for r in spatial.overlay_areas(e, m, e, m, cell=300.0).collect())
    r2 = sorted((r[0], r[1], round(r[2], 3)) for r in spatial.overlay_areas(e, m, e, m, cell=5000.0).collect())
    assert r1 == r2


def _brute_inside(poly_rings, x, y):
    inside = False
    for ring in poly_rings:
        n = len(ring)
        for i in range(n):
            x1, y1 = ring[i]
            x2, y2 = ring[(i + 1) % n]
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                inside = not inside
    return inside


def test_pip_matches_brute_force(spark, zones):
    rows = zones.collect()
    rings = {}
    for r in sorted(rows, key=lambda r: (r["gid"], r["part"], r["role"], r["ord"])):
        rings.setdefault(r["gid"], {}).setdefault((r["part"], r["role"]), []).append((r["x"], r["y"]))
    pts = [(i, -200.0 + (i * 7919) % 4900 + 0.5, -200.0 + (i * 104729) % 4900 + 0.25) for i in range(3000)]
    pdf = spark.createDataFrame(pts, "pid long, x double, y double")
    e = P.edges_from_vertices(zones)
    for cell in (150.0, 1000.0):
        got = {(r["pid"], r["gid"]) for r in spatial.pip_join(pdf, e, None, how="inner", cell=cell).collect()}
        want = {(pid, gid) for pid, x, y in pts for gid, rr in rings.items() if _brute_inside(rr.values(), x, y)}
        assert got == want


def test_pip_boundary_predicates(spark, zones):
    e = P.edges_from_vertices(zones.filter("gid = 4"))
    pts = spark.createDataFrame([(1, 2500.0, 0.0), (2, 2500.0, 250.0), (3, 3000.0, 500.0), (4, 5000.0, 5000.0)],
                                "pid long, x double, y double")
    within = {r["pid"]: r["gid"] for r in spatial.pip_join(pts, e, None, predicate="within", cell=100.0).collect()}
    inter = {r["pid"]: r["gid"] for r in spatial.pip_join(pts, e, None, predicate="intersects", cell=100.0).collect()}
    assert within == {1: None, 2: 4, 3: None, 4: None}
    assert inter == {1: 4, 2: 4, 3: 4, 4: None}


def test_nearest_polygon_exact(spark, zones):
    e = P.edges_from_vertices(zones)
    pts = spark.createDataFrame([(1, 5000.0, 5000.0), (2, 500.0, 500.0), (3, 2250.0, 2250.0)], "pid long, x double, y double")
    got = {(r["pid"], r["gid"]): r["dist"] for r in spatial.nearest_polygon(pts, e, cell=200.0).collect()}
    assert got[(2, 1)] == 0.0
    assert got[(1, 2)] == pytest.approx(math.hypot(500, 500))
    assert got[(3, 2)] == pytest.approx(250 * math.sqrt(2))


def test_albers_reference_point(spark):
    df = spark.createDataFrame([(-77.4360, 37.5407)], "lon double, lat double")
    r = df.select(G.lonlat_to_albers("lon", "lat").alias("p")).first()["p"]
    assert r["x"] == pytest.approx(1614463.213, abs=1e-3) and r["y"] == pytest.approx(1769537.327, abs=1e-3)


def test_projection_round_trips(spark):
    df = spark.createDataFrame([(-77.4360, 37.5407), (-120.0, 45.0), (-70.5, 25.1)], "lon double, lat double")
    a = df.select(G.lonlat_to_albers("lon", "lat").alias("p")).select(G.albers_to_lonlat("p.x", "p.y").alias("q"))
    m = df.select(G.lonlat_to_mercator("lon", "lat").alias("p")).select(G.mercator_to_lonlat("p.x", "p.y").alias("q"))
    for src, got in zip(df.collect(), a.collect()):
        assert got["q"]["x"] == pytest.approx(src["lon"], abs=1e-9) and got["q"]["y"] == pytest.approx(src["lat"], abs=1e-9)
    for src, got in zip(df.collect(), m.collect()):
        assert got["q"]["x"] == pytest.approx(src["lon"], abs=1e-9) and got["q"]["y"] == pytest.approx(src["lat"], abs=1e-9)


def test_invalid_ring_report(spark):
    bow = spark.createDataFrame([(9, 0, "shell", i, x, y) for i, (x, y) in
                                 enumerate([(0.0, 0.0), (10.0, 10.0), (10.0, 0.0), (0.0, 10.0)])],
                                "gid long, part int, role string, ord int, x double, y double")
    r = P.invalid_rings(bow, cell=3.0).collect()
    assert len(r) == 1 and r[0]["gid"] == 9 and r[0]["n_crossings"] == 1


def test_pip_slot_and_array_paths_agree(spark):
    """A 64-gon (with a square hole) at several cell sizes: boundary cells
    hold from one to many edges, so both the unrolled-slot test and the array
    test run; both must equal brute force."""
    n = 64
    shell = [(1000 + 900 * math.cos(2 * math.pi * k / n), 1000 + 700 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    hole = [(900.0, 900.0), (900.0, 1100.0), (1100.0, 1100.0), (1100.0, 900.0)]
    rows = [(7, 0, "shell", k, x, y) for k, (x, y) in enumerate(shell)] + \
           [(7, 0, "hole", k, x, y) for k, (x, y) in enumerate(hole)]
    v = spark.createDataFrame(rows, "gid long, part int, role string, ord int, x double, y double")
    e = P.edges_from_vertices(v)
    pts = [(i, 50.0 + (i * 7919) % 1900 + 0.125, 250.0 + (i * 104729) % 1500 + 0.375) for i in range(4000)]
    pdf = spark.createDataFrame(pts, "pid long, x double, y double")
    want = {pid for pid, x, y in pts if _brute_inside([shell, hole], x, y)}
    for cell in (40.0, 150.0, 600.0):
        got = {r["pid"] for r in spatial.pip_join(pdf, e, None, how="inner", cell=cell).collect()}
        assert got == want


def test_union_clip_area_with_overlaps(spark):
    """J11 with overlapping neighborhoods: area(t n (n1 u n2)) by the slab
    sweep; the plain sum of pieces would count the overlap twice."""
    from parcelkit.operators import areal

    def sq(gid, x0, y0, x1, y1):
        return [(gid, 0, "shell", k, float(x), float(y))
                for k, (x, y) in enumerate([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])]

    schema = "gid long, part int, role string, ord int, x double, y double"
    nb = spark.createDataFrame(sq(1, 0, 0, 60, 60) + sq(2, 40, 20, 100, 80), schema)
    tr = spark.createDataFrame(sq(10, 20, 10, 90, 70) + sq(11, 200, 200, 210, 210) +
                               [(12, 0, "shell", k, float(x), float(y))
                                for k, (x, y) in enumerate([(50, 0), (110, 50), (50, 100)])],
                               schema)
    ne, te = P.edges_from_vertices(nb), P.edges_from_vertices(tr)
    nm, tm = P.polygon_measures(ne), P.polygon_measures(te)
    ov = spatial.overlay_areas(ne, nm, te, tm, cell=25.0)
    got = {r["b_gid"]: r["clipped_area"] for r in areal.clip_area(ov, ne, nm, te).collect()}
    # tract 10 = [20,90]x[10,70]; union = [0,60]^2 u [40,100]x[20,80]
    # n1 part [20,60]x[10,60] (2000) + n2 part [40,90]x[20,70] (2500) - their overlap [40,60]x[20,60] (800)
    t10 = 40 * 50 + 50 * 50 - 20 * 40
    assert got[10] == pytest.approx(t10, rel=1e-12)
    assert 11 not in got
    # triangle tract: compare with a fine raster
    xs = np.arange(0.05, 120, 0.1)
    X_, Y_ = np.meshgrid(xs, xs)
    tri = (X_ >= 50) & (Y_ >= (X_ - 50) * 50 / 60) & (Y_ <= 100 - (X_ - 50) * 50 / 60)
    un = ((X_ <= 60) & (Y_ <= 60)) | ((X_ >= 40) & (X_ <= 100) & (Y_ >= 20) & (Y_ <= 80))
    assert got[12] == pytest.approx((tri & un).sum() * 0.01, rel=2e-3)


def _band_area(tract, polygons):
    """Area of a tract ring inside the union of rings: bands between all end
    points and crossings of all edges, one merged section for each."""
    def edges(r):
        return [(*a, *b) for a, b in zip(r, r[1:] + r[:1]) if a[0] != b[0]]

    every = [edges(r) for r in [tract, *polygons]]
    flat = [e for es in every for e in es]
    xs = {x for e in flat for x in (e[0], e[2])}
    for i, (a, b, c, d) in enumerate(flat):
        for p, q, r, s in flat[:i]:
            m, n = (d - b) / (c - a), (s - q) / (r - p)
            if m != n:
                x = (q - n * p - b + m * a) / (m - n)
                if max(min(a, c), min(p, r)) < x < min(max(a, c), max(p, r)):
                    xs.add(x)
    xs = sorted(xs)
    total = 0.0
    for lo, hi in zip(xs, xs[1:]):
        x = (lo + hi) / 2
        ys = [sorted(b + (x - a) * (d - b) / (c - a) for a, b, c, d in es if min(a, c) < x < max(a, c)) for es in every]
        stops = sorted({y for y_ in ys for y in y_})
        for u, v in zip(stops, stops[1:]):
            inside = [sum(y < (u + v) / 2 for y in y_) % 2 for y_ in ys]
            total += (hi - lo) * (v - u) * (inside[0] and any(inside[1:]))
    return total


def test_union_clip_area_of_many_shapes(spark):
    """Star-shaped neighborhoods on top of each other, some of them equal or
    far below the tract's middle; one tract with many vertices. No Python
    stage; a tract's edges are spread over slabs."""
    import random

    from parcelkit.operators import union_area

    rng = random.Random(11)

    def star(cx, cy, r, n, least=0.4):
        at = [(r * rng.uniform(least, 1), 2 * math.pi * k / n) for k in range(n)]
        return [(cx + d * math.cos(w), cy + d * math.sin(w)) for d, w in at]

    nbs = {g: star(rng.uniform(0, 100), rng.uniform(0, 100), rng.uniform(15, 45), rng.randint(5, 14)) for g in range(1, 9)}
    nbs[9] = list(nbs[1])
    tracts = {100: star(50, 50, 60, 400, 0.99), 101: star(20, 30, 30, 7), 102: [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0)]}
    schema = "gid long, part int, role string, ord int, x double, y double"

    def layer(rings):
        return P.edges_from_vertices(spark.createDataFrame(
            [(g, 0, "shell", k, x, y) for g, r in rings.items() for k, (x, y) in enumerate(r)], schema))

    ne, te = layer(nbs), layer(tracts)
    pairs = spark.createDataFrame([(n, t) for n in nbs for t in tracts] * 2, "a_gid long, b_gid long")
    out = union_area.union_clipped_area(pairs, ne, te)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
    got = {r["b_gid"]: r["clipped_area"] for r in out.collect()}
    for t, ring in tracts.items():
        assert got[t] == pytest.approx(_band_area(ring, list(nbs.values())), rel=1e-9)
    edges = union_area.tract_edges_with_neighborhoods(pairs, ne, te)
    pieces = union_area.slab_pieces(edges)
    per_slab = pieces.where("b_gid = 100").groupBy("slab").count().agg({"count": "max"}).first()[0]
    assert pieces.count() <= 4 * edges.count() and per_slab <= 60
    assert union_area.union_clipped_area(pairs.limit(0), ne, te).count() == 0


def test_union_clip_area_grows_with_the_polygons(spark, monkeypatch):
    """Polygons and tracts on one extent, then four times as many: the rows
    written grow no faster (the pairs that overlap are sixteen times as many),
    and the areas are those of the bands."""
    import random

    from parcelkit.operators import areal, union_area

    rng = random.Random(5)

    def star(cx, cy, r, n):
        at = [(r * rng.uniform(0.5, 1), 2 * math.pi * k / n) for k in range(n)]
        return [(cx + d * math.cos(w), cy + d * math.sin(w)) for d, w in at]

    def some(n, least, most):
        return [star(rng.uniform(0, 100), rng.uniform(0, 100), rng.uniform(least, most), rng.randint(3, 7)) for _ in range(n)]

    def layer(rings, first):
        schema = "gid long, part int, role string, ord int, x double, y double"
        return P.edges_from_vertices(spark.createDataFrame(
            [(g, 0, "shell", k, x, y) for g, r in enumerate(rings, first) for k, (x, y) in enumerate(r)], schema))

    written = []
    real = union_area.materialize

    def counted(df, name):
        out = real(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(union_area, "materialize", counted)

    def areas(nbs, tracts):
        written.clear()
        ne, te = layer(nbs, 1), layer(tracts, 1000)
        nm, tm = P.polygon_measures(ne), P.polygon_measures(te)
        ov = spatial.overlay_areas(ne, nm, te, tm)
        out = {r["b_gid"]: r["clipped_area"] for r in areal.clip_area(ov, ne, nm, te, overlaps=True).collect()}
        return out, sum(written)

    # A square on top, one that is equal to another, one far outside.
    square = [(20.0, 20.0), (60.0, 20.0), (60.0, 60.0), (20.0, 60.0)]
    nbs, tracts = [square, square, *some(10, 10, 30)], [*some(3, 20, 40), square, [(900.0, 0.0), (901.0, 0.0), (900.0, 1.0)]]
    got, _ = areas(nbs, tracts)
    for g, ring in enumerate(tracts[:4], 1000):
        assert got[g] == pytest.approx(_band_area(ring, nbs), rel=1e-9)
    assert 1004 not in got
    assert areas(nbs[:1], tracts[4:])[0] == {}
    few, many = (areas(some(n, 15, 25), some(n, 15, 25))[1] for n in (40, 160))
    assert many < 5 * few


def test_overlay_edge_pairs_grow_with_the_vertices(spark):
    """Two overlapping n-gons: four times the vertices, about four times the
    joined edge pairs, and the exact area throughout."""
    import math

    def ring(gid, cx, n):
        return [(gid, 0, "shell", k, cx + math.cos(2 * math.pi * k / n), math.sin(2 * math.pi * k / n)) for k in range(n)]
    schema = "gid long, part int, role string, ord int, x double, y double"
    counts = {}
    for n in (500, 2000):
        a, b = (P.edges_from_vertices(spark.createDataFrame(ring(g, c, n), schema)) for g, c in ((1, 0.0), (2, 0.7)))
        ma, mb = P.polygon_measures(a), P.polygon_measures(b)
        counts[n] = spatial.edge_pairs(a, ma, b, mb).count()
        got = spatial.overlay_areas(a, ma, b, mb).first()["inter_area"]
        lens = 2 * math.acos(0.35) - 0.35 * math.sqrt(4 - 0.49)
        assert abs(got - lens) < 30 / n ** 2
    assert counts[2000] < 5 * counts[500]


def test_nearest_keeps_points_without_a_coordinate(spark):
    schema = "gid long, part int, role string, ord int, x double, y double"
    sq = [(1, 0, "shell", k, x, y) for k, (x, y) in enumerate(((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)))]
    e = P.edges_from_vertices(spark.createDataFrame(sq, schema))
    pts = spark.createDataFrame([(1, 5000.5, 0.5), (2, None, 1.0), (3, 0.5, 0.5)], "pid long, x double, y double")
    got = {r["pid"]: r["dist"] for r in spatial.nearest_polygon(pts, e).collect()}
    assert got == {1: 4999.5, 2: None, 3: 0.0}


SHAPES = "gid long, part int, role string, ord int, x double, y double"


def _square(gid, x, y, side):
    return [(gid, 0, "shell", k, x + dx * side, y + dy * side) for k, (dx, dy) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1)))]


def _mixed_layer(spark, n):
    """n squares: a few large ones, and towns of ever smaller ones."""
    rows, gid = [], 0
    for k in range(16):
        rows += _square(gid, 4096.0 * (k % 4), 4096.0 * (k // 4), 4096.0)
        gid += 1
    town = int((n - 16) ** 0.5 / 2)
    for tx, ty, side in ((100.0, 100.0, 8.0), (9000.0, 300.0, 2.0), (500.0, 9000.0, 0.5), (12000.0, 12000.0, 0.25)):
        for i in range(town):
            for j in range(town):
                rows += _square(gid, tx + i * side, ty + j * side, side)
                gid += 1
    return P.edges_from_vertices(spark.createDataFrame(rows, SHAPES)), gid


def test_candidates_per_point_stay_flat(spark):
    """Mixed sizes side by side: the entries that a point in a town is tested
    against do not grow with the layer, nor do a polygon's entries."""
    seen = {}
    for n in (400, 6400):
        edges, size = _mixed_layer(spark, n)
        index = spatial.PipIndex(edges)
        town = int((n - 16) ** 0.5 / 2)
        pts = [(i, tx + side * town * ((i * 7919) % 997) / 997, ty + side * town * ((i * 104729) % 991) / 991)
               for tx, ty, side in ((100.0, 100.0, 8.0), (9000.0, 300.0, 2.0), (500.0, 9000.0, 0.5), (12000.0, 12000.0, 0.25))
               for i in range(250)]
        p = index.locate(spark.createDataFrame(pts, "pid long, x double, y double"), "x", "y", 1 << 26, False)
        r = p.join(index.cells, F.expr("_plv = _lv AND _pcx = _cx AND _pcy = _cy")).agg(
            F.count("*").alias("n"), F.avg(F.size("_in") + F.size("_rim")).alias("c"),
            F.max(F.expr("aggregate(_rim, 0, (s, r) -> s + size(r.edges))")).alias("e")).first()
        seen[n] = (r["c"], index.n_entries / size)
        assert r["n"] == 1000 and r["e"] <= 40
    assert seen[6400][0] < 1.5 * seen[400][0] and seen[6400][0] < 6
    assert seen[6400][1] < 1.5 * seen[400][1]


def test_index_grows_with_the_boundary(spark):
    """A star of 10,000 vertices beside small squares: each of its cells keeps
    only the edges inside, and its entries grow with its boundary."""
    counts = {}
    for n in (2500, 10_000):
        star = [(1, 0, "shell", k, (900 + 90 * (k % 2)) * math.cos(2 * math.pi * k / n),
                 (900 + 90 * (k % 2)) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        e = P.edges_from_vertices(spark.createDataFrame(star + _square(2, 2000.0, 0.0, 1.0), SHAPES))
        index = spatial.PipIndex(e)
        counts[n] = index.n_entries
        length = n * 90 / (990 * 2) * (n / 16)  # boundary in cells of its own level, about
        assert index.n_edges < 3 * (length + n)
        pts = [(i, -1000 + 2000 * ((i * 7919) % 9973) / 9973, -1000 + 2000 * ((i * 104729) % 9967) / 9967) for i in range(1500)]
        got = {r["pid"] for r in spatial.pip_join(spark.createDataFrame(pts, "pid long, x double, y double"), index,
                                                  None, how="inner").filter("gid = 1").collect()}
        ring = [(x, y) for *_, x, y in star]
        sure = {i: _brute_inside([ring], x, y) for i, x, y in pts}
        assert got == {i for i, s in sure.items() if s}


def test_points_on_shared_lines_and_vertices(spark):
    """Integer shapes and points: on edges, on vertices, level with vertices,
    outside the layer, without a coordinate."""
    e = P.edges_from_vertices(spark.createDataFrame(
        _square(1, 0.0, 0.0, 8.0) + [(2, 0, "shell", k, float(x), float(y)) for k, (x, y) in
                                     enumerate([(8, 0), (16, 0), (12, 4), (16, 8), (8, 8)])]
        + [(1, 0, "hole", k, float(x), float(y)) for k, (x, y) in enumerate([(4, 2), (6, 4), (4, 6), (2, 4)])], SHAPES))
    pts = [(i * 100 + j, float(i), float(j)) for i in range(-2, 19) for j in range(-2, 11)]
    pts += [(-1, None, 3.0), (-2, float("nan"), 3.0), (-3, 1e300, -1e300), (-4, float("inf"), 0.0)]
    df = spark.createDataFrame(pts, "pid long, x double, y double")

    def inside(gid, x, y):
        if gid == 1:
            return 0 < x < 8 and 0 < y < 8 and abs(x - 4) + abs(y - 4) > 2
        return 0 < y < 8 and 8 < x and x < 12 + abs(y - 4)

    def touches(gid, x, y):
        if gid == 1:
            return 0 <= x <= 8 and 0 <= y <= 8 and abs(x - 4) + abs(y - 4) >= 2
        return 0 <= y <= 8 and 8 <= x and x <= 12 + abs(y - 4)

    for cell in (None, 0.7, 3.0):
        for predicate, rule in (("within", inside), ("intersects", touches)):
            got = {(r["pid"], r["gid"]) for r in spatial.pip_join(df, e, None, how="inner", predicate=predicate, cell=cell).collect()}
            assert got == {(i, g) for i, x, y in pts[:-4] for g in (1, 2) if rule(g, x, y)}
    assert spatial.pip_join(df, e).count() >= len(pts)


def test_candidate_pairs_of_unlike_boxes(spark):
    """One huge box over many small ones: cells per box stay bounded, and the
    pairs are those whose boxes touch, once each."""
    schema = "gid long, xmin double, ymin double, xmax double, ymax double"
    boxes = [(i, x, y, x + s, y + s) for i in range(300)
             for x, y, s in [((i * 37) % 101 - 50.5, (i * 53) % 97 - 40.25, 0.25 * (1 + i % 7))]]
    boxes += [(900, -5e5, -5e5, 5e5, 5e5), (901, 3.0, 3.0, 3.0, 3.0), (902, -60.0, -60.0, 20.0, 0.5)]
    m = spark.createDataFrame(boxes, schema)
    got = [(r["a_gid"], r["b_gid"]) for r in spatial.candidate_pairs(m, m).collect()]
    want = {(a[0], b[0]) for a in boxes for b in boxes
            if a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]}
    assert len(got) == len(set(got)) and set(got) == want
    cells = spatial._box_cells(spatial._boxes(m, "a_", None), "a_", F.col("a_own")).groupBy("a_gid").count()
    assert cells.agg(F.max("count")).first()[0] <= 4


def test_far_points_meet_few_edges(spark, monkeypatch):
    """A point far outside a layer meets the edges about as near as its
    nearest, not all edges of the layer; distances are those of all pairs."""
    squares = [v for i in range(20) for j in range(20) for v in _square(20 * i + j, 30.0 * i, 30.0 * j, 10.0)]
    e = P.edges_from_vertices(spark.createDataFrame(squares, SHAPES)).persist()
    pts = [(k, 700.0 + 97.0 * k * k, 3000.0 - 71.0 * k * k) for k in range(40)] + [(100 + k, 25.0 + 15 * k, 12.5 * k) for k in range(20)]
    df = spark.createDataFrame(pts, "pid long, x double, y double")
    met = []
    inner = spatial.broadcast_if_bounded

    def counted(table, *a):
        if "x1" in table.columns:
            met.append(table)
        return inner(table, *a)

    monkeypatch.setattr(spatial, "broadcast_if_bounded", counted)
    got = {(r.pid, r.gid): r.dist for r in spatial.nearest_polygon(df, e).collect()}
    rects = [(g, 30.0 * (g // 20), 30.0 * (g % 20)) for g in range(400)]
    want = {}
    for pid, x, y in pts:
        d = {g: math.hypot(max(a - x, 0, x - a - 10), max(b - y, 0, y - b - 10)) for g, a, b in rects}
        want.update({(pid, g): v for g, v in d.items() if v == min(d.values())})
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert met and met[-1].count() < 1600 / 4   # edges left to compare with, of 1600


def test_overlapping_polygons_spread_their_points(spark):
    """Points of one partition that lie in many polygons go out in many."""
    many = P.edges_from_vertices(spark.createDataFrame([v for g in range(12) for v in _square(g, 0.0, 0.0, 10.0 + g)], SHAPES))
    one = P.edges_from_vertices(spark.createDataFrame(_square(1, 0.0, 0.0, 10.0), SHAPES))
    pts = spark.range(300).select(F.col("id").alias("pid"), (F.col("id") % 9 + 0.5).alias("x"), F.lit(5.5).alias("y")).coalesce(1)
    out = spatial.pip_join(pts, spatial.PipIndex(many), None)
    assert out.count() == 300 * 12
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert spatial.pip_join(pts, spatial.PipIndex(one), None).rdd.getNumPartitions() == 1   # no shuffle where a hit is one row
