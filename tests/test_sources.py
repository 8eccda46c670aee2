"""Round trips of the geometry sources and sinks on the hard-case shapes."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from parcelkit.functions import geom as G
from parcelkit.operators import polygons as P
from parcelkit.session import ensure_checkpoint_dir
from parcelkit.sources import geo_io, paged


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


def _areas(v):
    return {r["gid"]: round(r["area"], 6) for r in P.polygon_measures(P.edges_from_vertices(v)).collect()}


def test_wkb_round_trip_multipart_and_holes(spark, zones):
    v = zones.withColumn("ring", F.lit(0)).withColumn("gid", F.col("gid").cast("long"))
    w = geo_io.to_wkb(v)
    types = {r["gid"]: r["t"] for r in w.select("gid", geo_io.geometry_type_from_wkb("wkb").alias("t")).collect()}
    assert types == {1: "Polygon", 2: "Polygon", 3: "MultiPolygon", 4: "Polygon"}
    back = geo_io.from_wkb(w)
    assert _areas(back) == _areas(v)


def test_geojson_sequence_and_collection(spark, zones):
    v = zones.withColumn("ring", F.lit(0)).withColumn("gid", F.col("gid").cast("long"))
    feats = v.select("gid").distinct().withColumn("label", F.concat(F.lit("zone "), F.col("gid").cast("string")))
    path = _scratch(spark, "gj")
    geo_io.write_geojson_seq(feats, geo_io.polygons_geojson_geometry(v), path, ["gid", "label"])
    back = geo_io.read_geojson(spark, path, "gid BIGINT, label STRING")
    assert _areas(geo_io.geojson_vertices(back)) == _areas(v)
    # the same features as one FeatureCollection document
    lines = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    doc = _scratch(spark, "fc")
    os.makedirs(doc)
    with open(os.path.join(doc, "layer.geojson"), "w") as f:
        json.dump({"type": "FeatureCollection", "features": lines}, f)
    fc = geo_io.read_geojson(spark, doc, "gid BIGINT, label STRING", feature_collection=True)
    assert _areas(geo_io.geojson_vertices(fc)) == _areas(v)


def test_paged_source_partitions_and_empty_pages(spark):
    root = _scratch(spark, "pages")
    df = spark.range(0, 4500).select(F.col("id").alias("pid"), (F.col("id") * 2.0).alias("v"))
    paged.stage_pages(df, "pid", root, page=1000)
    out = paged.read_paged(spark, "pid BIGINT, v DOUBLE", root=root)
    assert out.rdd.getNumPartitions() == 5
    assert out.count() == 4500 and out.agg(F.sum("v")).first()[0] == sum(i * 2.0 for i in range(4500))


def test_ensure_crs_sets_then_transforms(spark):
    df = spark.createDataFrame([(-77.4360, 37.5407)], "x double, y double")
    a = G.ensure_crs(df, "x", "y", 4326)
    assert G.srid_of(a) == 4326 and a.first()["x"] == -77.4360
    b = G.ensure_crs(a, "x", "y", 5070)
    r = b.first()
    assert G.srid_of(b) == 5070 and r["x"] == pytest.approx(1614463.213, abs=1e-3)


def test_paged_source_pushdown(spark):
    root = _scratch(spark, "pages-push")
    df = spark.range(0, 3000).select(F.col("id").alias("pid"), (F.col("id") % 7).cast("string").alias("k"))
    paged.stage_pages(df, "pid", root, page=1000)
    out = paged.read_paged(spark, "pid BIGINT, k STRING", pushdown=True, root=root).filter(
        (F.col("pid") >= 1500) & F.col("k").isin("1", "3"))
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain("formatted")
    assert "PushedFilters" in buf.getvalue() and "GreaterThanOrEqual(pid,1500)" in buf.getvalue()
    rows = out.collect()
    assert sorted(r["pid"] for r in rows) == [i for i in range(1500, 3000) if i % 7 in (1, 3)]


def test_paged_source_loses_nothing_unseen(spark):
    root = _scratch(spark, "pages-bad")
    df = spark.range(0, 300).select(F.col("id").alias("pid"))
    paged.stage_pages(df.filter("pid % 7 <> 3"), "pid", root, page=100)  # gaps are no loss
    out = paged.read_paged(spark, "pid BIGINT", root=root)
    assert out.count() == df.filter("pid % 7 <> 3").count()
    # a page that is too long, and one that is gone
    part = os.path.join(root, "page=100")
    spark.range(100, 250).select(F.col("id").alias("pid")).coalesce(1).write.mode("append").parquet(part)
    with pytest.raises(Exception, match="manifest"):
        out.count()
    os.rename(part, os.path.join(root, "_lost"))
    with pytest.raises(Exception, match="manifest"):
        paged.read_paged(spark, "pid BIGINT", root=root).count()
    with pytest.raises(paged.PageError, match="service error"):
        paged._answer({"error": {"code": 500}})
    with pytest.raises(paged.PageError, match="repeat"):
        paged.stage_pages(df.union(df), "pid", _scratch(spark, "pages-dup"), page=100)


def test_checkpoint_folder_must_be_shared_off_a_local_master():
    from types import SimpleNamespace

    from parcelkit import session
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)


def test_wkb_dimensions_flags_and_types(spark):
    import struct
    sq = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]

    def poly(code, extra=(), srid=None, order="<"):
        head = struct.pack(order + "BI", order == "<", code) + (struct.pack(order + "I", srid) if srid else b"")
        return head + struct.pack(order + "II", 1, 5) + b"".join(struct.pack(f"{order}{2 + len(extra)}d", *p, *extra) for p in sq)

    def point(x, y, code=1):
        return struct.pack("<BIdd", 1, code, x, y)
    rows = [(1, poly(3)), (2, poly(1003, (7.0,))), (3, poly(3003, (7.0, 8.0))), (4, poly(0x80000003, (7.0,))),
            (5, poly(0x20000003, srid=4326)), (6, poly(0xE0000003, (7.0, 8.0), srid=4326)), (7, poly(3, order=">")),
            (8, struct.pack("<BII", 1, 4, 2) + point(1.0, 2.0) + point(3.0, 4.0)), (9, point(5.0, 6.0)),
            (10, point(float("nan"), float("nan"))), (11, None)]
    df = spark.createDataFrame([(g, bytearray(b) if b else None) for g, b in rows], "gid long, wkb binary")
    got = {}
    for r in geo_io.from_wkb(df).orderBy("gid", "part", "ord").collect():
        got.setdefault(r["gid"], []).append((r["x"], r["y"]))
    assert got == {**{i: sq[:4] for i in range(1, 8)}, 8: [(1.0, 2.0), (3.0, 4.0)], 9: [(5.0, 6.0)]}
    types = {r["gid"]: r["t"] for r in df.select("gid", geo_io.geometry_type_from_wkb("wkb").alias("t")).collect()}
    assert types == {**{i: "Polygon" for i in range(1, 8)}, 8: "MultiPoint", 9: "Point", 10: "Point", 11: None}
    line = spark.createDataFrame([(1, bytearray(struct.pack("<BIIdddd", 1, 2, 2, 0, 0, 1, 1)))], "gid long, wkb binary")
    with pytest.raises(Exception, match="not handled"):
        geo_io.from_wkb(line).collect()


def test_geojson_points_and_missing_geometry(spark):
    pts = spark.createDataFrame([(1, 1.5, 2.5), (2, None, 3.0)], "gid long, x double, y double")
    path = _scratch(spark, "gj-points")
    geo_io.write_geojson_seq(pts, geo_io.points_geojson_geometry(pts), path, ["gid"])
    back = geo_io.read_geojson(spark, path, "gid BIGINT")
    assert back.count() == 2
    assert [(r["gid"], r["role"], r["x"], r["y"]) for r in geo_io.geojson_vertices(back).collect()] == [(1, "point", 1.5, 2.5)]
    multi = spark.createDataFrame([(3, "MultiPoint", "[[1,2,9],[3,4,9]]")], "gid long, gtype string, coordinates string")
    assert [(r["part"], r["x"], r["y"]) for r in geo_io.geojson_vertices(multi).collect()] == [(0, 1.0, 2.0), (1, 3.0, 4.0)]
    with pytest.raises(Exception, match="not handled"):
        geo_io.geojson_vertices(spark.createDataFrame([(1, "LineString", "[]")], "gid long, gtype string, coordinates string")).collect()


def test_packed_csv(spark, tmp_path, monkeypatch):
    """Packed files hold the same rows in less space and a bounded number of rows each."""
    monkeypatch.setattr(geo_io, "CSV_ROWS", 4000)
    df = spark.range(10000).selectExpr("id div 1000 AS pid", "concat('tract ', id % 100) AS name",
                                       "CASE WHEN id % 7 > 0 THEN id % 100 / 8 END AS v").coalesce(1)
    sizes = {}
    for packed in (False, True):
        path = str(tmp_path / str(packed))
        geo_io.write_csv(df, path, packed=packed)
        files = list((tmp_path / str(packed)).glob("part-*"))
        sizes[packed] = sum(f.stat().st_size for f in files)
        back = geo_io.read_csv_points(spark, path, "pid BIGINT, name STRING, v DOUBLE")
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert len(files) == 3 and sizes[True] < sizes[False] / 5
