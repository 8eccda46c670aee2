"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and the
DuckDB oracle text ``ORACLE[name]`` (omitted for non-SQL operators).

Every query reads the driver tables through the fixture views and runs
over the whole tables. Doubles that are sums in engine-dependent order are
rounded (areas 3 decimals, ratios 6) in both formulations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as X
from ..functions import geom as G
from ..functions import schema as S
from ..operators import spatial, summary
from ..session import materialize, session_key
from ..sources.fixtures import with_views
from . import inputs
from . import oracle_sql as O
from .inputs import CUR_YEAR
from .workflows import house_master_join, imputed_columns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


H = "fx_house"
NBH = ["fx_nbh", "fx_nbh_node", "fx_nbh_edge"]
TR = ["fx_tract", "fx_tract_node", "fx_tract_edge"]

# ======================================================= step 1: cleaning

HARMONISE_MAP = {
    "tract_id": (list(S.ROLES["tract_id"].names), "string"),
    "name": (["NAME", "Name", "name"], "string"),
    "total": (list(S.ROLES["race_total"].names), "double"),
    "hipi": (list(S.ROLES["race_hipi"].names), "double"),
    "weight": (list(S.ROLES["weight"].names), "double"),
    "pct_asian": (["Pasian"], "double"),
}


@register("harmonise", with_views(["fx_tract"], """
SELECT CAST(GEOID AS VARCHAR) AS tract_id, CAST(NAME AS VARCHAR) AS name, CAST(totalE AS DOUBLE) AS total,
       CAST(HIPIE AS DOUBLE) AS hipi, CAST(Households AS DOUBLE) AS weight, CAST(NULL AS DOUBLE) AS pct_asian
FROM fx_tract"""))
def q_harmonise(spark, sf):
    t = inputs.tracts(spark, sf).attrs
    return S.harmonise(t, HARMONISE_MAP)


@register("status_norm", with_views([H], f"""
SELECT pid, {O.status('bothsidesstatus')} AS bothsidesstatus_cat, {O.status('utilmaterial')} AS utilmaterial_cat,
       {O.status('custmaterial')} AS custmaterial_cat FROM fx_house"""))
def q_status_norm(spark, sf):
    h = inputs.houses(spark, sf)
    return h.select("pid", X.normalize_status("bothsidesstatus").alias("bothsidesstatus_cat"),
                    X.normalize_status("utilmaterial").alias("utilmaterial_cat"),
                    X.normalize_status("custmaterial").alias("custmaterial_cat"))


@register("material_norm", with_views([H], f"""
SELECT pid, {O.material('custmaterial')} AS custmaterial_cat, {O.material('utilmaterial')} AS utilmaterial_cat
FROM fx_house"""))
def q_material_norm(spark, sf):
    h = inputs.houses(spark, sf)
    return h.select("pid", X.normalize_material("custmaterial").alias("custmaterial_cat"),
                    X.normalize_material("utilmaterial").alias("utilmaterial_cat"))


@register("both_norm", with_views([H], f"""
SELECT pid, {O.both('bothsidesstatus')} AS bothsidesstatus_cat FROM fx_house"""))
def q_both_norm(spark, sf):
    h = inputs.houses(spark, sf)
    return h.select("pid", X.normalize_both("bothsidesstatus").alias("bothsidesstatus_cat"))


IMPUTED_CTE = f"""imp0 AS (
  SELECT *, {O.material('custmaterial')} AS custmaterial_cat, {O.material('utilmaterial')} AS utilmaterial_cat,
         {O.both('bothsidesstatus')} AS bothsidesstatus_cat FROM fx_house),
imp1 AS (
  SELECT *, {O.impute('custmaterial_cat', 'ModelClassification_Cust')} AS custmaterial_cat_imputed,
         {O.impute('utilmaterial_cat', 'ModelClassification_City')} AS utilmaterial_cat_imputed FROM imp0),
imp AS (SELECT *, {O.combine('custmaterial_cat_imputed', 'utilmaterial_cat_imputed')} AS bothsidesstatus_imputed FROM imp1)"""


def _with_imp(body: str, extra=()) -> str:
    w = with_views([H, *extra], "")
    return w.rstrip() + ",\n" + IMPUTED_CTE + "\n" + body


@register("impute_material", _with_imp("""
SELECT pid, custmaterial_cat_imputed, utilmaterial_cat_imputed FROM imp"""))
def q_impute_material(spark, sf):
    return imputed_columns(inputs.houses(spark, sf)).select(
        "pid", "custmaterial_cat_imputed", "utilmaterial_cat_imputed")


@register("impute_bothsides", _with_imp("""
SELECT pid, bothsidesstatus_imputed FROM imp"""))
def q_impute_bothsides(spark, sf):
    return imputed_columns(inputs.houses(spark, sf)).select("pid", "bothsidesstatus_imputed")


@register("valid_year_rules", with_views([H], f"""
SELECT pid, y AS year_num,
       CASE WHEN y IS NULL THEN NULL WHEN y BETWEEN 1800 AND {CUR_YEAR} THEN 1 ELSE 0 END AS valid_a,
       CASE WHEN y IS NULL THEN NULL WHEN y > 0 AND y <= {CUR_YEAR} THEN 1 ELSE 0 END AS valid_b,
       CASE WHEN y > 0 AND y <= {CUR_YEAR} THEN y END AS year_clean,
       CASE WHEN y > 0 AND y <= {CUR_YEAR} THEN {CUR_YEAR}e0 - y END AS age_years
FROM (SELECT pid, {O.num('yearstructbuilt')} AS y FROM fx_house) t"""))
def q_valid_year_rules(spark, sf):
    h = inputs.houses(spark, sf)
    y = X.to_double("yearstructbuilt")
    yc = X.clean_year("yearstructbuilt", CUR_YEAR)
    return h.select("pid", y.alias("year_num"),
                    X.year_valid(y, CUR_YEAR, "a").cast("int").alias("valid_a"),
                    X.year_valid(y, CUR_YEAR, "b").cast("int").alias("valid_b"),
                    yc.alias("year_clean"), (F.lit(float(CUR_YEAR)) - yc).alias("age_years"))


# =============================================== step 2: geometry + PIP

# Fixture metres are read as 1e-5 degree offsets around a fixed centre, so the
# projection query runs over every house with realistic coordinates.
# Fixed value: the maps' fallback centre (lon, lat).
CENTRE_LON, CENTRE_LAT = -77.4360, 37.5407


def _lonlat(h: DataFrame) -> DataFrame:
    return h.select("pid", (F.lit(CENTRE_LON) + F.col("x") * F.lit(1e-5)).alias("lon"),
                    (F.lit(CENTRE_LAT) + F.col("y") * F.lit(1e-5)).alias("lat"))


_ax, _ay = O.albers_forward("lon", "lat")
_mx, _my = O.mercator_forward("lon", "lat")


@register("project_points", with_views([H], f"""
SELECT pid, round(lon, 9) AS lon, round(lat, 9) AS lat, round({_ax}, 3) AS albers_x, round({_ay}, 3) AS albers_y,
       round({_mx}, 3) AS merc_x, round({_my}, 3) AS merc_y
FROM (SELECT pid, {O.dbl(CENTRE_LON)} + x * 1e-5 AS lon, {O.dbl(CENTRE_LAT)} + y * 1e-5 AS lat FROM fx_house) t"""))
def q_project_points(spark, sf):
    p = _lonlat(inputs.houses(spark, sf))
    a = G.transform_xy("lon", "lat", 4326, 5070)
    m = G.transform_xy("lon", "lat", 4326, 3857)
    return p.select("pid", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"),
                    F.round(a["x"], 3).alias("albers_x"), F.round(a["y"], 3).alias("albers_y"),
                    F.round(m["x"], 3).alias("merc_x"), F.round(m["y"], 3).alias("merc_y"))


def _measure_sql(edge_view: str, layer: str) -> str:
    return f"""SELECT '{layer}' AS layer, gid, xmin, ymin, xmax, ymax, round(a, 3) AS area,
       round(xmin + sx / (6 * a), 6) AS cx, round(ymin + sy / (6 * a), 6) AS cy
FROM (SELECT e.gid, b.xmin, b.ymin, b.xmax, b.ymax,
             sum((x1 - b.xmin) * (y2 - b.ymin) - (x2 - b.xmin) * (y1 - b.ymin)) / 2 AS a,
             sum(((x1 - b.xmin) + (x2 - b.xmin)) * ((x1 - b.xmin) * (y2 - b.ymin) - (x2 - b.xmin) * (y1 - b.ymin))) AS sx,
             sum(((y1 - b.ymin) + (y2 - b.ymin)) * ((x1 - b.xmin) * (y2 - b.ymin) - (x2 - b.xmin) * (y1 - b.ymin))) AS sy
      FROM {edge_view} e JOIN (SELECT gid, min(x1) AS xmin, min(y1) AS ymin, max(x1) AS xmax, max(y1) AS ymax
                               FROM {edge_view} GROUP BY gid) b ON e.gid = b.gid
      GROUP BY e.gid, b.xmin, b.ymin, b.xmax, b.ymax) m"""


def _measures_df(layer: inputs.Layer, name: str) -> DataFrame:
    m = layer.measures
    return m.select(F.lit(name).alias("layer"), "gid", "xmin", "ymin", "xmax", "ymax",
                    F.round("area", 3).alias("area"), F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@register("polygon_measures", with_views(NBH + TR, _measure_sql("fx_nbh_edge", "nbh") + "\nUNION ALL\n"
                                          + _measure_sql("fx_tract_edge", "tract")))
def q_polygon_measures(spark, sf):
    return _measures_df(inputs.neighborhoods(spark, sf), "nbh").unionByName(
        _measures_df(inputs.tracts(spark, sf), "tract"))


@register("centroids", with_views(NBH, f"""
SELECT m.gid, n.name, m.cx, m.cy FROM ({_measure_sql('fx_nbh_edge', 'nbh')}) m JOIN fx_nbh n ON n.gid = m.gid"""))
def q_centroids(spark, sf):
    nb = inputs.neighborhoods(spark, sf)
    return (_measures_df(nb, "nbh").join(nb.attrs, "gid").select("gid", "name", "cx", "cy"))


@register("layer_extent", with_views(NBH + TR, """
SELECT layer, xmin, ymin, xmax, ymax, (xmin + xmax) / 2 AS centre_x, (ymin + ymax) / 2 AS centre_y FROM (
  SELECT 'nbh' AS layer, min(x1) AS xmin, min(y1) AS ymin, max(x1) AS xmax, max(y1) AS ymax FROM fx_nbh_edge
  UNION ALL SELECT 'tract', min(x1), min(y1), max(x1), max(y1) FROM fx_tract_edge
  UNION ALL SELECT 'all', min(x1), min(y1), max(x1), max(y1) FROM (
      SELECT x1, y1 FROM fx_nbh_edge UNION ALL SELECT x1, y1 FROM fx_tract_edge) u) t"""))
def q_layer_extent(spark, sf):
    nb, tr = inputs.neighborhoods(spark, sf), inputs.tracts(spark, sf)
    m = (nb.measures.withColumn("layer", F.lit("nbh"))
         .unionByName(tr.measures.withColumn("layer", F.lit("tract"))))
    per = m.groupBy("layer").agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                                 F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
    allx = per.agg(F.lit("all").alias("layer"), F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                   F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
    u = per.unionByName(allx)
    return u.withColumn("centre_x", (F.col("xmin") + F.col("xmax")) / 2).withColumn(
        "centre_y", (F.col("ymin") + F.col("ymax")) / 2)


PTS_CTE = "pts AS (SELECT pid, x, y FROM fx_house)"


@register("pip_left_join", with_views([H] + NBH, f""", {PTS_CTE}
SELECT p.pid, i.gid FROM pts p LEFT JOIN ({O.pip_pairs('pts', 'fx_nbh_edge', 'within')}) i ON p.pid = i.pid"""))
def q_pip_left_join(spark, sf):
    nb = inputs.neighborhoods(spark, sf)
    h = inputs.houses(spark, sf).select("pid", "x", "y")
    return spatial.pip_join(h, nb.index, None, predicate="within", how="left").select("pid", "gid")


@register("pip_boundary", with_views([H] + TR, f""", {PTS_CTE}
SELECT p.pid, i.gid FROM pts p LEFT JOIN ({O.pip_pairs('pts', 'fx_tract_edge', 'intersects')}) i ON p.pid = i.pid"""))
def q_pip_boundary(spark, sf):
    tr = inputs.tracts(spark, sf)
    h = inputs.houses(spark, sf).select("pid", "x", "y")
    return spatial.pip_join(h, tr.index, None, predicate="intersects", how="left").select("pid", "gid")


def houses_in_neighborhoods(spark, sf, predicate="within") -> DataFrame:
    nb = inputs.neighborhoods(spark, sf)
    h = inputs.houses(spark, sf)
    return spatial.pip_join(h, nb.index, nb.attrs.select("gid", "name"), predicate=predicate, how="left")


def _lead_summary(joined: DataFrame) -> DataFrame:
    src = S.column(joined, "status")
    status = X.normalize_status(src) if src else F.lit(X.UNKNOWN)
    ycol = S.column(joined, "year")
    year = X.to_double(ycol) if ycol else None
    return summary.lead_by_group(joined, "name", status, year, CUR_YEAR)


LEAD_SQL = f""", {PTS_CTE.replace('SELECT pid, x, y', 'SELECT pid, x, y, ' + O.status('bothsidesstatus') + ' AS status, ' + O.num('yearstructbuilt') + ' AS yr')},
inpoly AS ({O.pip_pairs('pts', 'fx_nbh_edge', 'within')}),
g AS (
  SELECT n.name, count(*) FILTER (WHERE status = 'Lead') AS "Lead", count(*) FILTER (WHERE status = 'Non-Lead') AS "Non-Lead",
         count(*) FILTER (WHERE status = 'Unknown') AS "Unknown",
         avg(CASE WHEN yr BETWEEN 1800 AND {CUR_YEAR} THEN yr END) AS avg_year_built,
         count(CASE WHEN yr BETWEEN 1800 AND {CUR_YEAR} THEN yr END) AS ny
  FROM pts p JOIN inpoly i ON p.pid = i.pid JOIN fx_nbh n ON n.gid = i.gid GROUP BY n.name)
SELECT name, "Lead", "Non-Lead", "Unknown", "Lead" + "Non-Lead" + "Unknown" AS total_points, "Lead" + "Non-Lead" AS known_points,
  CASE WHEN "Lead" + "Non-Lead" + "Unknown" > 0 THEN "Lead" / ("Lead" + "Non-Lead" + "Unknown") ELSE 0e0 END AS pct_lead_total,
  CASE WHEN "Lead" + "Non-Lead" + "Unknown" > 0 THEN "Non-Lead" / ("Lead" + "Non-Lead" + "Unknown") ELSE 0e0 END AS pct_nonlead_total,
  CASE WHEN "Lead" + "Non-Lead" + "Unknown" > 0 THEN "Unknown" / ("Lead" + "Non-Lead" + "Unknown") ELSE 0e0 END AS pct_unknown,
  CASE WHEN "Lead" + "Non-Lead" > 0 THEN "Lead" / ("Lead" + "Non-Lead") ELSE 0e0 END AS pct_lead_known,
  CASE WHEN "Lead" + "Non-Lead" > 0 THEN "Non-Lead" / ("Lead" + "Non-Lead") ELSE 0e0 END AS pct_nonlead_known,
  avg_year_built, nullif(ny, 0) AS count_year_samples, {CUR_YEAR}e0 - avg_year_built AS avg_house_age
FROM g"""
# the same summary as a CTE named ``ls`` for queries built on it
LEAD_CTES = LEAD_SQL.replace('\nSELECT name, "Lead"', ',\nls AS (SELECT name, "Lead"', 1) + ")"


@register("lead_by_neighborhood", with_views([H] + NBH, LEAD_SQL))
def q_lead_by_neighborhood(spark, sf):
    return _lead_summary(houses_in_neighborhoods(spark, sf))


# ========================================== step 3: overlay + match table

def match_table_df(spark, sf) -> DataFrame:
    from ..operators import areal
    nb, tr = inputs.neighborhoods(spark, sf), inputs.tracts(spark, sf)
    tid = S.column(tr.attrs, "tract_id")
    return areal.match_table(nb.edges, nb.measures, nb.attrs.select("gid", F.col("name").alias("neighborhood")),
                             tr.edges, tr.measures, tr.attrs.select("gid", F.col(tid).cast("string").alias("tract_id")),
                             overlay=inputs.overlay(spark, sf))


MATCH_CTES = f""", {O.overlay_ctes('fx_nbh_edge', 'fx_tract_edge', 'ov')},
mt AS (SELECT n.name AS neighborhood, CAST(t.GEOID AS VARCHAR) AS tract_id, o.inter_area AS intersection_area_m2,
              a.area AS neighborhood_area_m2, b.area AS tract_area_m2,
              CASE WHEN a.area > 0 THEN o.inter_area / a.area ELSE 0e0 END AS frac_of_neighborhood,
              CASE WHEN b.area > 0 THEN o.inter_area / b.area ELSE 0e0 END AS frac_of_tract
       FROM ov o JOIN ov_pa a ON a.gid = o.a_gid JOIN ov_pb b ON b.gid = o.b_gid
       JOIN fx_nbh n ON n.gid = o.a_gid JOIN fx_tract t ON t.gid = o.b_gid)"""


@register("match_table", with_views(NBH + TR, MATCH_CTES + """
SELECT neighborhood, tract_id, round(intersection_area_m2, 3) AS intersection_area_m2,
       round(neighborhood_area_m2, 3) AS neighborhood_area_m2, round(tract_area_m2, 3) AS tract_area_m2,
       round(frac_of_neighborhood, 6) AS frac_of_neighborhood, round(frac_of_tract, 6) AS frac_of_tract
FROM mt ORDER BY neighborhood, frac_of_neighborhood DESC"""))
def q_match_table(spark, sf):
    from ..operators import areal
    m = areal.sort_matches(match_table_df(spark, sf))
    return m.select("neighborhood", "tract_id",
                    *[F.round(c, 3).alias(c) for c in ("intersection_area_m2", "neighborhood_area_m2", "tract_area_m2")],
                    *[F.round(c, 6).alias(c) for c in ("frac_of_neighborhood", "frac_of_tract")])


RACE_KEYS = ["white", "black", "hispanic", "asian", "native", "hipi"]
RACE_SRC = {"total": "totalE", "white": "WhiteE", "black": "BlackE", "hispanic": "HispanicE",
            "asian": "AsianE", "native": "NativeE", "hipi": "HIPIE"}


def _r6(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[F.round(c, 6).alias(c) for c in df.columns if c != key])


@register("race_from_matches", with_views(NBH + TR, MATCH_CTES + ",\nj AS (SELECT m.neighborhood, m.frac_of_tract AS f, "
                                            + ", ".join(f"t.{v}" for v in RACE_SRC.values()) + """
  FROM mt m LEFT JOIN fx_tract t ON m.tract_id = CAST(t.GEOID AS VARCHAR)),
g AS (SELECT neighborhood, sum(coalesce(CAST(totalE AS DOUBLE), 0) * coalesce(f, 0)) AS tot, """
                                            + ", ".join(f"sum(coalesce(CAST({RACE_SRC[k]} AS DOUBLE), 0) * coalesce(f, 0)) AS s_{k}"
                                                        for k in RACE_KEYS) + """
  FROM j GROUP BY neighborhood)
SELECT neighborhood AS name, """ + ", ".join(f"round(coalesce(s_{k} / nullif(tot, 0), 0), 6) AS pct_{k}" for k in RACE_KEYS)
                                            + " FROM g"))
def q_race_from_matches(spark, sf):
    from ..operators import areal
    tr = inputs.tracts(spark, sf).attrs
    counts = S.race_counts(tr)
    r = areal.race_shares_from_matches(match_table_df(spark, sf), tr, S.column(tr, "tract_id"), counts, "name")
    return _r6(r, "name")


@register("race_pct_fallback", with_views(NBH + TR, MATCH_CTES + """,
j AS (SELECT m.neighborhood, m.frac_of_tract AS f, t.Pwhite, t.Pblack
  FROM mt m LEFT JOIN fx_tract t ON m.tract_id = CAST(t.GEOID AS VARCHAR))
SELECT neighborhood AS name,
  round(sum(coalesce(Pwhite, 0) * coalesce(f, 0)) / greatest(sum(coalesce(f, 0)), 1e-9), 6) AS pct_white,
  round(sum(coalesce(Pblack, 0) * coalesce(f, 0)) / greatest(sum(coalesce(f, 0)), 1e-9), 6) AS pct_black
FROM j GROUP BY neighborhood"""))
def q_race_pct_fallback(spark, sf):
    from ..operators import areal
    tr = inputs.tracts(spark, sf).attrs
    pcols = S.columns(tr, "race_pct")
    r = areal.pct_fallback_from_matches(match_table_df(spark, sf), tr, S.column(tr, "tract_id"), pcols, "name")
    return _r6(r, "name")


INCOME_SQL = MATCH_CTES + """,
j AS (SELECT m.neighborhood, coalesce(m.frac_of_tract, 0) AS f, t.avg_income, CAST(t.Households AS DOUBLE) AS hh
  FROM mt m LEFT JOIN fx_tract t ON m.tract_id = CAST(t.GEOID AS VARCHAR))
SELECT neighborhood AS name,
  round(sum(coalesce(avg_income, 0) * {w}) / greatest(sum({w}), 1e-9), 6) AS avg_income
FROM j GROUP BY neighborhood"""


def _income(spark, sf, weighted: bool) -> DataFrame:
    from ..operators import areal
    tr = inputs.tracts(spark, sf).attrs
    inc = S.columns(tr, "income")
    w = S.column(tr, "weight") if weighted else None
    r = areal.weighted_mean_from_matches(match_table_df(spark, sf), tr, S.column(tr, "tract_id"), inc, w, "name")
    return _r6(r, "name")


@register("income_from_matches", with_views(NBH + TR, INCOME_SQL.format(w="coalesce(hh, 0) * f")))
def q_income_from_matches(spark, sf):
    return _income(spark, sf, True)


@register("income_area_only", with_views(NBH + TR, INCOME_SQL.format(w="f")))
def q_income_area_only(spark, sf):
    return _income(spark, sf, False)


@register("combined_full_join", with_views(NBH + TR, MATCH_CTES + ",\nj AS (SELECT m.neighborhood, m.frac_of_tract AS f, "
                                            + ", ".join(f"t.{v}" for v in RACE_SRC.values()) + """, t.avg_income, CAST(t.Households AS DOUBLE) AS hh
  FROM mt m LEFT JOIN fx_tract t ON m.tract_id = CAST(t.GEOID AS VARCHAR)),
g AS (SELECT neighborhood, sum(coalesce(CAST(totalE AS DOUBLE), 0) * coalesce(f, 0)) AS tot, """
                                            + ", ".join(f"sum(coalesce(CAST({RACE_SRC[k]} AS DOUBLE), 0) * coalesce(f, 0)) AS s_{k}"
                                                        for k in RACE_KEYS) + """
  FROM j GROUP BY neighborhood),
race AS (SELECT neighborhood AS name, """ + ", ".join(f"round(coalesce(s_{k} / nullif(tot, 0), 0), 6) AS pct_{k}" for k in RACE_KEYS)
                                            + """ FROM g),
inc AS (SELECT neighborhood AS name,
  round(sum(coalesce(avg_income, 0) * coalesce(hh, 0) * coalesce(f, 0)) / greatest(sum(coalesce(hh, 0) * coalesce(f, 0)), 1e-9), 6) AS avg_income
  FROM j GROUP BY neighborhood)
SELECT coalesce(race.name, inc.name) AS name, """ + ", ".join(f"pct_{k}" for k in RACE_KEYS) + """, avg_income
FROM race FULL OUTER JOIN inc ON race.name = inc.name"""))
def q_combined_full_join(spark, sf):
    race = q_race_from_matches(spark, sf)
    inc = _income(spark, sf, True)
    return race.join(inc, "name", "full")


# ============================== step 4: direct overlay, fallbacks, filter

from ..operators.areal import CITY_ID_PREFIX, CITY_NAME_PHRASE, LOOSE_ID_PREFIX  # noqa: E402

TIER_CTES = f""", tier AS (SELECT bool_or(CAST(GEOID AS VARCHAR) LIKE '{CITY_ID_PREFIX}%') AS ex,
                 bool_or(CAST(GEOID AS VARCHAR) LIKE '{LOOSE_ID_PREFIX}%' OR lower(NAME) LIKE '%{CITY_NAME_PHRASE}%') AS lo FROM fx_tract),
ft AS (SELECT t.* FROM fx_tract t JOIN tier ON TRUE WHERE CASE WHEN tier.ex THEN CAST(GEOID AS VARCHAR) LIKE '{CITY_ID_PREFIX}%'
        WHEN tier.lo THEN (CAST(GEOID AS VARCHAR) LIKE '{LOOSE_ID_PREFIX}%' OR lower(NAME) LIKE '%{CITY_NAME_PHRASE}%') ELSE TRUE END),
fte AS (SELECT e.* FROM fx_tract_edge e WHERE e.gid IN (SELECT gid FROM ft))"""


_FILTERED: dict = {}


def _filtered_tracts(spark, sf) -> inputs.Layer:
    """F1-filtered tract layer, persisted once per session and folder (its
    edges, measures and overlay feed several statistics)."""
    from ..operators import areal
    from ..operators.polygons import polygon_measures
    key = session_key(spark, sf)
    if key not in _FILTERED:
        tr = inputs.tracts(spark, sf)
        kept = areal.tiered_filter(tr.attrs, S.column(tr.attrs, "tract_id"), "NAME")
        edges = tr.edges.join(kept.select("gid"), "gid", "left_semi").persist()
        _FILTERED[key] = inputs.Layer(edges, kept, polygon_measures(edges).persist())
    return _FILTERED[key]


_FILTERED_OV: dict = {}


def _filtered_overlay(spark, sf) -> DataFrame:
    key = session_key(spark, sf)
    if key not in _FILTERED_OV:
        nb, ft = inputs.neighborhoods(spark, sf), _filtered_tracts(spark, sf)
        _FILTERED_OV[key] = spatial.overlay_areas(nb.edges, nb.measures, ft.edges, ft.measures).persist()
    return _FILTERED_OV[key]


@register("tiered_filter", with_views(TR, TIER_CTES + "\nSELECT gid, GEOID, NAME FROM ft"))
def q_tiered_filter(spark, sf):
    return _filtered_tracts(spark, sf).attrs.select("gid", "GEOID", "NAME")


@register("clip_area", with_views(NBH + TR, f""", {O.overlay_ctes('fx_nbh_edge', 'fx_tract_edge', 'ov')}
SELECT CAST(t.GEOID AS VARCHAR) AS tract_id, round(sum(o.inter_area), 3) AS clipped_area
FROM ov o JOIN fx_tract t ON t.gid = o.b_gid GROUP BY t.GEOID"""))
def q_clip_area(spark, sf):
    from ..operators import areal
    nb, tr = inputs.neighborhoods(spark, sf), inputs.tracts(spark, sf)
    ov = inputs.overlay(spark, sf)
    c = areal.clip_area(ov, nb.edges, nb.measures, tr.edges, overlaps=nb.has_overlaps)
    return (c.join(tr.attrs.select(F.col("gid").alias("b_gid"), F.col("GEOID").cast("string").alias("tract_id")), "b_gid")
             .select("tract_id", F.round("clipped_area", 3).alias("clipped_area")))


@register("clip_area_plots", with_views(["fx_plot_edge"] + TR, f""", {O.overlay_ctes('fx_plot_edge', 'fx_tract_edge', 'ov')},
ed AS (SELECT o.b_gid, e.gid AS own, e.x1, e.y1, e.x2, e.y2 FROM ov o JOIN fx_plot_edge e ON e.gid = o.a_gid
       UNION ALL SELECT o.b_gid, NULL, e.x1, e.y1, e.x2, e.y2 FROM (SELECT DISTINCT b_gid FROM ov) o JOIN fx_tract_edge e ON e.gid = o.b_gid),
met AS (SELECT p.b_gid, p.x1, p.x2 - p.x1 AS px, p.y2 - p.y1 AS py, q.x2 - q.x1 AS qx, q.y2 - q.y1 AS qy, q.x1 - p.x1 AS dx, q.y1 - p.y1 AS dy
        FROM ed p JOIN ed q ON p.b_gid = q.b_gid AND p.own IS DISTINCT FROM q.own),
cut AS (SELECT b_gid, x1 AS x FROM ed
        UNION SELECT b_gid, x1 + px * (dx * qy - dy * qx) / (px * qy - py * qx) FROM met
              WHERE px * qy <> py * qx AND (dx * qy - dy * qx) / (px * qy - py * qx) BETWEEN 0 AND 1
                AND (dx * py - dy * px) / (px * qy - py * qx) BETWEEN 0 AND 1),
band AS (SELECT b_gid, x AS xa, lead(x) OVER (PARTITION BY b_gid ORDER BY x) AS xb FROM cut),
hit AS (SELECT b.b_gid, b.xa, b.xb, e.own, e.y1 + ((b.xa + b.xb) / 2 - e.x1) * (e.y2 - e.y1) / (e.x2 - e.x1) AS y
        FROM band b JOIN ed e ON e.b_gid = b.b_gid AND least(e.x1, e.x2) < (b.xa + b.xb) / 2 AND greatest(e.x1, e.x2) > (b.xa + b.xb) / 2),
sec AS (SELECT * FROM (SELECT *, lead(y) OVER w AS top, row_number() OVER w AS k FROM hit
                       WINDOW w AS (PARTITION BY b_gid, xa, own ORDER BY y)) s WHERE k % 2 = 1),
isl AS (SELECT *, CASE WHEN y <= max(top) OVER (PARTITION BY b_gid, xa ORDER BY y, top ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                       THEN 0 ELSE 1 END AS opens FROM sec WHERE own IS NOT NULL),
num AS (SELECT *, sum(opens) OVER (PARTITION BY b_gid, xa ORDER BY y, top ROWS UNBOUNDED PRECEDING) AS i FROM isl),
merged AS (SELECT b_gid, xa, i, min(y) AS y, max(top) AS top FROM num GROUP BY b_gid, xa, i),
area AS (SELECT t.b_gid, sum((t.xb - t.xa) * greatest(least(t.top, m.top) - greatest(t.y, m.y), 0)) AS a
         FROM sec t JOIN merged m ON m.b_gid = t.b_gid AND m.xa = t.xa WHERE t.own IS NULL GROUP BY t.b_gid)
SELECT CAST(t.GEOID AS VARCHAR) AS tract_id, round(a.a, 3) AS clipped_area FROM area a JOIN fx_tract t ON t.gid = a.b_gid"""))
def q_clip_area_plots(spark, sf):
    """J11 where the covering polygons overlap: tracts inside the union of the
    plots (concave, holed and of several parts)."""
    from ..operators import areal
    edges, measures = _plots(spark, sf)
    tr = inputs.tracts(spark, sf)
    ov = spatial.overlay_areas(edges, measures, tr.edges, tr.measures)
    c = areal.clip_area(ov, edges, measures, tr.edges, overlaps=True)
    return (c.join(tr.attrs.select(F.col("gid").alias("b_gid"), F.col("GEOID").cast("string").alias("tract_id")), "b_gid")
             .select("tract_id", F.round("clipped_area", 3).alias("clipped_area")))


@register("areal_shares", with_views(NBH + TR, TIER_CTES + f""",
{O.overlay_ctes('fx_nbh_edge', 'fte', 'ovf')},
clip AS (SELECT b_gid, sum(inter_area) AS ca FROM ovf GROUP BY b_gid),
j AS (SELECT o.a_gid, coalesce(o.inter_area / nullif(c.ca, 0), 0) AS w, t.* FROM ovf o JOIN clip c ON c.b_gid = o.b_gid
      LEFT JOIN ft t ON t.gid = o.b_gid),
g AS (SELECT a_gid, sum(coalesce(CAST(totalE AS DOUBLE), 0) * w) AS tot, """
                                       + ", ".join(f"sum(coalesce(CAST({RACE_SRC[k]} AS DOUBLE), 0) * w) AS s_{k}" for k in RACE_KEYS)
                                       + """ FROM j GROUP BY a_gid)
SELECT n.name, """ + ", ".join(f"round(CASE WHEN tot > 0 THEN s_{k} / tot ELSE 0e0 END, 6) AS pct_{k}" for k in RACE_KEYS)
                                       + " FROM g JOIN fx_nbh n ON n.gid = g.a_gid"))
def q_areal_shares(spark, sf):
    from ..operators import areal
    nb = inputs.neighborhoods(spark, sf)
    ft = _filtered_tracts(spark, sf)
    ov = _filtered_overlay(spark, sf)
    r = areal.areal_shares(ov, ft.attrs, S.race_counts(ft.attrs),
                           clip=areal.clip_area(ov, nb.edges, nb.measures, ft.edges, overlaps=nb.has_overlaps))
    return _r6(r.join(nb.attrs.select("gid", "name"), "gid").drop("gid"), "name")


def _awm_sql(weighted: bool) -> str:
    w = "coalesce(CAST(t.Households AS DOUBLE), 0)" if weighted else "coalesce(o.inter_area / nullif(b.area, 0), 0)"
    return with_views(NBH + TR, f""", {O.overlay_ctes('fx_nbh_edge', 'fx_tract_edge', 'ov')},
j AS (SELECT o.a_gid, {w} AS w, t.avg_income AS v FROM ov o LEFT JOIN fx_tract t ON t.gid = o.b_gid JOIN ov_pb b ON b.gid = o.b_gid),
g AS (SELECT a_gid, sum(w) AS sw, sum(v * w) AS sv FROM j GROUP BY a_gid)
SELECT n.name, round(CASE WHEN sw > 0 THEN coalesce(sv, 0) / sw ELSE 0e0 END, 6) AS avg_income
FROM g JOIN fx_nbh n ON n.gid = g.a_gid""")


def _awm(spark, sf, weighted: bool) -> DataFrame:
    from ..operators import areal
    nb, tr = inputs.neighborhoods(spark, sf), inputs.tracts(spark, sf)
    ov = inputs.overlay(spark, sf)
    wcol = S.column(tr.attrs, "weight_listed") if weighted else None
    r = areal.areal_weighted_mean(ov, tr.measures, tr.attrs, S.columns(tr.attrs, "income"), wcol)
    return _r6(r.join(nb.attrs.select("gid", "name"), "gid").drop("gid"), "name")


@register("areal_weighted_mean", _awm_sql(True))
def q_areal_weighted_mean(spark, sf):
    return _awm(spark, sf, True)


@register("areal_area_weighted_mean", _awm_sql(False))
def q_areal_area_weighted_mean(spark, sf):
    return _awm(spark, sf, False)


WITHIN_CTES = f""", {O.overlay_ctes('fx_nbh_edge', 'fx_tract_edge', 'ov')},
wi AS (SELECT n.name, round(avg(t.avg_income), 6) AS avg_income FROM ov o JOIN ov_pb b ON b.gid = o.b_gid
       JOIN fx_tract t ON t.gid = o.b_gid JOIN fx_nbh n ON n.gid = o.a_gid
       WHERE o.inter_area >= b.area * (1 - 1e-9) GROUP BY n.name)"""


def _within(spark, sf) -> DataFrame:
    from ..operators import areal
    nb, tr = inputs.neighborhoods(spark, sf), inputs.tracts(spark, sf)
    ov = inputs.overlay(spark, sf)
    r = areal.within_mean(ov, tr.measures, tr.attrs, S.columns(tr.attrs, "income"))
    return _r6(r.join(nb.attrs.select("gid", "name"), "gid").drop("gid"), "name")


@register("within_fill", with_views(NBH + TR, WITHIN_CTES + "\nSELECT name, avg_income FROM wi"))
def q_within_fill(spark, sf):
    return _within(spark, sf)


def _centroid_cte(edges: str, name: str) -> str:
    """``name(pid, x, y)``: the centroids of an oriented edge view."""
    return f"""{O.bbox_area_cte(edges, name + '_m')},
{name} AS (SELECT m.gid AS pid,
  m.xmin + sum(((e.x1 - m.xmin) + (e.x2 - m.xmin)) * ((e.x1 - m.xmin) * (e.y2 - m.ymin) - (e.x2 - m.xmin) * (e.y1 - m.ymin))) / (6 * m.area) AS x,
  m.ymin + sum(((e.y1 - m.ymin) + (e.y2 - m.ymin)) * ((e.x1 - m.xmin) * (e.y2 - m.ymin) - (e.x2 - m.xmin) * (e.y1 - m.ymin))) / (6 * m.area) AS y
  FROM {edges} e JOIN {name}_m m ON m.gid = e.gid GROUP BY m.gid, m.xmin, m.ymin, m.area)"""


@register("within_fill_centroid", with_views(NBH + TR, f""", {_centroid_cte('fx_tract_edge', 'tc')},
hit AS ({O.pip_pairs('tc', 'fx_nbh_edge', 'within')})
SELECT n.name, round(avg(t.avg_income), 6) AS avg_income FROM hit h JOIN fx_tract t ON t.gid = h.pid
JOIN fx_nbh n ON n.gid = h.gid GROUP BY n.name"""))
def q_within_fill_centroid(spark, sf):
    from ..operators import areal
    nb, tr = inputs.neighborhoods(spark, sf), inputs.tracts(spark, sf)
    r = areal.centroid_mean(nb.index, tr.measures, tr.attrs, S.columns(tr.attrs, "income"))
    return _r6(r.join(nb.attrs.select("gid", "name"), "gid").drop("gid"), "name")


NEAREST_CTES = f""", {O.bbox_area_cte('fx_nbh_edge', 'nm')},
cen AS (SELECT m.gid AS pid,
          m.xmin + sum(((e.x1 - m.xmin) + (e.x2 - m.xmin)) * ((e.x1 - m.xmin) * (e.y2 - m.ymin) - (e.x2 - m.xmin) * (e.y1 - m.ymin))) / (6 * m.area) AS x,
          m.ymin + sum(((e.y1 - m.ymin) + (e.y2 - m.ymin)) * ((e.x1 - m.xmin) * (e.y2 - m.ymin) - (e.x2 - m.xmin) * (e.y1 - m.ymin))) / (6 * m.area) AS y
        FROM fx_nbh_edge e JOIN nm m ON m.gid = e.gid GROUP BY m.gid, m.xmin, m.ymin, m.area),
ins AS ({O.pip_pairs('cen', 'fx_tract_edge', 'intersects')}),
dd AS (SELECT p.pid, e.gid, sqrt(min({G.seg_point_dist2_sql('e', 'p.x', 'p.y')})) AS dist
       FROM cen p JOIN fx_tract_edge e ON TRUE GROUP BY p.pid, e.gid),
d AS (SELECT dd.pid, dd.gid, CASE WHEN ins.pid IS NOT NULL THEN 0e0 ELSE dd.dist END AS dist
      FROM dd LEFT JOIN ins ON ins.pid = dd.pid AND ins.gid = dd.gid),
best AS (SELECT pid, min(dist) AS m FROM d GROUP BY pid),
nn AS (SELECT n.name, round(avg(t.avg_income), 6) AS avg_income FROM d JOIN best ON d.pid = best.pid AND d.dist = best.m
       JOIN fx_tract t ON t.gid = d.gid JOIN fx_nbh n ON n.gid = d.pid GROUP BY n.name)"""


def _nearest(spark, sf) -> DataFrame:
    from ..operators import areal
    nb, tr = inputs.neighborhoods(spark, sf), inputs.tracts(spark, sf)
    cen = nb.measures.select(F.col("gid").alias("pid"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    nn = spatial.nearest_polygon(cen, tr.edges, measures=tr.measures, index=tr.index)
    r = areal.nearest_mean(nn, tr.attrs, S.columns(tr.attrs, "income"))
    return _r6(r.join(nb.attrs.select("gid", "name"), "gid").drop("gid"), "name")


@register("nearest_fill", with_views(NBH + TR, NEAREST_CTES + "\nSELECT name, avg_income FROM nn"))
def q_nearest_fill(spark, sf):
    return _nearest(spark, sf)


@register("missing_keys", with_views(NBH + TR, WITHIN_CTES + "\nSELECT name FROM fx_nbh WHERE name NOT IN (SELECT name FROM wi)"))
def q_missing_keys(spark, sf):
    from ..operators import areal
    nb = inputs.neighborhoods(spark, sf)
    return areal.missing_keys(nb.attrs.select("name"), _within(spark, sf), "name")


@register("three_tier_fill", with_views(NBH + TR, WITHIN_CTES.replace("ov", "ow") + NEAREST_CTES + f""",
{O.overlay_ctes('fx_nbh_edge', 'fx_tract_edge', 'ov')},
aj AS (SELECT o.a_gid, coalesce(CAST(t.Households AS DOUBLE), 0) AS w, t.avg_income AS v FROM ov o LEFT JOIN fx_tract t ON t.gid = o.b_gid),
ag AS (SELECT a_gid, sum(w) AS sw, sum(v * w) AS sv FROM aj GROUP BY a_gid),
aw AS (SELECT n.name, round(CASE WHEN sw > 0 THEN coalesce(sv, 0) / sw ELSE 0e0 END, 6) AS avg_income FROM ag JOIN fx_nbh n ON n.gid = ag.a_gid)
SELECT coalesce(aw.name, wi.name, nn.name) AS name, coalesce(aw.avg_income, wi.avg_income, nn.avg_income, 0e0) AS avg_income
FROM aw FULL OUTER JOIN wi ON aw.name = wi.name FULL OUTER JOIN nn ON coalesce(aw.name, wi.name) = nn.name"""))
def q_three_tier_fill(spark, sf):
    from ..operators import areal
    return areal.three_tier_fill(_awm(spark, sf, True), _within(spark, sf), _nearest(spark, sf), "name", ["avg_income"])


@register("three_tier_gaps", with_views(NBH + TR, WITHIN_CTES.replace("ov", "ow") + NEAREST_CTES + f""",
{O.overlay_ctes('fx_nbh_edge', 'fx_tract_edge', 'ov')},
aj AS (SELECT o.a_gid, coalesce(CAST(t.Households AS DOUBLE), 0) AS w, t.avg_income AS v FROM ov o LEFT JOIN fx_tract t ON t.gid = o.b_gid),
ag AS (SELECT a_gid, sum(w) AS sw, sum(v * w) AS sv FROM aj GROUP BY a_gid),
aw AS (SELECT n.name, round(CASE WHEN sw > 0 THEN coalesce(sv, 0) / sw ELSE 0e0 END, 6) AS avg_income
       FROM ag JOIN fx_nbh n ON n.gid = ag.a_gid WHERE n.gid % 3 = 0),
w2 AS (SELECT * FROM wi WHERE name IN (SELECT name FROM fx_nbh WHERE gid % 3 <= 1)),
n3 AS (SELECT * FROM nn WHERE name IN (SELECT name FROM fx_nbh WHERE gid % 3 >= 1))
SELECT name, CASE WHEN name IN (SELECT name FROM aw) THEN 1 WHEN name IN (SELECT name FROM w2) THEN 2 ELSE 3 END AS tier,
       coalesce(a.avg_income, w.avg_income, n.avg_income, 0e0) AS avg_income
FROM (SELECT name FROM aw UNION SELECT name FROM w2 UNION SELECT name FROM n3) k
LEFT JOIN aw a USING (name) LEFT JOIN w2 w USING (name) LEFT JOIN n3 n USING (name)"""))
def q_three_tier_gaps(spark, sf):
    """J7 where the overlay knows a third of the neighborhoods and the other
    tiers supply the rest."""
    from ..operators import areal
    ids = inputs.neighborhoods(spark, sf).attrs.select("name", (F.col("gid") % 3).alias("g"))

    def part(tier, keep):
        return tier.join(F.broadcast(ids.filter(keep).select("name")), "name", "left_semi")

    t1, t2, t3 = part(_awm(spark, sf, True), "g = 0"), part(_within(spark, sf), "g <= 1"), part(_nearest(spark, sf), "g >= 1")
    tier = F.when(F.col("one"), 1).when(F.col("two"), 2).otherwise(3)
    have = [t.select("name", F.lit(True).alias(n)) for t, n in ((t1, "one"), (t2, "two"))]
    out = areal.three_tier_fill(t1, t2, t3, "name", ["avg_income"])
    return out.join(have[0], "name", "left").join(have[1], "name", "left").select("name", tier.alias("tier"), "avg_income")


@register("tiered_filter_loose", with_views(TR, """
SELECT gid, GEOID, NAME FROM fx_tract WHERE CAST(GEOID AS VARCHAR) LIKE '51041%' OR lower(NAME) LIKE '%0002%'"""))
def q_tiered_filter_loose(spark, sf):
    """F1, second tier: no id has the exact prefix; the loose one or the name decides."""
    from ..operators import areal
    attrs = inputs.tracts(spark, sf).attrs.select("gid", "GEOID", "NAME")
    return areal.tiered_filter(attrs, S.column(attrs, "tract_id"), S.column(attrs, "name"), exact_prefix="99999",
                               loose_prefix="51041", name_phrase="0002")


@register("tiered_filter_all", with_views(TR, "SELECT gid, GEOID, NAME FROM fx_tract"))
def q_tiered_filter_all(spark, sf):
    """F1, third tier: neither id nor name decides, so every row stays."""
    from ..operators import areal
    attrs = inputs.tracts(spark, sf).attrs.select("gid", "GEOID", "NAME")
    return areal.tiered_filter(attrs, S.column(attrs, "tract_id"), S.column(attrs, "name"), exact_prefix="99999",
                               loose_prefix="88888", name_phrase="no such tract")


@register("neighborhood_points", with_views([H] + NBH, """
SELECT n.name AS Name, count(h.pid) AS total_count, sum(CASE WHEN h.custmaterial = 'Lead' THEN 1 ELSE 0 END) AS lead_count
FROM fx_nbh n LEFT JOIN fx_house h ON h.neighborhood_name = n.name GROUP BY n.name"""))
def q_neighborhood_points(spark, sf):
    """Roles in use: points by their neighborhood column (P10), joined to the
    layer's name column (P1), kept columns only (P11), the summary columns
    then found again by role (P9)."""
    h, nb = inputs.houses(spark, sf), inputs.neighborhoods(spark, sf).attrs
    by = S.column(h, "neighborhood")
    per = h.groupBy(F.col(by).alias("Name")).agg(
        F.count("pid").alias("total_count"), F.sum(F.when(F.col("custmaterial") == "Lead", 1).otherwise(0)).alias("n_lead"))
    named = nb.select(F.col(S.column(nb, "name_any_case")).alias("Name"), "gid").join(per, "Name", "left")
    kept = S.keep_present(named, ["Name", "total_count", "n_lead", "n_known"])
    return kept.select(S.column(kept, "name"), F.coalesce(S.column(kept, "total_count"), F.lit(0)).alias("total_count"),
                       F.coalesce(S.column(kept, "lead_count"), F.lit(0)).alias("lead_count"))


@register("lonlat_back", with_views([H], f"""
SELECT pid, round(lon, 7) AS lon, round(lat, 7) AS lat, 5070 AS srid, 4326 AS back
FROM (SELECT pid, {O.dbl(CENTRE_LON)} + x * 1e-5 AS lon, {O.dbl(CENTRE_LAT)} + y * 1e-5 AS lat FROM fx_house) t"""))
def q_lonlat_back(spark, sf):
    """A layer without a CRS is given one, reprojected to 5070 and
    back; the coordinates are the first ones."""
    p = G.ensure_crs(_lonlat(inputs.houses(spark, sf)), "lon", "lat", 4326)
    there = G.ensure_crs(p, "lon", "lat", 5070)
    back = G.ensure_crs(there, "lon", "lat", 4326)
    return back.select("pid", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"),
                       F.lit(G.srid_of(there, "lon")).alias("srid"), F.lit(G.srid_of(back, "lon")).alias("back"))


@register("dataset_ids", with_views([H], """
SELECT pid, nullif(regexp_extract(CASE WHEN pid % 3 = 0 THEN 'https://host/none/' || pid
    ELSE 'https://host/datasets/' || md5(CAST(pid AS VARCHAR)) || '_' || (pid % 7) || '/explore' END,
    '([0-9a-f]{32}_[0-9]+)', 1), '') AS dataset_id FROM fx_house"""))
def q_dataset_ids(spark, sf):
    """The dataset id inside a URL; null where there is none."""
    h = inputs.houses(spark, sf).select("pid")
    text = F.col("pid").cast("string")
    url = F.when(F.col("pid") % 3 == 0, F.concat(F.lit("https://host/none/"), text)).otherwise(
        F.concat(F.lit("https://host/datasets/"), F.md5(text.cast("binary")), F.lit("_"),
                 (F.col("pid") % 7).cast("string"), F.lit("/explore")))
    return h.select("pid", X.dataset_id(url).alias("dataset_id"))


# ============================== hard shapes: holes, parts, concave, clockwise

def _plots(spark, sf):
    from ..operators.polygons import edges_from_vertices, polygon_measures
    from ..sources.fixtures import register_fixtures
    inputs._fx(spark, sf)
    register_fixtures(spark, sf, ["fx_plot_ring", "fx_plot_point"])
    edges = edges_from_vertices(spark.table("fx_plot_ring"))
    return edges, polygon_measures(edges)


@register("plot_points", with_views(["fx_plot_edge", "fx_plot_point"], f"""
SELECT 'within' AS predicate, pid, gid FROM ({O.pip_pairs('fx_plot_point', 'fx_plot_edge', 'within')}) a
UNION ALL SELECT 'intersects', pid, gid FROM ({O.pip_pairs('fx_plot_point', 'fx_plot_edge', 'intersects')}) b"""))
def q_plot_points(spark, sf):
    """J1 and J2 on hard shapes, with points on corners and edges."""
    edges, measures = _plots(spark, sf)
    index, pts = spatial.PipIndex(edges, measures), spark.table("fx_plot_point")
    each = [spatial.pip_join(pts, index, predicate=k, how="inner").select(F.lit(k).alias("predicate"), "pid", "gid")
            for k in ("within", "intersects")]
    return each[0].unionByName(each[1])


@register("plot_overlay", with_views(["fx_plot_edge", "fx_nbh_node", "fx_nbh_edge"],
                                     f""", {O.overlay_ctes('fx_plot_edge', 'fx_nbh_edge', 'pv')}
SELECT a_gid, b_gid, round(inter_area, 4) AS inter_area FROM pv"""))
def q_plot_overlay(spark, sf):
    """J3 on hard shapes."""
    edges, measures = _plots(spark, sf)
    nb = inputs.neighborhoods(spark, sf)
    return spatial.overlay_areas(edges, measures, nb.edges, nb.measures).select(
        "a_gid", "b_gid", F.round("inter_area", 4).alias("inter_area"))


FAR_POINTS = """SELECT c_custkey AS pid, 3000e0 + ((c_custkey * 7919) % 100003) * 0.3e0 AS x,
       CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 4000e0 - ((c_custkey * 104729) % 99991) * 0.4e0 END AS y FROM customer"""


@register("nearest_far", with_views(["fx_plot_edge"], f""", pt AS ({FAR_POINTS}),
hit AS ({O.pip_pairs('pt', 'fx_plot_edge', 'intersects')}),
proj AS (SELECT p.pid, e.gid, p.x, p.y, e.x1, e.y1, e.x2 - e.x1 AS ex, e.y2 - e.y1 AS ey FROM pt p JOIN fx_plot_edge e ON p.y IS NOT NULL),
foot AS (SELECT *, greatest(0e0, least(1e0, ((x - x1) * ex + (y - y1) * ey) / (ex * ex + ey * ey))) AS t FROM proj),
d AS (SELECT f.pid, f.gid, CASE WHEN max(h.gid) IS NOT NULL THEN 0e0
             ELSE min(sqrt((x - x1 - t * ex) * (x - x1 - t * ex) + (y - y1 - t * ey) * (y - y1 - t * ey))) END AS dist
      FROM foot f LEFT JOIN hit h ON h.pid = f.pid AND h.gid = f.gid GROUP BY f.pid, f.gid),
m AS (SELECT pid, min(dist) AS m FROM d GROUP BY pid)
SELECT pt.pid, round(m.m, 6) AS dist FROM pt LEFT JOIN m ON m.pid = pt.pid"""))
def q_nearest_far(spark, sf):
    """J5 with points far outside all polygons and points without a coordinate."""
    edges, measures = _plots(spark, sf)
    pts = spark.sql(FAR_POINTS)
    near = spatial.nearest_polygon(pts, edges, measures=measures)
    return near.groupBy("pid").agg(F.round(F.min("dist"), 6).alias("dist"))  # ties: several polygons


HARD_VALUES = """SELECT c_custkey AS k, CASE c_custkey % 14 WHEN 0 THEN concat('yes', chr(160)) WHEN 1 THEN concat(chr(8195), 'Lead', chr(12288))
       WHEN 2 THEN '1900d' WHEN 3 THEN '1900f' WHEN 4 THEN '1577836800000.0' WHEN 5 THEN '1.5e3' WHEN 6 THEN ' 12 ' WHEN 7 THEN 'inf'
       WHEN 8 THEN '-1.5' WHEN 9 THEN '1900D' WHEN 10 THEN '' WHEN 11 THEN concat(chr(28), 'non-lead', chr(133)) WHEN 12 THEN NULL
       ELSE 'n/a' END AS v, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 1577836800000e0 + c_custkey * 86400000e0 END AS ms FROM customer"""


@register("hard_values", f"""
WITH h AS ({HARD_VALUES})
SELECT k, {O.status('v')} AS status, {O.num('v')} AS num, strftime(epoch_ms(CAST(ms AS BIGINT)), '%Y-%m-%d') AS day FROM h""")
def q_hard_values(spark, sf):
    """X1/X16, X6 and X7 on values that a plain strip or cast gets wrong."""
    inputs._fx(spark, sf)
    # Spark's chr() ends at 255; the three wide blanks are written out.
    wide = {8195: "\u2003", 12288: "\u3000"}
    sql = HARD_VALUES
    for code, char in wide.items():
        sql = sql.replace(f"chr({code})", f"'{char}'")
    h = spark.sql(sql)
    return h.select("k", X.normalize_status("v").alias("status"), X.to_double("v").alias("num"),
                    F.date_format(X.epoch_ms_to_ts("ms"), "yyyy-MM-dd").alias("day"))


# ======================================= step 5: master, summaries, sample



def house_master_df(spark, sf) -> DataFrame:
    """E2 stage 1 over the houses; one tract layer gives race and income."""
    tr = inputs.tracts(spark, sf)
    return house_master_join(inputs.houses(spark, sf), inputs.neighborhoods(spark, sf), tr, tr)


@register("house_master", with_views([H] + NBH + TR, f""", {PTS_CTE},
a AS ({O.pip_pairs('pts', 'fx_nbh_edge', 'within')}),
b AS ({O.pip_pairs('pts', 'fx_tract_edge', 'within')})
SELECT p.pid, n.name AS nbh_name, CAST(t.GEOID AS VARCHAR) AS race_tract_id, t.Pwhite AS race_Pwhite, t.Pblack AS race_Pblack,
       CAST(u.GEOID AS VARCHAR) AS inc_tract_id, u.avg_income AS inc_avg_income
FROM pts p LEFT JOIN a ON a.pid = p.pid LEFT JOIN fx_nbh n ON n.gid = a.gid
LEFT JOIN b ON b.pid = p.pid LEFT JOIN fx_tract t ON t.gid = b.gid
LEFT JOIN b AS c ON c.pid = p.pid LEFT JOIN fx_tract u ON u.gid = c.gid"""))
def q_house_master(spark, sf):
    return house_master_df(spark, sf).select("pid", "nbh_name", "race_tract_id", "race_Pwhite", "race_Pblack",
                                             "inc_tract_id", "inc_avg_income")


SIDES = {"bothsides": "bothsidesstatus_imputed", "custmaterial": "custmaterial_cat_imputed",
         "utilmaterial": "utilmaterial_cat_imputed"}


def _imp_sql_cols() -> str:
    parts = []
    for side, col in SIDES.items():
        for kind, val in (("lead", "Lead/GRR"), ("non_lead", "Non-Lead")):
            parts.append(f"count(*) FILTER (WHERE {col} = '{val}') AS {kind}_count_{side}_imputed")
            parts.append(f"round_even(count(*) FILTER (WHERE {col} = '{val}') / count(*) * 100e0, 1) "
                         f"AS {kind}_percent_{side}_imputed")
    return ", ".join(parts)


@register("imputed_summary", _with_imp(f"""
SELECT neighborhood_name, count(*) AS total_count, {_imp_sql_cols()}
FROM imp WHERE neighborhood_name IS NOT NULL GROUP BY neighborhood_name"""))
def q_imputed_summary(spark, sf):
    h = imputed_columns(inputs.houses(spark, sf))
    return summary.imputed_summary(h, "neighborhood_name", {k: F.col(v) for k, v in SIDES.items()})


VC_COLS = ["custmaterial", "custmaterial_cat", "utilmaterial", "utilmaterial_cat", "bothsidesstatus",
           "bothsidesstatus_cat", "custmaterial_cat_imputed", "utilmaterial_cat_imputed", "bothsidesstatus_imputed"]


@register("value_counts_pct", _with_imp(",\nlong AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS value FROM imp" for c in VC_COLS) + """)
SELECT variable, value, count(*) AS count,
       round_even(count(*) / sum(count(*)) OVER (PARTITION BY variable) * 100e0, 1) AS percent
FROM long GROUP BY variable, value"""))
def q_value_counts_pct(spark, sf):
    h = imputed_columns(inputs.houses(spark, sf))
    long = h.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("value"))
                                        for c in VC_COLS])).alias("r")).select("r.*")
    # O3: largest first (ties by value) - the order of the printed tables
    return summary.value_counts_by_variable(long).orderBy("variable", F.desc("count"), "value")


@register("class_score_stats", with_views([H], """
SELECT ModelClassification_Cust, min(ModelScoreForLeadClassification_Cust) AS score_min,
       max(ModelScoreForLeadClassification_Cust) AS score_max, round(avg(ModelScoreForLeadClassification_Cust), 9) AS score_mean
FROM fx_house WHERE ModelClassification_Cust IS NOT NULL GROUP BY ModelClassification_Cust"""))
def q_class_score_stats(spark, sf):
    h = inputs.houses(spark, sf)
    g = summary.grouped_min_max_mean(h, "ModelClassification_Cust", ["ModelScoreForLeadClassification_Cust"])
    c = "ModelScoreForLeadClassification_Cust"
    return g.select("ModelClassification_Cust", F.col(f"{c}_min").alias("score_min"),
                    F.col(f"{c}_max").alias("score_max"), F.round(f"{c}_mean", 9).alias("score_mean"))


@register("material_score_stats", _with_imp("""
SELECT custmaterial_cat, min(ModelScoreForLeadClassification_Cust) AS score_min, max(ModelScoreForLeadClassification_Cust) AS score_max,
       round(avg(ModelScoreForLeadClassification_Cust), 9) AS score_mean, min(ModelClassification_Cust) AS class_min,
       max(ModelClassification_Cust) AS class_max, round(avg(ModelClassification_Cust), 9) AS class_mean
FROM imp GROUP BY custmaterial_cat"""))
def q_material_score_stats(spark, sf):
    h = imputed_columns(inputs.houses(spark, sf))
    s, k = "ModelScoreForLeadClassification_Cust", "ModelClassification_Cust"
    g = summary.grouped_min_max_mean(h, "custmaterial_cat", [s, k])
    return g.select("custmaterial_cat", F.col(f"{s}_min").alias("score_min"), F.col(f"{s}_max").alias("score_max"),
                    F.round(f"{s}_mean", 9).alias("score_mean"), F.col(f"{k}_min").alias("class_min"),
                    F.col(f"{k}_max").alias("class_max"), F.round(f"{k}_mean", 9).alias("class_mean"))


@register("latest_edits", with_views([H], """
SELECT strftime(epoch_ms(EditDate), '%Y-%m-%d %H:%M:%S') AS edit_ts FROM fx_house
WHERE EditDate IS NOT NULL ORDER BY EditDate DESC LIMIT 10"""))
def q_latest_edits(spark, sf):
    h = inputs.houses(spark, sf).select(X.epoch_ms_to_ts("EditDate").alias("ts"))
    return summary.top_k(h, "ts", 10).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("edit_ts"))


@register("last_edit", with_views([H], """
SELECT strftime(max(epoch_ms(EditDate)), '%Y-%m-%d %H:%M:%S') AS last_edit FROM fx_house"""))
def q_last_edit(spark, sf):
    h = inputs.houses(spark, sf)
    return h.agg(F.date_format(F.max(X.epoch_ms_to_ts("EditDate")), "yyyy-MM-dd HH:mm:ss").alias("last_edit"))


NUM_COLS = ["yearstructbuilt", "MHI", "J40_TotCatExceeded", "x", "y"]


def eda_minimal(h: DataFrame) -> DataFrame:
    """The EDA's minimal table: status categories (X1) and the cleaned year (F3 c)."""
    return (h.withColumn("utilmaterial_cat", X.normalize_status("utilmaterial"))
             .withColumn("custmaterial_cat", X.normalize_status("custmaterial"))
             .withColumn("bothsidesstatus_cat", X.normalize_status("bothsidesstatus"))
             .withColumn("yearstructbuilt", X.clean_year("yearstructbuilt", CUR_YEAR)))


@register("numeric_profile", with_views([H], ",\nm AS (SELECT " + ", ".join(
    [f"CASE WHEN {O.num('yearstructbuilt')} > 0 AND {O.num('yearstructbuilt')} <= {CUR_YEAR} THEN {O.num('yearstructbuilt')} END AS yearstructbuilt"]
    + [f"{O.num(c)} AS {c}" for c in NUM_COLS[1:]]) + " FROM fx_house),\nlong AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS v FROM m WHERE {c} IS NOT NULL" for c in NUM_COLS) + """)
SELECT variable, count(v) AS count, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median, min(v) AS min,
       round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.9), 6) AS p90, max(v) AS max
FROM long GROUP BY variable"""))
def q_numeric_profile(spark, sf):
    m = eda_minimal(inputs.houses(spark, sf))
    p = summary.numeric_profile(m, NUM_COLS)
    return p.select("variable", "count", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"),
                    "min", F.round("p10", 6).alias("p10"), F.round("p90", 6).alias("p90"), "max")


CAT_COLS = ["utilmaterial", "custmaterial", "bothsidesstatus", "utilmaterial_cat", "custmaterial_cat",
            "bothsidesstatus_cat", "buildingtype", "disadvantaged", "neighborhood_name"]


@register("categorical_profile", with_views([H], f""",
m AS (SELECT *, {O.status('utilmaterial')} AS utilmaterial_cat, {O.status('custmaterial')} AS custmaterial_cat,
             {O.status('bothsidesstatus')} AS bothsidesstatus_cat FROM fx_house),
long AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS variable, coalesce(CAST({c} AS VARCHAR), '<NA>') AS category FROM m"
                                   for c in CAT_COLS) + """)
SELECT variable, category, count(*) AS count, count(*) / sum(count(*)) OVER (PARTITION BY variable) AS percent
FROM long GROUP BY variable, category"""))
def q_categorical_profile(spark, sf):
    return summary.categorical_profile(eda_minimal(inputs.houses(spark, sf)), CAT_COLS)


@register("house_age", with_views([H], f"""
SELECT neighborhood_name, round(avg({CUR_YEAR}e0 - y), 9) AS avg_house_age, count(*) AS n_houses
FROM (SELECT neighborhood_name, {O.num('yearstructbuilt')} AS y FROM fx_house) t
WHERE y > 0 AND y <= {CUR_YEAR} AND neighborhood_name IS NOT NULL GROUP BY neighborhood_name"""))
def q_house_age(spark, sf):
    h = inputs.houses(spark, sf)
    y = X.to_double("yearstructbuilt")
    h = h.filter(X.year_valid(y, CUR_YEAR, "b"))
    g = summary.mean_count_by(h, "neighborhood_name", F.lit(float(CUR_YEAR)) - y, "avg_house_age", "n_houses")
    return g.select("neighborhood_name", F.round("avg_house_age", 9).alias("avg_house_age"), "n_houses")


@register("house_weighted_income", with_views([H], f"""
SELECT neighborhood_name, round(avg(v), 6) AS MHI FROM (SELECT neighborhood_name, {O.num('MHI')} AS v FROM fx_house) t
WHERE v IS NOT NULL AND neighborhood_name IS NOT NULL GROUP BY neighborhood_name"""))
def q_house_weighted_income(spark, sf):
    h = inputs.houses(spark, sf)
    g = summary.mean_count_by(h, "neighborhood_name", X.to_double("MHI"), "MHI", "_n")
    return g.select("neighborhood_name", F.round("MHI", 6).alias("MHI"))


def _year_bin_sql(y: str) -> str:
    parts = []
    for label, hi in summary.YEAR_BINS:
        parts.append(f"WHEN {y} <= {hi} THEN '{label}'" if hi is not None else f"ELSE '{label}'")
    return "CASE " + " ".join(parts) + " END"


@register("year_bins", with_views([H], f""",
t AS (SELECT {O.status('bothsidesstatus')} AS s,
             CASE WHEN {O.num('yearstructbuilt')} > 0 AND {O.num('yearstructbuilt')} <= {CUR_YEAR} THEN {O.num('yearstructbuilt')} END AS y
      FROM fx_house),
g AS (SELECT {_year_bin_sql('y')} AS year_bin, count(*) FILTER (WHERE s = 'Lead') AS l,
             count(*) FILTER (WHERE s = 'Non-Lead') AS n, count(*) FILTER (WHERE s = 'Unknown') AS u
      FROM t WHERE y IS NOT NULL GROUP BY 1)
SELECT year_bin, l + n AS count, CASE WHEN l + n > 0 THEN l / (l + n) ELSE 0e0 END AS lead_rate_known,
       CASE WHEN l + n + u > 0 THEN u / (l + n + u) ELSE 0e0 END AS unknown_rate FROM g"""))
def q_year_bins(spark, sf):
    h = inputs.houses(spark, sf)
    return summary.year_bins(h, X.clean_year("yearstructbuilt", CUR_YEAR), X.normalize_status("bothsidesstatus"))


SAMPLE_N, SAMPLE_SEED = 40000, 1


@register("hash_sample", with_views([H], f"""
SELECT pid, x, y FROM fx_house ORDER BY (pid * 7919 + {SAMPLE_SEED} * 104729) % 1000003, pid LIMIT {SAMPLE_N}"""))
def q_hash_sample(spark, sf):
    h = inputs.houses(spark, sf).select("pid", "x", "y")
    return summary.arith_hash_sample(h, "pid", SAMPLE_N, SAMPLE_SEED)


@register("hash_sample_small", with_views([H], f"""
SELECT pid, x, y FROM fx_house ORDER BY (pid * 7919 + {SAMPLE_SEED} * 104729) % 1000003, pid LIMIT 500"""))
def q_hash_sample_small(spark, sf):
    """O4 with fewer rows than the table has."""
    h = inputs.houses(spark, sf).select("pid", "x", "y")
    return summary.arith_hash_sample(h, "pid", 500, SAMPLE_SEED)


# ================================================= step 6: logistic models

SPLIT_SEED, TEST_FRAC = 42, 0.25


_LOGIT_DS: dict = {}


def logit_ds(spark, sf) -> DataFrame:
    """M1 over the houses, written once per application and folder: it feeds
    iterative fits, and deriving the model frame from stored columns keeps
    the generated code small."""
    from ..operators import model
    key = session_key(spark, sf)
    if key not in _LOGIT_DS:
        h = inputs.houses(spark, sf)
        _LOGIT_DS[key] = materialize(model.logit_dataset(h, S.column(h, "status"), S.column(h, "year"), CUR_YEAR,
                                                         key="pid"), "logit-dataset")
    return _LOGIT_DS[key]


LOGIT_CTE = f""",
base AS (SELECT pid, {O.status('bothsidesstatus')} AS cat,
                CASE WHEN {O.num('yearstructbuilt')} > 0 AND {O.num('yearstructbuilt')} <= {CUR_YEAR} THEN {O.num('yearstructbuilt')} END AS yb,
                {O.num('MHI')} / 10000e0 AS MHI_10k,
                CAST(coalesce({O.num('J40_TotCatExceeded')}, 0) AS INTEGER) AS J40_TotCatExceeded_num,
                {O.yes_flag('disadvantaged')} AS disadvantaged_num, neighborhood_name FROM fx_house),
ds AS (SELECT pid, CASE WHEN cat = 'Lead' THEN 1 ELSE 0 END AS target_lead, {CUR_YEAR}e0 - yb AS age_years,
              coalesce(CAST(yb >= 1988 AS INTEGER), 0) AS post_1988,
              ({CUR_YEAR}e0 - yb) * coalesce(CAST(yb >= 1988 AS INTEGER), 0) AS age_x_post_1988, yb AS year_built,
              MHI_10k, J40_TotCatExceeded_num, disadvantaged_num, neighborhood_name
       FROM base WHERE cat IN ('Lead', 'Non-Lead') AND yb IS NOT NULL)"""


@register("logit_dataset", with_views([H], LOGIT_CTE + "\nSELECT * FROM ds"))
def q_logit_dataset(spark, sf):
    return logit_ds(spark, sf)


SPLIT_CTE = LOGIT_CTE + f""",
sp AS (SELECT *, row_number() OVER (PARTITION BY target_lead ORDER BY (pid * 7919 + {SPLIT_SEED} * 104729) % 1000003, pid) - 1 AS r,
              ceil(count(*) OVER (PARTITION BY target_lead) * {TEST_FRAC}e0) AS k FROM ds)"""


@register("stratified_split", with_views([H], SPLIT_CTE + "\nSELECT pid, target_lead, r < k AS is_test FROM sp"))
def q_stratified_split(spark, sf):
    from ..operators import model
    return model.stratified_split(logit_ds(spark, sf), "target_lead", "pid", TEST_FRAC, SPLIT_SEED).select(
        "pid", "target_lead", "is_test")


_FITS: dict = {}


def _inference(spark, sf):
    """Terms and statistics of one maximum-likelihood fit, made once per
    application and folder."""
    from ..operators import model
    key = session_key(spark, sf, "ml")
    if key not in _FITS:
        mf, feats = model.model_frame(logit_ds(spark, sf))
        _FITS[key] = model.logit_inference(materialize(mf, "logit-frame"), feats)
    return _FITS[key]


def _stats_frame(spark, st) -> DataFrame:
    return spark.createDataFrame([(st["n_obs"], st["llf"], st["llnull"], st["pseudo_r2_mcfadden"], st["aic"], st["bic"])],
                                 "n_obs long, llf double, llnull double, pseudo_r2_mcfadden double, aic double, bic double")


@register("logit_terms")
def q_logit_terms(spark, sf):
    from ..operators import model
    return spark.createDataFrame(_inference(spark, sf)[0], model.TERMS_SCHEMA)


@register("logit_fit_stats")
def q_logit_fit_stats(spark, sf):
    return _stats_frame(spark, _inference(spark, sf)[1])


# M3/M4 on one 0/1 feature, where the fit has a closed form in the four counts.
BINARY_CTE = LOGIT_CTE + """,
n AS (SELECT CAST(count(*) FILTER (WHERE target_lead = 1 AND post_1988 = 0) AS DOUBLE) AS a,
             CAST(count(*) FILTER (WHERE target_lead = 0 AND post_1988 = 0) AS DOUBLE) AS b,
             CAST(count(*) FILTER (WHERE target_lead = 1 AND post_1988 = 1) AS DOUBLE) AS c,
             CAST(count(*) FILTER (WHERE target_lead = 0 AND post_1988 = 1) AS DOUBLE) AS d FROM ds)"""


def _binary(spark, sf):
    from ..operators import model
    key = session_key(spark, sf, "binary")
    if key not in _FITS:
        _FITS[key] = model.logit_inference(logit_ds(spark, sf).select("target_lead", F.col("post_1988").cast("double")), ["post_1988"])
    return _FITS[key]


@register("logit_binary_terms", with_views([H], BINARY_CTE + """,
t AS (SELECT 'const' AS term, ln(a / b) AS coef, sqrt(1 / a + 1 / b) AS se FROM n
      UNION ALL SELECT 'post_1988', ln(c / d) - ln(a / b), sqrt(1 / a + 1 / b + 1 / c + 1 / d) FROM n)
SELECT term, round(coef, 5) AS coef, round(se, 5) AS std_err, round(coef / se, 4) AS z_value,
       round(exp(coef), 5) AS odds_ratio FROM t"""))
def q_logit_binary_terms(spark, sf):
    from ..operators import model
    t = spark.createDataFrame(_binary(spark, sf)[0], model.TERMS_SCHEMA)
    return t.select("term", F.round("coef", 5).alias("coef"), F.round("std_err", 5).alias("std_err"),
                    F.round("z_value", 4).alias("z_value"), F.round("odds_ratio", 5).alias("odds_ratio"))


@register("logit_binary_stats", with_views([H], BINARY_CTE + """,
l AS (SELECT a + b + c + d AS m, a * ln(a / (a + b)) + b * ln(b / (a + b)) + c * ln(c / (c + d)) + d * ln(d / (c + d)) AS llf,
             (a + c) * ln((a + c) / (a + b + c + d)) + (b + d) * ln((b + d) / (a + b + c + d)) AS llnull FROM n)
SELECT CAST(m AS BIGINT) AS n_obs, round(llf, 4) AS llf, round(llnull, 4) AS llnull, round(1 - llf / llnull, 6) AS pseudo_r2_mcfadden,
       round(-2 * llf + 4, 4) AS aic, round(-2 * llf + 2 * ln(m), 4) AS bic FROM l"""))
def q_logit_binary_stats(spark, sf):
    st = _stats_frame(spark, _binary(spark, sf)[1])
    return st.select("n_obs", *(F.round(c, 6 if c.startswith("pseudo") else 4).alias(c) for c in st.columns[1:]))


def _l2_fit(spark, sf):
    from ..operators import model
    key = session_key(spark, sf, "l2")
    if key not in _FITS:
        mf, feats = model.model_frame(logit_ds(spark, sf))
        mf = materialize(mf, "logit-frame")   # the split reads it three times
        sp = materialize(model.stratified_split(mf, "target_lead", "pid", TEST_FRAC, SPLIT_SEED), "logit-split")
        _FITS[key] = model.fit_l2_logistic(sp.filter(~F.col("is_test")), feats), sp, feats
    return _FITS[key]


@register("logit_l2_coefs")
def q_logit_l2_coefs(spark, sf):
    m, _, feats = _l2_fit(spark, sf)
    return spark.createDataFrame(list(zip(["intercept"] + feats, [float(v) for v in m.coefficients])),
                                 "term string, coef double")


@register("logit_l2_score", with_views([H], LOGIT_CTE + """,
terms AS (SELECT unnest(['intercept', 'age_years', 'post_1988', 'age_x_post_1988', 'MHI_10k', 'J40_TotCatExceeded_num',
                         'disadvantaged_num']) AS term
          UNION ALL SELECT DISTINCT 'neigh_' || neighborhood_name FROM ds
          WHERE neighborhood_name > (SELECT min(neighborhood_name) FROM ds))
SELECT term, 0e0 AS score FROM terms"""))
def q_logit_l2_score(spark, sf):
    """M6 by its defining equations: at the fit, the gradient of the penalised
    likelihood vanishes in every term (mean per row, 5 decimals)."""
    from ..operators import model
    m, sp, feats = _l2_fit(spark, sf)
    scored = model.score(m, sp.filter(~F.col("is_test")), feats)
    off = F.col("score") - F.col("target_lead")
    sums = scored.agg(F.count(F.lit(1)).alias("n"), F.sum(off).alias("g0"),
                      *[F.sum(off * F.col(f"`{f}`")).alias(f"g{i + 1}") for i, f in enumerate(feats)]).first()
    rows = [(t, abs(round((sums[f"g{i}"] + float(m.coefficients[i])) / sums["n"], 5)))
            for i, t in enumerate(["intercept"] + feats)]
    return spark.createDataFrame(rows, "term string, score double")


@register("logit_metrics")
def q_logit_metrics(spark, sf):
    from ..operators import model
    m, sp, feats = _l2_fit(spark, sf)
    return model.classifier_metrics(model.score(m, sp.filter(F.col("is_test")), feats))


# Metrics and confusion of the data's own model score on the test split
SCORED_CTE = SPLIT_CTE + """,
t AS (SELECT s.target_lead AS y, h.ModelScoreForLeadClassification_Cust AS p,
             least(greatest(h.ModelScoreForLeadClassification_Cust, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS pc
      FROM sp s JOIN fx_house h ON h.pid = s.pid WHERE s.r < s.k)"""


def _scored_test(spark, sf) -> DataFrame:
    from ..operators import model
    sp = model.stratified_split(logit_ds(spark, sf), "target_lead", "pid", TEST_FRAC, SPLIT_SEED)
    h = inputs.houses(spark, sf).select("pid", F.col("ModelScoreForLeadClassification_Cust").alias("score"))
    return sp.filter(F.col("is_test")).join(h, "pid").select("target_lead", "score")


@register("classifier_metrics", with_views([H], SCORED_CTE + f""",
g AS (SELECT p, sum(y) AS pos, count(*) - sum(y) AS neg FROM t GROUP BY p),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM g),
auc AS (SELECT sum(pos * (nb + 0.5e0 * neg)) / (sum(pos) * sum(neg)) AS v FROM c),
m AS (SELECT count(*) AS n, sum(CASE WHEN p > 0.5 AND y = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN p > 0.5 AND y = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN p <= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS fn,
             sum(CASE WHEN (p > 0.5) = (y = 1) THEN 1 ELSE 0 END) AS ok,
             avg(-(y * ln(pc) + (1 - y) * ln(1 - pc))) AS ll,
             avg((p - y) * (p - y)) AS brier FROM t),
r AS (SELECT m.*, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS prec,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END AS rec FROM m)
SELECT metric, round(value, 9) AS value FROM (
  SELECT 'auc' AS metric, (SELECT v FROM auc) AS value
  UNION ALL SELECT 'accuracy', ok / n FROM r UNION ALL SELECT 'precision', prec FROM r
  UNION ALL SELECT 'recall', rec FROM r
  UNION ALL SELECT 'f1', CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0e0 END FROM r
  UNION ALL SELECT 'log_loss', ll FROM r UNION ALL SELECT 'brier', brier FROM r) u"""))
def q_classifier_metrics(spark, sf):
    from ..operators import model
    m = model.classifier_metrics(_scored_test(spark, sf))
    return m.select("metric", F.round("value", 9).alias("value"))


@register("confusion", with_views([H], SCORED_CTE + """
SELECT a.actual, coalesce(pred_0, 0) AS pred_0, coalesce(pred_1, 0) AS pred_1
FROM (SELECT 'true_0' AS actual UNION ALL SELECT 'true_1') a LEFT JOIN (
  SELECT 'true_' || CAST(y AS VARCHAR) AS actual, count(*) FILTER (WHERE NOT p > 0.5) AS pred_0,
         count(*) FILTER (WHERE p > 0.5) AS pred_1 FROM t GROUP BY y) c ON a.actual = c.actual"""))
def q_confusion(spark, sf):
    from ..operators import model
    return model.confusion(_scored_test(spark, sf))


# ============================================== step 7: map-layer tables

def _sub(name: str) -> str:
    """A registered oracle query as a subquery (its own WITH clause inside)."""
    return f"({ORACLE[name]})"


def _domain_sql(src: str, col: str, rule: str) -> str:
    base = (f"SELECT quantile_cont({col}, 0.05) AS lo, quantile_cont({col}, 0.95) AS hi, min({col}) AS mn, "
            f"max({col}) AS mx FROM {src} WHERE {col} IS NOT NULL AND NOT isnan({col})")
    if rule == "plain":
        return (f"SELECT CASE WHEN lo = hi THEN mn ELSE lo END AS vmin, CASE WHEN lo = hi THEN mx ELSE hi END AS vmax "
                f"FROM ({base}) b")
    a = (f"SELECT CASE WHEN isfinite(lo) AND isfinite(hi) AND lo <> hi THEN lo ELSE coalesce(nullif(mn, 0), 0e0) END AS vmin, "
         f"CASE WHEN isfinite(lo) AND isfinite(hi) AND lo <> hi THEN hi ELSE coalesce(nullif(mx, 0), 1e0) END AS vmax FROM ({base}) b")
    return f"SELECT vmin, CASE WHEN vmin = vmax THEN vmin + 1 ELSE vmax END AS vmax FROM ({a}) c"


def _house_age_raw(spark, sf) -> DataFrame:
    h = inputs.houses(spark, sf)
    y = X.to_double("yearstructbuilt")
    h = h.filter(X.year_valid(y, CUR_YEAR, "b"))
    return summary.mean_count_by(h, "neighborhood_name", F.lit(float(CUR_YEAR)) - y, "avg_house_age", "n_houses")


HOUSE_AGE_RAW = with_views([H], f"""
SELECT neighborhood_name, avg({CUR_YEAR}e0 - y) AS avg_house_age, count(*) AS n_houses
FROM (SELECT neighborhood_name, {O.num('yearstructbuilt')} AS y FROM fx_house) t
WHERE y > 0 AND y <= {CUR_YEAR} AND neighborhood_name IS NOT NULL GROUP BY neighborhood_name""")


@register("color_domain", f"""
SELECT 'pct_lead_known' AS metric, round(vmin, 9) AS vmin, round(vmax, 9) AS vmax
FROM ({_domain_sql(_sub('lead_by_neighborhood'), 'pct_lead_known', 'plain')}) a
UNION ALL
SELECT 'avg_house_age', round(vmin, 9), round(vmax, 9) FROM ({_domain_sql('(' + HOUSE_AGE_RAW + ')', 'avg_house_age', 'age')}) b""")
def q_color_domain(spark, sf):
    from ..operators import layers
    a = layers.colour_domain(q_lead_by_neighborhood(spark, sf), "pct_lead_known", "plain")
    b = layers.colour_domain(_house_age_raw(spark, sf), "avg_house_age", "age")
    rows = [("pct_lead_known", round(a[0], 9), round(a[1], 9)), ("avg_house_age", round(b[0], 9), round(b[1], 9))]
    return spark.createDataFrame(rows, "metric string, vmin double, vmax double")


def _fill_sql(value: str, stops, nodata, dom: str) -> str:
    return O.linear_colour(value, stops, "d.vmin", "d.vmax", nodata)


@register("color_fill", f"""
SELECT ls.name, ls.pct_lead_known AS value, {O.linear_colour('ls.pct_lead_known', ['#fee8c8', '#fdbb84', '#e34a33'], 'd.vmin', 'd.vmax', '#bdbdbd')} AS fill
FROM {_sub('lead_by_neighborhood')} ls CROSS JOIN ({_domain_sql(_sub('lead_by_neighborhood'), 'pct_lead_known', 'plain')}) d""")
def q_color_fill(spark, sf):
    from ..operators import layers
    ls = materialize(q_lead_by_neighborhood(spark, sf), "lead")
    lo, hi = layers.colour_domain(ls, "pct_lead_known", "plain")
    return ls.select("name", F.col("pct_lead_known").alias("value"),
                     layers.linear_colour(F.col("pct_lead_known"), layers.ORANGES, lo, hi).alias("fill"))


@register("bivariate_fill", f"""
SELECT c.name, c.avg_income, c.pct_black,
  {O.linear_colour('c.avg_income', ['#fee8c8', '#fdbb84', '#e34a33'], 'di.vmin', 'di.vmax', '#bdbdbd')} AS fill,
  {O.linear_colour('c.pct_black', ['#eff3ff', '#bdd7e7', '#6baed6', '#3182bd', '#08519c'], 'dr.vmin', 'dr.vmax', '#969696')} AS stroke
FROM {_sub('combined_full_join')} c
CROSS JOIN ({_domain_sql(_sub('combined_full_join'), 'avg_income', 'plain')}) di
CROSS JOIN ({_domain_sql(_sub('combined_full_join'), 'pct_black', 'plain')}) dr""")
def q_bivariate_fill(spark, sf):
    from ..operators import layers
    c = materialize(q_combined_full_join(spark, sf), "combined")
    inc = S.columns(c, "income")[0]
    race = "pct_black" if "pct_black" in c.columns else [k for k in c.columns if k.startswith("pct_")][0]
    di = layers.colour_domain(c, inc, "plain")
    dr = layers.colour_domain(c, race, "plain")
    return c.select("name", inc, race,
                    layers.linear_colour(F.col(inc), layers.ORANGES, *di, nodata=layers.NODATA_FILL).alias("fill"),
                    layers.linear_colour(F.col(race), layers.BLUES5, *dr, nodata=layers.NODATA_STROKE).alias("stroke"))


DENSITY_CELL = 100.0


@register("point_density", with_views([H], f"""
SELECT (gx + 0.5) * {DENSITY_CELL}e0 AS x, (gy + 0.5) * {DENSITY_CELL}e0 AS y, count(*) AS weight
FROM (SELECT floor(x / {DENSITY_CELL}e0) AS gx, floor(y / {DENSITY_CELL}e0) AS gy FROM fx_house) t GROUP BY gx, gy"""))
def q_point_density(spark, sf):
    from ..operators import layers
    return layers.point_density(inputs.houses(spark, sf), DENSITY_CELL)


@register("point_layer", with_views([H], """
SELECT x, y, 'bothsidesstatus: ' || coalesce(bothsidesstatus, 'None') || '; neighborhood_name: '
       || coalesce(neighborhood_name, 'None') AS label FROM fx_house"""))
def q_point_layer(spark, sf):
    from ..operators import layers
    return layers.point_layer(inputs.houses(spark, sf), label_cols=["bothsidesstatus", "neighborhood_name"])


@register("quantile_classes", f"""
SELECT a.neighborhood_name, a.avg_house_age, CASE """ + " ".join(
    f"WHEN a.avg_house_age <= q.b[{i + 1}] THEN {i}" for i in range(5)) + f""" ELSE 4 END AS qclass
FROM ({HOUSE_AGE_RAW}) a CROSS JOIN (SELECT quantile_cont(avg_house_age, [0.2, 0.4, 0.6, 0.8, 1.0]) AS b FROM ({HOUSE_AGE_RAW}) z) q""")
def q_quantile_classes(spark, sf):
    from ..operators import layers
    a = materialize(_house_age_raw(spark, sf), "house-age")
    bins = layers.quantile_bins(a, "avg_house_age", 5)
    return a.select("neighborhood_name", "avg_house_age", layers.quantile_class(F.col("avg_house_age"), bins).alias("qclass"))


def _geojson_sql(node_view: str) -> str:
    return (f"SELECT gid, '{{\"type\":\"Polygon\",\"coordinates\":[[' || string_agg(printf('[%.3f,%.3f]', x, y), ',' ORDER BY k) "
            f"|| ',' || max(CASE WHEN k = 0 THEN printf('[%.3f,%.3f]', x, y) END) || ']]}}' AS geojson FROM {node_view} GROUP BY gid")


@register("choropleth_layer", with_views(NBH, f""",
geo AS ({_geojson_sql('fx_nbh_node')}),
ls AS {_sub('lead_by_neighborhood')},
d AS ({_domain_sql('ls', 'pct_lead_known', 'plain')}),
sc AS (SELECT quantile_cont(pct_lead_known, 0.95) <= 1 AS s100 FROM ls WHERE pct_lead_known IS NOT NULL)
SELECT n.name, geo.geojson, ls.pct_lead_known AS value,
  CASE WHEN ls.pct_lead_known IS NULL THEN 'No data'
       ELSE CAST(round_even(ls.pct_lead_known * (CASE WHEN sc.s100 THEN 100e0 ELSE 1e0 END) * 10e0, 0) / 10e0 AS VARCHAR) || '%' END AS display,
  {O.linear_colour('ls.pct_lead_known', ['#fee8c8', '#fdbb84', '#e34a33'], 'd.vmin', 'd.vmax', '#bdbdbd')} AS fill
FROM fx_nbh n JOIN geo ON geo.gid = n.gid LEFT JOIN ls ON ls.name = n.name CROSS JOIN d CROSS JOIN sc"""))
def q_choropleth_layer(spark, sf):
    from ..operators import layers
    from .inputs import _fx
    _fx(spark, sf)
    nb = inputs.neighborhoods(spark, sf)
    geo = layers.ring_geojson(spark.table("fx_nbh_node"))
    ls = materialize(q_lead_by_neighborhood(spark, sf).select("name", "pct_lead_known"), "lead")
    lo, hi = layers.colour_domain(ls, "pct_lead_known", "plain")
    (p95,) = layers.quantiles(ls, "pct_lead_known", [0.95])
    j = nb.attrs.select("gid", "name").join(geo, "gid").join(ls.select("name", "pct_lead_known"), "name", "left")
    return j.select("name", "geojson", F.col("pct_lead_known").alias("value"),
                    layers.percent_text(F.col("pct_lead_known"), p95 <= 1).alias("display"),
                    layers.linear_colour(F.col("pct_lead_known"), layers.ORANGES, lo, hi).alias("fill"))


@register("boundary_overlay", with_views(NBH + TR, f"""
SELECT 'neighborhoods' AS layer, gid, geojson FROM ({_geojson_sql('fx_nbh_node')}) a
UNION ALL SELECT 'tracts', gid, geojson FROM ({_geojson_sql('fx_tract_node')}) b"""))
def q_boundary_overlay(spark, sf):
    from ..operators import layers
    from .inputs import _fx
    _fx(spark, sf)
    a = layers.ring_geojson(spark.table("fx_nbh_node")).select(F.lit("neighborhoods").alias("layer"), "gid", "geojson")
    b = layers.ring_geojson(spark.table("fx_tract_node")).select(F.lit("tracts").alias("layer"), "gid", "geojson")
    return a.unionByName(b)


# ============================================ step 8: sources and sinks

def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster: ``spark.checkpoint.dir`` names shared storage there)."""
    import os
    import uuid
    from ..session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:10]}")


def _nbh_vertices(spark, sf) -> DataFrame:
    from ..operators.polygons import vertices_from_nodes
    from .inputs import _fx
    _fx(spark, sf)
    return vertices_from_nodes(spark.table("fx_nbh_node")).withColumn("ring", F.lit(0)).withColumn(
        "gid", F.col("gid").cast("long"))


def _tract_vertices(spark, sf) -> DataFrame:
    from ..operators.polygons import vertices_from_nodes
    from .inputs import _fx
    _fx(spark, sf)
    return vertices_from_nodes(spark.table("fx_tract_node")).withColumn("ring", F.lit(0)).withColumn(
        "gid", F.col("gid").cast("long"))


def _measure_round(v: DataFrame, layer: str) -> DataFrame:
    from ..operators.polygons import edges_from_vertices, polygon_measures
    m = polygon_measures(edges_from_vertices(v))
    return m.select(F.lit(layer).alias("layer"), "gid", "xmin", "ymin", "xmax", "ymax",
                    F.round("area", 3).alias("area"), F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@register("geoparquet_scan", ORACLE["polygon_measures"])
def q_geoparquet_scan(spark, sf):
    from ..sources import geo_io
    path = _scratch(spark, "wkb")
    nb = geo_io.to_wkb(_nbh_vertices(spark, sf)).withColumn("layer", F.lit("nbh"))
    tr = geo_io.to_wkb(_tract_vertices(spark, sf)).withColumn("layer", F.lit("tract"))
    nb.unionByName(tr).write.mode("overwrite").partitionBy("layer").parquet(path)
    back = spark.read.parquet(path)
    out = None
    for layer in ("nbh", "tract"):
        v = geo_io.from_wkb(back.filter(F.col("layer") == layer))
        m = _measure_round(v, layer)
        out = m if out is None else out.unionByName(m)
    return out


@register("geom_type_profile", with_views(NBH + TR + [H], """
SELECT 'neighborhoods' AS layer, 'Polygon' AS geom_types, count(*) AS n_features, true AS polygonal FROM fx_nbh
UNION ALL SELECT 'tracts', 'Polygon', count(*), true FROM fx_tract
UNION ALL SELECT 'houses', 'Point', count(*), false FROM fx_house"""))
def q_geom_type_profile(spark, sf):
    from ..sources import geo_io
    nb = geo_io.to_wkb(_nbh_vertices(spark, sf)).withColumn("layer", F.lit("neighborhoods"))
    tr = geo_io.to_wkb(_tract_vertices(spark, sf)).withColumn("layer", F.lit("tracts"))
    polys = nb.unionByName(tr).withColumn("gt", geo_io.geometry_type_from_wkb("wkb"))
    pts = inputs.houses(spark, sf).select(F.lit("houses").alias("layer"), F.lit("Point").alias("gt"))
    u = polys.select("layer", "gt").unionByName(pts)
    g = u.groupBy("layer").agg(F.array_join(F.sort_array(F.collect_set("gt")), ",").alias("geom_types"),
                               F.count(F.lit(1)).alias("n_features"),
                               F.bool_and(F.col("gt").isin("Polygon", "MultiPolygon")).alias("polygonal"))
    return g


@register("geojson_scan", with_views(NBH, f"""
SELECT CAST(m.gid AS BIGINT) AS gid, n.name, m.area, m.cx, m.cy FROM ({_measure_sql('fx_nbh_edge', 'nbh')}) m JOIN fx_nbh n ON n.gid = m.gid"""))
def q_geojson_scan(spark, sf):
    from ..sources import geo_io
    v = _nbh_vertices(spark, sf)
    path = _scratch(spark, "geojson")
    nb = inputs.neighborhoods(spark, sf).attrs.select(F.col("gid").cast("long").alias("gid"), "name")
    geo_io.write_geojson_seq(nb, geo_io.polygons_geojson_geometry(v), path, ["gid", "name"])
    back = geo_io.read_geojson(spark, path, "gid BIGINT, name STRING")
    m = _measure_round(geo_io.geojson_vertices(back), "nbh")
    return m.join(back.select("gid", "name"), "gid").select("gid", "name", "area", "cx", "cy")


@register("point_layer_io", with_views([H], """
SELECT f AS format, pid, x, y, t AS geom_type FROM fx_house, (VALUES ('geojson', 'Point'), ('wkb', 'Point')) AS v(f, t)"""))
def q_point_layer_io(spark, sf):
    """S6/S7, K2/K3 on a point layer: written and read in both formats."""
    from ..sources import geo_io
    pts = inputs.houses(spark, sf).select(F.col("pid").cast("long").alias("gid"), "x", "y")
    path = _scratch(spark, "points")
    geo_io.write_geojson_seq(pts.select("gid"), geo_io.points_geojson_geometry(pts), path + "/geojson", ["gid"])
    geo_io.points_to_wkb(pts).write.parquet(path + "/wkb")
    gj = geo_io.read_geojson(spark, path + "/geojson", "gid BIGINT")
    wkb = spark.read.parquet(path + "/wkb")
    one = geo_io.geojson_vertices(gj).join(gj.select("gid", F.col("gtype").alias("t")), "gid")
    two = geo_io.from_wkb(wkb).join(wkb.select("gid", geo_io.geometry_type_from_wkb("wkb").alias("t")), "gid")
    return one.select(F.lit("geojson").alias("format"), F.col("gid").alias("pid"), "x", "y", F.col("t").alias("geom_type")).unionByName(
        two.select(F.lit("wkb").alias("format"), F.col("gid").alias("pid"), "x", "y", F.col("t").alias("geom_type")))


CSV_POINT_SCHEMA = "pid STRING, lon DOUBLE, lat DOUBLE, bothsidesstatus STRING, yearstructbuilt STRING"
NULL_LIST = ", ".join("'" + t + "'" for t in X.NULL_TOKENS)


@register("csv_points", with_views([H], f"""
SELECT CAST(pid AS VARCHAR) AS pid, x, y,
       CASE WHEN bothsidesstatus IN ({NULL_LIST}) THEN NULL ELSE bothsidesstatus END AS bothsidesstatus,
       CASE WHEN yearstructbuilt IN ({NULL_LIST}) THEN NULL ELSE yearstructbuilt END AS yearstructbuilt
FROM fx_house"""))
def q_csv_points(spark, sf):
    from ..sources import geo_io
    path = _scratch(spark, "csv")
    h = inputs.houses(spark, sf).select("pid", F.col("x").alias("lon"), F.col("y").alias("lat"),
                                       "bothsidesstatus", "yearstructbuilt")
    (h.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
      .option("ignoreTrailingWhiteSpace", False).csv(path))
    back = geo_io.read_csv_points(spark, path, CSV_POINT_SCHEMA, null_cols=["bothsidesstatus", "yearstructbuilt"])
    return back.select("pid", "x", "y", "bothsidesstatus", "yearstructbuilt")


PAGE_SCHEMA = "pid BIGINT, x DOUBLE, y DOUBLE, bothsidesstatus STRING, yearstructbuilt STRING"


@register("paged_scan", with_views([H], "\nSELECT pid, x, y, bothsidesstatus, yearstructbuilt FROM fx_house"))
def q_paged_scan(spark, sf):
    from ..sources import paged
    root = _scratch(spark, "pages")
    h = inputs.houses(spark, sf).select("pid", "x", "y", "bothsidesstatus", "yearstructbuilt")
    paged.stage_pages(h, "pid", root)
    return paged.read_paged(spark, PAGE_SCHEMA, fetcher="parcelkit.sources.paged:FilePages", root=root)


@register("paged_scan_pushdown", with_views([H], """
SELECT pid, x, y, bothsidesstatus, yearstructbuilt FROM fx_house
WHERE yearstructbuilt IS NOT NULL AND pid >= 1000 AND bothsidesstatus IN ('Lead', 'yes')"""))
def q_paged_scan_pushdown(spark, sf):
    """S12 with source-side pushdown: the filters reach the page fetcher."""
    from ..sources import paged
    root = _scratch(spark, "pages")
    h = inputs.houses(spark, sf).select("pid", "x", "y", "bothsidesstatus", "yearstructbuilt")
    paged.stage_pages(h, "pid", root)
    df = paged.read_paged(spark, PAGE_SCHEMA, pushdown=True, fetcher="parcelkit.sources.paged:FilePages", root=root)
    return df.filter(F.col("yearstructbuilt").isNotNull() & (F.col("pid") >= 1000)
                     & F.col("bothsidesstatus").isin("Lead", "yes"))


@register("union_pages", with_views(TR, """
SELECT CAST(gid AS BIGINT) AS gid, GEOID, NAME, totalE, WhiteE, CAST(NULL AS DOUBLE) AS avg_income, CAST(NULL AS BIGINT) AS Households FROM fx_tract
UNION ALL
SELECT CAST(gid AS BIGINT), GEOID, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), avg_income, Households FROM fx_tract"""))
def q_union_pages(spark, sf):
    t = inputs.tracts(spark, sf).attrs
    race = t.select(F.col("gid").cast("long").alias("gid"), "GEOID", "NAME", "totalE", "WhiteE")
    inc = t.select(F.col("gid").cast("long").alias("gid"), "GEOID", "avg_income", "Households")
    return race.unionByName(inc, allowMissingColumns=True)


@register("dedup_first", with_views(TR, """
SELECT url, arg_min(NAME, gid) AS name, min(gid) AS position
FROM (SELECT 'layer/' || CAST(gid % 37 AS VARCHAR) AS url, NAME, gid FROM fx_tract) t GROUP BY url"""))
def q_dedup_first(spark, sf):
    t = inputs.tracts(spark, sf).attrs.select(
        F.concat(F.lit("layer/"), (F.col("gid") % 37).cast("string")).alias("url"),
        F.col("NAME").alias("name"), F.col("gid").alias("position"))
    return summary.first_by_position(t, "url", "position", ["name"])


def _in_degrees(v: DataFrame) -> DataFrame:
    return v.withColumn("x", F.lit(CENTRE_LON) + F.col("x") * F.lit(1e-5)).withColumn(
        "y", F.lit(CENTRE_LAT) + F.col("y") * F.lit(1e-5))


def _house_vertices(spark, sf) -> DataFrame:
    """Houses as a point layer; negative ids keep apart from polygons."""
    return inputs.houses(spark, sf).select(
        (-F.col("pid")).cast("long").alias("gid"), F.lit(0).alias("part"), F.lit("point").alias("role"),
        F.lit(0).alias("ord"), "x", "y", F.lit(0).alias("ring"))


_MX, _MY = O.mercator_forward(f"({O.dbl(CENTRE_LON)} + x * 1e-5)", f"({O.dbl(CENTRE_LAT)} + y * 1e-5)")


@register("csv_mirror", with_views(NBH, f""",
mv AS (SELECT e.gid, {_MX.replace('x *', 'e.x1 *').replace('y *', 'e.y1 *')} AS x1,
              {_MY.replace('x *', 'e.x1 *').replace('y *', 'e.y1 *')} AS y1,
              {_MX.replace('x *', 'e.x2 *').replace('y *', 'e.y2 *')} AS x2,
              {_MY.replace('x *', 'e.x2 *').replace('y *', 'e.y2 *')} AS y2 FROM fx_nbh_edge e),
{O.bbox_area_cte('mv', 'mm')},
cen AS (SELECT m.gid,
          m.xmin + sum(((e.x1 - m.xmin) + (e.x2 - m.xmin)) * ((e.x1 - m.xmin) * (e.y2 - m.ymin) - (e.x2 - m.xmin) * (e.y1 - m.ymin))) / (6 * m.area) AS cx,
          m.ymin + sum(((e.y1 - m.ymin) + (e.y2 - m.ymin)) * ((e.x1 - m.xmin) * (e.y2 - m.ymin) - (e.x2 - m.xmin) * (e.y1 - m.ymin))) / (6 * m.area) AS cy
        FROM mv e JOIN mm m ON m.gid = e.gid GROUP BY m.gid, m.xmin, m.ymin, m.area)
SELECT gid, name, centroid_lon, centroid_lat, centroid_lon AS x, centroid_lat AS y FROM (
SELECT n.gid, n.name, round(degrees(cx / {O.dbl(G.MERCATOR_R)}), 9) AS centroid_lon,
       round(degrees(2e0 * atan(exp(cy / {O.dbl(G.MERCATOR_R)})) - {O.dbl(3.141592653589793 / 2)}), 9) AS centroid_lat
FROM cen JOIN fx_nbh n ON n.gid = cen.gid) t"""))
def q_csv_mirror(spark, sf):
    from ..sources import geo_io
    c = geo_io.mirror_coordinates(_in_degrees(_nbh_vertices(spark, sf))).select(
        "gid", *[F.round(k, 9).alias(k) for k in ("centroid_lon", "centroid_lat")])
    nb = inputs.neighborhoods(spark, sf).attrs.select(F.col("gid").cast("long").alias("gid"), "name")
    path = _scratch(spark, "mirror")
    geo_io.write_csv(nb.join(c, "gid"), path)
    # Read back as a point layer from centroid_lon / centroid_lat
    back = geo_io.read_csv_points(spark, path, "gid INT, name STRING, centroid_lon DOUBLE, centroid_lat DOUBLE",
                                  x="centroid_lon", y="centroid_lat")
    return back.select("gid", "name", "centroid_lon", "centroid_lat", "x", "y")


_DEGREES = f"{O.dbl(CENTRE_LON)} + x * 1e-5 AS lon, {O.dbl(CENTRE_LAT)} + y * 1e-5 AS lat"


@register("csv_mirror_points", with_views([H], f"""
SELECT -pid AS gid, round(lon, 9) AS lon, round(lat, 9) AS lat FROM (SELECT pid, {_DEGREES} FROM fx_house) t"""))
def q_csv_mirror_points(spark, sf):
    """K4 on a layer of points only."""
    from ..sources import geo_io
    c = geo_io.mirror_coordinates(_in_degrees(_house_vertices(spark, sf)))
    return c.select("gid", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"))


@register("csv_mirror_mixed", with_views(NBH + [H], f"""
SELECT gid, round(centroid_lon, 7) AS centroid_lon, round(centroid_lat, 7) AS centroid_lat FROM {_sub('csv_mirror')} a
UNION ALL SELECT -pid, round(lon, 7), round(lat, 7) FROM (SELECT pid, {_DEGREES} FROM fx_house) t"""))
def q_csv_mirror_mixed(spark, sf):
    """K4 on a layer of polygons and points."""
    from ..sources import geo_io
    both = _nbh_vertices(spark, sf).unionByName(_house_vertices(spark, sf), allowMissingColumns=True)
    c = geo_io.mirror_coordinates(_in_degrees(both))
    return c.select("gid", *[F.round(k, 7).alias(k) for k in ("centroid_lon", "centroid_lat")])


# ===================================== remaining inventory items (A19, A20, ...)

@register("column_facts", with_views([H], """
SELECT 'neighborhood_name' AS variable, bool_or(neighborhood_name IS NOT NULL) AS any_value,
       count(DISTINCT neighborhood_name) AS n_distinct, count(*) FILTER (WHERE neighborhood_name IS NULL) AS n_null,
       count(neighborhood_name) AS n_notnull FROM fx_house
UNION ALL
SELECT 'ModelClassification_Cust', bool_or(ModelClassification_Cust IS NOT NULL), count(DISTINCT ModelClassification_Cust),
       count(*) FILTER (WHERE ModelClassification_Cust IS NULL), count(ModelClassification_Cust) FROM fx_house"""))
def q_column_facts(spark, sf):
    h = inputs.houses(spark, sf)
    a = summary.column_facts(h, "neighborhood_name").withColumn("variable", F.lit("neighborhood_name"))
    b = summary.column_facts(h, "ModelClassification_Cust").withColumn("variable", F.lit("ModelClassification_Cust"))
    return a.unionByName(b)


@register("lead_summary_earlier", f"""
SELECT name, "Lead", "Non-Lead", "Unknown", total_points, known_points, pct_lead_known AS pct_known_lead,
       pct_nonlead_known AS pct_known_nonlead, pct_unknown, pct_lead_total AS pct_known_lead_total,
       pct_nonlead_total AS pct_known_nonlead_total FROM {_sub('lead_by_neighborhood')} ls""")
def q_lead_summary_earlier(spark, sf):
    return summary.rename_earlier_summary(q_lead_by_neighborhood(spark, sf))


@register("safe_names", with_views(TR, """
SELECT gid, NAME, regexp_replace(regexp_replace(trim(NAME), '[^A-Za-z0-9_\\-]+', '_', 'g'), '^_+|_+$', '', 'g') AS safe_name
FROM fx_tract"""))
def q_safe_names(spark, sf):
    t = inputs.tracts(spark, sf).attrs
    return t.select("gid", "NAME", X.sanitize_name("NAME").alias("safe_name"))


@register("one_hot", with_views([H], LOGIT_CTE + """,
lv AS (SELECT DISTINCT neighborhood_name AS lv FROM ds WHERE neighborhood_name IS NOT NULL),
kept AS (SELECT lv FROM lv WHERE lv > (SELECT min(lv) FROM lv))
SELECT d.pid, 'neigh_' || k.lv AS dummy, CASE WHEN d.neighborhood_name = k.lv THEN 1 ELSE 0 END AS value
FROM ds d CROSS JOIN kept k"""))
def q_one_hot(spark, sf):
    """M2 in long form (pid, dummy, value): one row per house and kept level."""
    from ..operators import model
    ds = logit_ds(spark, sf)
    wide, names = model.one_hot_drop_first(ds, "neighborhood_name")
    long = wide.select("pid", F.explode(F.array(*[F.struct(F.lit(n).alias("dummy"), F.col(f"`{n}`").alias("value"))
                                                  for n in names])).alias("r"))
    return long.select("pid", "r.dummy", "r.value")


@register("invalid_rings", with_views(NBH + TR, """
SELECT CAST(NULL AS BIGINT) AS gid, CAST(NULL AS INTEGER) AS part, CAST(NULL AS VARCHAR) AS role,
       CAST(NULL AS BIGINT) AS n_crossings WHERE false"""))
def q_invalid_rings(spark, sf):
    """G3 report over both fixture layers (valid lattices: no rows expected)."""
    from ..operators.polygons import invalid_rings
    v = _nbh_vertices(spark, sf).drop("ring").unionByName(
        _tract_vertices(spark, sf).drop("ring").withColumn("gid", F.col("gid") + F.lit(1_000_000)))
    return invalid_rings(v, cell=250.0).select(F.col("gid").cast("long").alias("gid"), "part", "role", "n_crossings")


@register("flat_master_csv", ORACLE["house_master"])
def q_flat_master_csv(spark, sf):
    """K6: the master without geometry written as CSV and read back. Every
    point comes once per pair of tracts, so the files are packed."""
    from ..sources import geo_io
    path = _scratch(spark, "master")
    m = house_master_df(spark, sf).select("pid", "nbh_name", "race_tract_id", "race_Pwhite", "race_Pblack",
                                          "inc_tract_id", "inc_avg_income")
    geo_io.write_csv(m, path, packed=True)
    return geo_io.read_csv_points(spark, path, "pid BIGINT, nbh_name STRING, race_tract_id STRING, race_Pwhite DOUBLE, "
                                               "race_Pblack DOUBLE, inc_tract_id STRING, inc_avg_income DOUBLE")


# ========================================= streaming form of the flagship

@register("lead_stream", ORACLE["lead_by_neighborhood"])
def q_lead_stream(spark, sf):
    """The lead summary computed by Structured Streaming: the houses land as
    two batches of files, the stream (stream-static PIP join + stateful
    counts) drains them with ``availableNow``; equals the batch result."""
    import os
    import uuid
    from ..streaming import lead_stream
    root = _scratch(spark, "stream")
    h = inputs.houses(spark, sf).select("pid", "x", "y", "bothsidesstatus", "yearstructbuilt")
    h.filter(F.col("pid") % 2 == 0).write.parquet(os.path.join(root, "in", "a"))
    h.filter(F.col("pid") % 2 == 1).write.parquet(os.path.join(root, "in", "b"))
    nb = inputs.neighborhoods(spark, sf)
    schema = "pid BIGINT, x DOUBLE, y DOUBLE, bothsidesstatus STRING, yearstructbuilt STRING"
    s = lead_stream.lead_count_stream(spark, os.path.join(root, "in", "*"), schema, nb.index,
                                      nb.attrs.select("gid", "name"), max_files_per_trigger=1)
    name = f"lead_counts_{uuid.uuid4().hex[:8]}"
    lead_stream.run_available(s, name, os.path.join(root, "ckpt"))
    return lead_stream.summary_from_counts(spark.table(name), CUR_YEAR)
