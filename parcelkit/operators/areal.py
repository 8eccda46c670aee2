"""Areal re-aggregation: match table and tract -> neighborhood statistics
(A1-A6, J4, J6-J8, J11, J12).

The match table (neighborhood, tract, intersection area, both base areas,
both fractions) is the central derived relation; every statistic is a
``groupBy(neighborhood).agg(sum(value * weight))`` over it after a left
join to the tract attributes. The tract attribute side is broadcast only
behind a measured size bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as X
from .sizing import broadcast_if_bounded
from .spatial import overlay_areas

# Fixed values of the tiered city filter (F1): exact county-equivalent id
# prefix, looser state/independent-city prefix, and the name phrase.
CITY_ID_PREFIX = "51760"
LOOSE_ID_PREFIX = "517"
CITY_NAME_PHRASE = "richmond city"


def match_table(nbh_edges: DataFrame, nbh_meas: DataFrame, nbh_names: DataFrame,
                tr_edges: DataFrame, tr_meas: DataFrame, tr_ids: DataFrame,
                cell: float | None = None, overlay: DataFrame | None = None) -> DataFrame:
    """A3: ``neighborhood, tract_id, intersection_area_m2, neighborhood_area_m2,
    tract_area_m2, frac_of_neighborhood, frac_of_tract`` (fractions 0 when the
    base area is 0). ``nbh_names``: ``gid, neighborhood``; ``tr_ids``:
    ``gid, tract_id`` (string)."""
    ov = overlay if overlay is not None else overlay_areas(nbh_edges, nbh_meas, tr_edges, tr_meas, cell=cell)
    na = nbh_meas.select(F.col("gid").alias("a_gid"), F.col("area").alias("neighborhood_area_m2"))
    ta = tr_meas.select(F.col("gid").alias("b_gid"), F.col("area").alias("tract_area_m2"))
    m = (ov.join(na, "a_gid").join(ta, "b_gid")
           .join(nbh_names.withColumnRenamed("gid", "a_gid"), "a_gid")
           .join(tr_ids.withColumnRenamed("gid", "b_gid"), "b_gid"))
    return m.select(
        "neighborhood", "tract_id", F.col("inter_area").alias("intersection_area_m2"),
        "neighborhood_area_m2", "tract_area_m2",
        X.safe_ratio(F.col("inter_area"), F.col("neighborhood_area_m2")).alias("frac_of_neighborhood"),
        X.safe_ratio(F.col("inter_area"), F.col("tract_area_m2")).alias("frac_of_tract"))


def sort_matches(m: DataFrame) -> DataFrame:
    """K5/O1: neighborhood ascending, frac_of_neighborhood descending."""
    return m.orderBy(F.col("neighborhood").asc(), F.col("frac_of_neighborhood").desc())


def _attach(matches: DataFrame, tracts: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """Matches LEFT JOIN tract attributes on the id compared as strings."""
    t = tracts.select(F.col(id_col).cast("string").alias("_tid"), *[F.col(c) for c in cols])
    t = broadcast_if_bounded(t)
    m = matches.withColumn("_mid", F.col("tract_id").cast("string"))
    return m.join(t, m["_mid"] == t["_tid"], "left").drop("_mid", "_tid").filter(F.col("neighborhood").isNotNull())


def _num0(c) -> Column:
    return F.coalesce(X.to_double(c), F.lit(0.0))


def race_shares_from_matches(matches: DataFrame, tracts: DataFrame, id_col: str,
                             counts: dict[str, str | None], out_group: str = "neighborhood") -> DataFrame:
    """A4: ``pct_k = sum(count_k * f) / sum(total * f)`` with f = frac_of_tract;
    missing counts and fractions -> 0; a zero total gives 0."""
    keys = ["white", "black", "hispanic", "asian", "native", "hipi"]
    cols = [c for c in counts.values() if c]
    j = _attach(matches, tracts, id_col, sorted(set(cols)))
    f = _num0("frac_of_tract")
    aggs = [F.sum(_num0(counts["total"]) * f).alias("_tot")]
    for k in keys:
        src = counts.get(k)
        aggs.append((F.sum(_num0(src) * f) if src else F.lit(0.0)).alias(f"_{k}"))
    g = j.groupBy("neighborhood").agg(*aggs)
    return g.select(F.col("neighborhood").alias(out_group),
                    *[X.ratio_or_zero(F.col(f"_{k}"), F.col("_tot")).alias(f"pct_{k}") for k in keys])


def pct_fallback_from_matches(matches: DataFrame, tracts: DataFrame, id_col: str, pct_cols: list[str],
                              out_group: str = "neighborhood") -> DataFrame:
    """A5: ``sum(p * f) / max(sum(f), 1e-9)`` per percentage column, renamed
    ``pct_<name without its first letter, lower-cased>``."""
    j = _attach(matches, tracts, id_col, pct_cols)
    f = _num0("frac_of_tract")
    aggs = [F.sum(f).alias("_f")] + [F.sum(_num0(p) * f).alias(f"_{p}") for p in pct_cols]
    g = j.groupBy("neighborhood").agg(*aggs)
    return g.select(F.col("neighborhood").alias(out_group),
                    *[X.ratio_floor(F.col(f"_{p}"), F.col("_f")).alias(f"pct_{p[1:].lower()}") for p in pct_cols])


def weighted_mean_from_matches(matches: DataFrame, tracts: DataFrame, id_col: str, value_cols: list[str],
                               weight_col: str | None, out_group: str = "neighborhood") -> DataFrame:
    """weight = ``weight_col * frac_of_tract`` (or ``frac_of_tract``);
    a missing value counts 0 in the numerator and keeps its weight in the
    denominator; denominator floored at 1e-9."""
    cols = list(value_cols) + ([weight_col] if weight_col else [])
    j = _attach(matches, tracts, id_col, cols)
    f = _num0("frac_of_tract")
    w = _num0(weight_col) * f if weight_col else f
    aggs = [F.sum(w).alias("_w")] + [F.sum(_num0(c) * w).alias(f"_{c}") for c in value_cols]
    g = j.groupBy("neighborhood").agg(*aggs)
    return g.select(F.col("neighborhood").alias(out_group),
                    *[X.ratio_floor(F.col(f"_{c}"), F.col("_w")).alias(c) for c in value_cols])


# ----------------------------------------------------- direct overlay forms

def clipped_tract_area(overlay: DataFrame) -> DataFrame:
    """Area of each tract inside the union of neighborhoods, as the sum
    of its pieces (valid when neighborhoods do not overlap; see
    ``overlapping_pairs``). Tracts outside every neighborhood drop out."""
    return overlay.groupBy("b_gid").agg(F.sum("inter_area").alias("clipped_area"))


def overlapping_pairs(overlay_self: DataFrame) -> DataFrame:
    """Pairs of distinct neighborhoods with a positive-area overlap (self-J3)."""
    return overlay_self.filter(F.col("a_gid") < F.col("b_gid"))


def layer_has_overlaps(edges: DataFrame, meas: DataFrame) -> bool:
    """Whether any two polygons of a layer overlap with positive area (self-J3)."""
    from .spatial import overlay_areas
    return not overlapping_pairs(overlay_areas(edges, meas, edges, meas)).isEmpty()


def clip_area(overlay: DataFrame, nbh_edges: DataFrame, nbh_meas: DataFrame, tr_edges: DataFrame,
              overlaps: bool | None = None) -> DataFrame:
    """J11 in general: the sum of pieces when neighborhoods do not overlap
    (decided by one self-overlay, or by ``overlaps`` when already known),
    else the sum of a tract's pieces with the union of the neighborhoods, made
    once as a layer of disjoint trapezoids. ``overlay`` is of the whole layers;
    its pairs are not read where neighborhoods overlap, as they may grow with
    the square of the polygons."""
    from .polygons import polygon_measures
    from .union_area import union_layer
    if overlaps is None:
        overlaps = layer_has_overlaps(nbh_edges, nbh_meas)
    if not overlaps:
        return clipped_tract_area(overlay)
    edges, meas = union_layer(nbh_edges)
    return clipped_tract_area(overlay_areas(edges, meas, tr_edges, polygon_measures(tr_edges)))


def areal_shares(overlay: DataFrame, tracts: DataFrame, counts: dict[str, str | None],
                 clip: DataFrame | None = None) -> DataFrame:
    """A1: ``w = piece area / clipped tract area`` (the piece's own tract);
    ``pct_k = sum(count_k * w) / sum(total * w)``, 0 when the total <= 0.
    ``overlay``: ``a_gid, b_gid, inter_area``; ``tracts`` keyed by ``gid``."""
    keys = ["white", "black", "hispanic", "asian", "native", "hipi"]
    if clip is None:
        clip = clipped_tract_area(overlay)
    t = broadcast_if_bounded(tracts.select(F.col("gid").alias("b_gid"),
                                           *[F.col(c) for c in sorted({c for c in counts.values() if c})]))
    j = overlay.join(clip, "b_gid").join(t, "b_gid", "left")
    w = F.coalesce(F.col("inter_area") / F.nullif(F.col("clipped_area"), F.lit(0.0)), F.lit(0.0))
    aggs = [F.sum(_num0(counts["total"]) * w).alias("_tot")]
    for k in keys:
        src = counts.get(k)
        aggs.append((F.sum(_num0(src) * w) if src else F.lit(0.0)).alias(f"_{k}"))
    g = j.groupBy("a_gid").agg(*aggs)
    return g.select(F.col("a_gid").alias("gid"),
                    *[F.when(F.col("_tot") > 0, F.col(f"_{k}") / F.col("_tot")).otherwise(F.lit(0.0))
                      .alias(f"pct_{k}") for k in keys])


def areal_weighted_mean(overlay: DataFrame, tr_meas: DataFrame, tracts: DataFrame, value_cols: list[str],
                        weight_col: str | None) -> DataFrame:
    """A2: weight = tract weight column (not scaled by area) when given, else
    piece area / tract area; missing values leave the numerator but keep
    their weight; 0 when the weight sum is not positive."""
    cols = sorted(set(value_cols + ([weight_col] if weight_col else [])))
    t = broadcast_if_bounded(tracts.select(F.col("gid").alias("b_gid"), *cols))
    ta = tr_meas.select(F.col("gid").alias("b_gid"), F.col("area").alias("_ta"))
    j = overlay.join(t, "b_gid", "left").join(ta, "b_gid")
    if weight_col:
        w = _num0(weight_col)
    else:
        w = F.coalesce(F.col("inter_area") / F.nullif(F.col("_ta"), F.lit(0.0)), F.lit(0.0))
    aggs = [F.sum(w).alias("_w")] + [F.sum(X.to_double(c) * w).alias(f"_{c}") for c in value_cols]
    g = j.groupBy("a_gid").agg(*aggs)
    return g.select(F.col("a_gid").alias("gid"),
                    *[F.when(F.col("_w") > 0, F.coalesce(F.col(f"_{c}"), F.lit(0.0)) / F.col("_w"))
                      .otherwise(F.lit(0.0)).alias(c) for c in value_cols])


def within_mean(overlay: DataFrame, tr_meas: DataFrame, tracts: DataFrame, value_cols: list[str],
                eps: float = 1e-9) -> DataFrame:
    """Tracts lying within a neighborhood (``area(t n n) >= area(t)(1 - eps)``)
    and the plain mean of their values per neighborhood."""
    ta = tr_meas.select(F.col("gid").alias("b_gid"), F.col("area").alias("_ta"))
    t = tracts.select(F.col("gid").alias("b_gid"), *value_cols)
    j = (overlay.join(ta, "b_gid").filter(F.col("inter_area") >= F.col("_ta") * F.lit(1 - eps))
                .join(t, "b_gid"))
    return j.groupBy(F.col("a_gid").alias("gid")).agg(*[F.avg(X.to_double(c)).alias(c) for c in value_cols])


def centroid_mean(nbh_index, tr_meas: DataFrame, tracts: DataFrame, value_cols: list[str]) -> DataFrame:
    """J4, centroid form: tracts whose centroid lies within a neighborhood, and
    the plain mean of their values per neighborhood."""
    from .spatial import pip_join
    c = tr_meas.select(F.col("gid").alias("_t"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    j = pip_join(c, nbh_index, predicate="within", how="inner").join(
        tracts.select(F.col("gid").alias("_t"), *value_cols), "_t")
    return j.groupBy("gid").agg(*[F.avg(X.to_double(v)).alias(v) for v in value_cols])


def nearest_mean(nearest: DataFrame, tracts: DataFrame, value_cols: list[str], pid: str = "pid") -> DataFrame:
    """J5 consumer: mean of the nearest tract(s)' values per query polygon (ties averaged)."""
    t = tracts.select(F.col("gid").alias("_t"), *value_cols)
    j = nearest.join(t, nearest["gid"] == t["_t"])
    return j.groupBy(F.col(pid).alias("gid")).agg(*[F.avg(X.to_double(c)).alias(c) for c in value_cols])


def missing_keys(all_keys: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Keys of ``all_keys`` absent from ``present`` (anti-join)."""
    return all_keys.select(key).join(present.select(key), key, "left_anti")


def three_tier_fill(base: DataFrame, tier2: DataFrame, tier3: DataFrame, key: str,
                    value_cols: list[str]) -> DataFrame:
    """Full outer join of the three tiers on ``key`` and, per column,
    ``coalesce(overlay, within, nearest, 0)``."""
    b = base.select(key, *[F.col(c).alias(f"{c}__1") for c in value_cols])
    t2 = tier2.select(key, *[F.col(c).alias(f"{c}__2") for c in value_cols])
    t3 = tier3.select(key, *[F.col(c).alias(f"{c}__3") for c in value_cols])
    j = b.join(t2, key, "full").join(t3, key, "full")
    return j.select(key, *[F.coalesce(f"{c}__1", f"{c}__2", f"{c}__3", F.lit(0.0)).alias(c)
                           for c in value_cols])


def tiered_filter(tracts: DataFrame, id_col: str | None, name_col: str | None,
                  exact_prefix: str = CITY_ID_PREFIX, loose_prefix: str = LOOSE_ID_PREFIX,
                  name_phrase: str = CITY_NAME_PHRASE) -> DataFrame:
    """rows whose id starts with ``exact_prefix`` if there are any; else
    id starting with ``loose_prefix`` OR name containing ``name_phrase``
    (case-insensitive); if that is empty, all rows. The tier is chosen by one
    aggregate (a declared small result), then applied as a pushed filter."""
    idc = F.col(id_col).cast("string") if id_col else None
    namec = F.lower(F.col(name_col).cast("string")) if name_col else None
    aggs = [F.lit(True).alias("_dummy")]
    if idc is not None:
        aggs.append(F.bool_or(idc.startswith(exact_prefix)).alias("exact"))
    loose = None
    if idc is not None:
        loose = idc.startswith(loose_prefix)
    if namec is not None:
        m = namec.contains(name_phrase)
        loose = m if loose is None else (loose | m)
    if loose is not None:
        aggs.append(F.bool_or(F.coalesce(loose, F.lit(False))).alias("loose"))
    r = tracts.agg(*aggs).first()
    if idc is not None and r["exact"]:
        return tracts.filter(idc.startswith(exact_prefix))
    if loose is not None and r["loose"]:
        return tracts.filter(F.coalesce(loose, F.lit(False)))
    return tracts
