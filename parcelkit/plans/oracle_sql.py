"""SQL fragments for the DuckDB oracle side.

These are independent SQL formulations of each rule (brute-force where the
Spark side uses cell joins), composed into full queries in ``catalog``.
"""

from __future__ import annotations

from ..functions.geom import ALBERS, MERCATOR_R

# Unicode's own classes instead of a list: separators, and the control blanks.
BLANK = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]+"


def strip_lower(c: str) -> str:
    return f"lower(regexp_replace(CAST({c} AS VARCHAR), '^{BLANK}|{BLANK}$', '', 'g'))"


def status(c: str) -> str:
    s = strip_lower(c)
    return (f"CASE WHEN {c} IS NULL THEN 'Unknown' "
            f"WHEN {s} LIKE '%non%' AND {s} LIKE '%lead%' THEN 'Non-Lead' "
            f"WHEN {s} LIKE '%lead%' THEN 'Lead' "
            f"WHEN {s} IN ('yes', 'y') THEN 'Lead' "
            f"WHEN {s} IN ('no', 'n') THEN 'Non-Lead' ELSE 'Unknown' END")


def material(c: str) -> str:
    s = strip_lower(c)
    return (f"CASE WHEN {c} IS NULL THEN 'Unknown' "
            f"WHEN {s} = 'lead' OR {s} LIKE '%galvanized requiring replacement%' THEN 'Lead/GRR' "
            f"WHEN {s} LIKE '%unknown%' THEN 'Unknown' "
            f"WHEN {s} LIKE '%non-lead%' OR {s} LIKE '%copper%' OR {s} LIKE '%plastic%' "
            f"OR {s} LIKE '%other%' OR {s} = 'galvanized' THEN 'Non-Lead' ELSE 'Unknown' END")


def both(c: str) -> str:
    s = strip_lower(c)
    return (f"CASE WHEN {c} IS NULL THEN 'Unknown' "
            f"WHEN {s} LIKE '%non-lead%' THEN 'Non-Lead' "
            f"WHEN {s} LIKE '%lead%' OR {s} LIKE '%galvanized requiring replacement%' THEN 'Lead/GRR' "
            f"ELSE 'Unknown' END")


def impute(cat: str, cls: str) -> str:
    return (f"CASE WHEN {cat} = 'Unknown' THEN CASE "
            f"WHEN TRY_CAST({cls} AS DOUBLE) IN (0, 1) THEN 'Non-Lead' "
            f"WHEN TRY_CAST({cls} AS DOUBLE) IN (2, 3) THEN 'Lead/GRR' ELSE 'Unknown' END "
            f"ELSE {cat} END")


def combine(a: str, b: str) -> str:
    return (f"CASE WHEN {a} = 'Lead/GRR' OR {b} = 'Lead/GRR' THEN 'Lead/GRR' "
            f"WHEN {a} = 'Non-Lead' OR {b} = 'Non-Lead' THEN 'Non-Lead' ELSE 'Unknown' END")


def num(c: str) -> str:
    return f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"


def yes_flag(c: str) -> str:
    return f"CASE WHEN {strip_lower(c)} IN ('yes', 'y', 'true', 't', '1') THEN 1 ELSE 0 END"


def pip_pairs(points: str, edges: str, predicate: str = "within") -> str:
    """Brute-force point/polygon incidence: every point against every edge
    that its rightward ray could meet; returns ``SELECT pid, gid``."""
    cross = ("sum(CASE WHEN ((e.y1 > p.y) <> (e.y2 > p.y)) AND "
             "p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END)")
    onb = ("bool_or((e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) = 0 "
           "AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
           "AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))")
    cond = {"within": "nx % 2 = 1 AND NOT onb", "intersects": "nx % 2 = 1 OR onb"}[predicate]
    return (f"SELECT pid, gid FROM (SELECT p.pid, e.gid, {cross} AS nx, {onb} AS onb "
            f"FROM {points} p JOIN {edges} e ON p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) "
            f"AND p.x <= greatest(e.x1, e.x2) GROUP BY p.pid, e.gid) h WHERE {cond}")


def dbl(v: float) -> str:
    """A DOUBLE literal (DuckDB reads plain decimals as DECIMAL)."""
    r = repr(float(v))
    return r if "e" in r or "inf" in r or "nan" in r else r + "e0"


def albers_forward(lon: str, lat: str) -> tuple[str, str]:
    A = ALBERS
    phi = f"radians({lat})"
    s = f"sin({phi})"
    q = (f"({dbl(1 - A.e2)} * ({s} / (1e0 - {dbl(A.e2)} * {s} * {s}) - "
         f"ln((1e0 - {dbl(A.e)} * {s}) / (1e0 + {dbl(A.e)} * {s})) / {dbl(2 * A.e)}))")
    theta = f"({dbl(A.n)} * (radians({lon}) - {dbl(A.lon0)}))"
    rho = f"({dbl(A.a)} * sqrt({dbl(A.C)} - {dbl(A.n)} * {q}) / {dbl(A.n)})"
    return f"({rho} * sin({theta}))", f"({dbl(A.rho0)} - {rho} * cos({theta}))"


def mercator_forward(lon: str, lat: str) -> tuple[str, str]:
    R = MERCATOR_R
    return (f"({dbl(R)} * radians({lon}))",
            f"({dbl(R)} * ln(tan({dbl(3.141592653589793 / 4)} + radians({lat}) / 2e0)))")


def bbox_area_cte(edge_view: str, name: str) -> str:
    """``name(gid, xmin, ymin, xmax, ymax, area)`` by shoelace around the bbox corner."""
    return f"""{name}_bb AS (SELECT gid, min(x1) AS xmin, min(y1) AS ymin, max(x1) AS xmax, max(y1) AS ymax
                FROM {edge_view} GROUP BY gid),
{name} AS (SELECT b.gid, b.xmin, b.ymin, b.xmax, b.ymax,
       sum((e.x1 - b.xmin) * (e.y2 - b.ymin) - (e.x2 - b.xmin) * (e.y1 - b.ymin)) / 2 AS area
       FROM {edge_view} e JOIN {name}_bb b ON e.gid = b.gid GROUP BY b.gid, b.xmin, b.ymin, b.xmax, b.ymax)"""


def overlay_ctes(edges_a: str, edges_b: str, prefix: str = "ov") -> str:
    """Brute-force exact overlay: every bbox-overlapping polygon pair, every
    edge pair with a shared x-range, signed trapezoid integrals; result
    ``{prefix}(a_gid, b_gid, inter_area)`` keeping pieces above 1e-9 of the
    smaller area. Also defines ``{prefix}_pa`` / ``{prefix}_pb`` areas."""
    p = prefix
    return f"""{bbox_area_cte(edges_a, p + '_pa')},
{bbox_area_cte(edges_b, p + '_pb')},
{p}_pr AS (SELECT a.gid AS a_gid, b.gid AS b_gid, greatest(a.xmin, b.xmin) AS ox, greatest(a.ymin, b.ymin) AS oy
           FROM {p}_pa a JOIN {p}_pb b ON a.xmin <= b.xmax AND b.xmin <= a.xmax AND a.ymin <= b.ymax AND b.ymin <= a.ymax),
{p}_ep AS (SELECT r.a_gid, r.b_gid, greatest(least(ea.x1, ea.x2), least(eb.x1, eb.x2)) - r.ox AS u0,
                  least(greatest(ea.x1, ea.x2), greatest(eb.x1, eb.x2)) - r.ox AS u1,
                  ea.x1 - r.ox AS ax1, ea.y1 - r.oy AS ay1, ea.x2 - r.ox AS ax2, ea.y2 - r.oy AS ay2,
                  eb.x1 - r.ox AS bx1, eb.y1 - r.oy AS by1, eb.x2 - r.ox AS bx2, eb.y2 - r.oy AS by2
           FROM {p}_pr r JOIN {edges_a} ea ON ea.gid = r.a_gid JOIN {edges_b} eb ON eb.gid = r.b_gid
           WHERE ea.x1 <> ea.x2 AND eb.x1 <> eb.x2
             AND greatest(least(ea.x1, ea.x2), least(eb.x1, eb.x2)) < least(greatest(ea.x1, ea.x2), greatest(eb.x1, eb.x2))),
{p}_ev AS (SELECT a_gid, b_gid, u1 - u0 AS w,
                  ay1 + (u0 - ax1) * (ay2 - ay1) / (ax2 - ax1) AS f0, ay1 + (u1 - ax1) * (ay2 - ay1) / (ax2 - ax1) AS f1,
                  by1 + (u0 - bx1) * (by2 - by1) / (bx2 - bx1) AS g0, by1 + (u1 - bx1) * (by2 - by1) / (bx2 - bx1) AS g1,
                  (CASE WHEN ax1 > ax2 THEN 1e0 ELSE -1e0 END) * (CASE WHEN bx1 > bx2 THEN 1e0 ELSE -1e0 END) AS s
           FROM {p}_ep),
{p}_raw AS (SELECT a_gid, b_gid, sum(s * w * ((f0 + f1 + g0 + g1) / 4 -
                 CASE WHEN (f0 - g0) * (f1 - g1) >= 0 THEN (abs(f0 - g0) + abs(f1 - g1)) / 4
                      ELSE ((f0 - g0) * (f0 - g0) + (f1 - g1) * (f1 - g1)) / (4 * (abs(f0 - g0) + abs(f1 - g1))) END)) AS inter_area
            FROM {p}_ev GROUP BY a_gid, b_gid),
{p} AS (SELECT r.a_gid, r.b_gid, r.inter_area FROM {p}_raw r JOIN {p}_pa a ON a.gid = r.a_gid JOIN {p}_pb b ON b.gid = r.b_gid
        WHERE r.inter_area > 1e-9 * least(a.area, b.area))"""


def linear_colour(x: str, stops: list[str], vmin: str, vmax: str, nodata: str) -> str:
    """SQL twin of the linear colour map (stops equally spaced on [vmin, vmax])."""
    cols = [tuple(int(s.lstrip('#')[i:i + 2], 16) for i in (0, 2, 4)) for s in stops]
    n = len(cols)
    idx = [f"({vmin} + ({vmax} - {vmin}) * {i} / {n - 1})" for i in range(n)]

    def chan(j):
        parts = [f"WHEN {x} <= {idx[0]} THEN {cols[0][j]}e0 / 255e0"]
        for i in range(1, n):
            p = f"(({x} - {idx[i - 1]}) / ({idx[i]} - {idx[i - 1]}))"
            p = f"(CASE WHEN {idx[i - 1]} < {idx[i]} THEN {p} ELSE 1e0 END)"
            seg = f"((1e0 - {p}) * ({cols[i - 1][j]}e0 / 255e0) + {p} * ({cols[i][j]}e0 / 255e0))"
            parts.append(f"WHEN {x} < {idx[i]} THEN {seg}")
        v = f"(CASE {' '.join(parts)} ELSE {cols[-1][j]}e0 / 255e0 END)"
        return f"lower(lpad(hex(CAST(floor({v} * 255.9999e0) AS BIGINT)), 2, '0'))"

    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN '{nodata}' "
            f"ELSE '#' || {chan(0)} || {chan(1)} || {chan(2)} END")
