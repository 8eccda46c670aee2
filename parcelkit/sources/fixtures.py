"""Fixture views over the driver tables (planar metres).

The same SQL text builds the Spark inputs and, as CTEs, the DuckDB oracle
side, so both read identical rows. ``fx_nbh*``: jittered 5x5 lattice of
neighborhood quads (from nation); ``fx_tract*``: jittered 10x10 lattice of
tract quads with attributes (from supplier); ``fx_house``: service-line
points with raw attributes (orders x customer x nation); ``fx_zone_ring``:
literal hard shapes (concave, clockwise shell with hole, multipart, touching)
used by the unit tests only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .tables import register_tables

# Fixed view definitions (must stay byte-identical to FIXTURES.md Part B).
VIEWS: dict[str, str] = {}
VIEWS["fx_nbh"] = """
SELECT n_nationkey AS gid, n_name AS name FROM nation
"""
VIEWS["fx_nbh_node"] = """
SELECT gid, k, 0e0 + ca*1000e0 + ((ca*37 + cb*91) % 7 - 3)*50e0 AS x, 0e0 + cb*1000e0 + ((ca*53 + cb*29) % 7 - 3)*50e0 AS y
FROM (SELECT n_nationkey AS gid, k,
             CAST(n_nationkey % 5 AS INT) + da AS ca, CAST(floor(n_nationkey / 5e0) AS INT) % 5 + db AS cb
      FROM nation CROSS JOIN (VALUES (0,0,0),(1,1,0),(2,1,1),(3,0,1)) AS c(k, da, db)) q
"""
VIEWS["fx_nbh_edge"] = """
SELECT p.gid, p.k, p.x AS x1, p.y AS y1, n.x AS x2, n.y AS y2
FROM fx_nbh_node p JOIN fx_nbh_node n ON p.gid = n.gid AND n.k = (p.k + 1) % 4
"""
VIEWS["fx_tract"] = """
SELECT s_suppkey AS gid,
       concat(CASE WHEN s_suppkey % 10 = 9 THEN '51041' ELSE '51760' END, lpad(CAST(s_suppkey AS STRING), 6, '0')) AS GEOID,
       s_name AS NAME,
       1000 + (s_suppkey*37) % 4000 AS totalE, (s_suppkey*53) % 400 AS WhiteE, (s_suppkey*71) % 300 AS BlackE,
       (s_suppkey*29) % 120 AS HispanicE, (s_suppkey*13) % 80 AS AsianE, (s_suppkey*7) % 20 AS NativeE, (s_suppkey*3) % 10 AS HIPIE,
       ((s_suppkey*53) % 400) / 1000e0 AS Pwhite, ((s_suppkey*71) % 300) / 1000e0 AS Pblack,
       100 + (s_suppkey*11) % 900 AS Households,
       CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE 20000e0 + (s_suppkey*7919) % 90000 END AS avg_income
FROM supplier
"""
VIEWS["fx_tract_node"] = """
SELECT gid, k, -120e0 + ca*530e0 + ((ca*37 + cb*91) % 5 - 2)*30e0 AS x, -120e0 + cb*530e0 + ((ca*53 + cb*29) % 5 - 2)*30e0 AS y
FROM (SELECT s_suppkey AS gid, k,
             CAST(s_suppkey % 10 AS INT) + da AS ca, CAST(floor(s_suppkey / 10e0) AS INT) % 10 + db AS cb
      FROM supplier CROSS JOIN (VALUES (0,0,0),(1,1,0),(2,1,1),(3,0,1)) AS c(k, da, db)) q
"""
VIEWS["fx_tract_edge"] = """
SELECT p.gid, p.k, p.x AS x1, p.y AS y1, n.x AS x2, n.y AS y2
FROM fx_tract_node p JOIN fx_tract_node n ON p.gid = n.gid AND n.k = (p.k + 1) % 4
"""
VIEWS["fx_house"] = """
SELECT o_orderkey AS pid,
  5400e0*((o_orderkey*7919) % 100003)/100003e0 - 200e0 AS x,
  5400e0*((o_orderkey*104729) % 99991)/99991e0 - 200e0 AS y,
  CASE o_orderkey % 8 WHEN 0 THEN 'Lead' WHEN 1 THEN 'Non-Lead' WHEN 2 THEN ' Unknown ' WHEN 3 THEN 'Galvanized Requiring Replacement'
       WHEN 4 THEN concat(chr(9), 'NON-LEAD') WHEN 5 THEN 'yes' WHEN 6 THEN NULL ELSE '' END AS bothsidesstatus,
  CASE o_orderkey % 7 WHEN 0 THEN 'Lead' WHEN 1 THEN 'Copper' WHEN 2 THEN 'Unknown - copper' WHEN 3 THEN 'galvanized'
       WHEN 4 THEN 'Galvanized requiring replacement' WHEN 5 THEN NULL ELSE 'Unknown' END AS custmaterial,
  CASE o_orderkey % 6 WHEN 0 THEN 'Lead ' WHEN 1 THEN 'Plastic' WHEN 2 THEN 'Other' WHEN 3 THEN 'lead-lined' WHEN 4 THEN NULL ELSE 'UNKNOWN' END AS utilmaterial,
  CASE WHEN o_orderkey % 29 = 0 THEN '0' WHEN o_orderkey % 31 = 0 THEN '2199' WHEN o_orderkey % 23 = 0 THEN NULL
       WHEN o_orderkey % 41 = 0 THEN 'n/a' WHEN o_orderkey % 43 = 0 THEN '1790'
       ELSE CAST(1850 + (o_orderkey*31) % 175 AS STRING) END AS yearstructbuilt,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(20000 + (o_custkey*7919) % 90000 AS STRING) END AS MHI,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE n_name END AS neighborhood_name,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (o_orderkey*17) % 5 END AS ModelClassification_Cust,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE (o_orderkey*23) % 5 END AS ModelClassification_City,
  ((o_orderkey*7919) % 1000)/1000e0 AS ModelScoreForLeadClassification_Cust,
  1577836800000 + ((o_orderkey*7919) % 150000000)*1000 AS EditDate,
  CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'TRUE' WHEN 3 THEN NULL ELSE '1' END AS disadvantaged,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS STRING) END AS J40_TotCatExceeded,
  o_orderpriority AS buildingtype
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""
VIEWS["fx_zone_ring"] = """
SELECT * FROM (VALUES
 (1,0,'shell',0,0e0,0e0),(1,0,'shell',1,2000e0,0e0),(1,0,'shell',2,2000e0,1000e0),(1,0,'shell',3,1000e0,1000e0),(1,0,'shell',4,1000e0,2000e0),(1,0,'shell',5,0e0,2000e0),
 (2,0,'shell',0,2500e0,2500e0),(2,0,'shell',1,2500e0,4500e0),(2,0,'shell',2,4500e0,4500e0),(2,0,'shell',3,4500e0,2500e0),
 (2,0,'hole',0,3000e0,3000e0),(2,0,'hole',1,3500e0,3000e0),(2,0,'hole',2,3500e0,3500e0),(2,0,'hole',3,3000e0,3500e0),
 (3,0,'shell',0,500e0,3500e0),(3,0,'shell',1,1500e0,3500e0),(3,0,'shell',2,500e0,4500e0),
 (3,1,'shell',0,3000e0,500e0),(3,1,'shell',1,4000e0,500e0),(3,1,'shell',2,4000e0,1500e0),(3,1,'shell',3,3000e0,1500e0),
 (4,0,'shell',0,2000e0,0e0),(4,0,'shell',1,3000e0,0e0),(4,0,'shell',2,3000e0,500e0),(4,0,'shell',3,2000e0,500e0)
) AS t(gid, part, role, ord, x, y)
"""

# The hard shapes of fx_zone_ring (concave, clockwise with a hole, several
# parts, touching) at a fifth of their size, one per supplier, on top of each
# other here and there.
VIEWS["fx_plot_ring"] = """
SELECT s_suppkey AS gid, z.part, z.role, z.ord,
       z.x * 0.2e0 + ((s_suppkey * 37) % 47) * 97e0 AS x, z.y * 0.2e0 + ((s_suppkey * 53) % 43) * 103e0 AS y
FROM supplier JOIN fx_zone_ring z ON z.gid = s_suppkey % 4 + 1
"""
# Oriented edges of the plots, for the oracle.
VIEWS["fx_plot_edge"] = """
SELECT gid, CASE WHEN flip THEN x2 ELSE x1 END AS x1, CASE WHEN flip THEN y2 ELSE y1 END AS y1,
       CASE WHEN flip THEN x1 ELSE x2 END AS x2, CASE WHEN flip THEN y1 ELSE y2 END AS y2
FROM (SELECT *, (role = 'shell') = (sum(x1 * y2 - x2 * y1) OVER (PARTITION BY gid, part, role) < 0) AS flip
      FROM (SELECT gid, part, role, x AS x1, y AS y1,
                   coalesce(lead(x) OVER (PARTITION BY gid, part, role ORDER BY ord),
                            first_value(x) OVER (PARTITION BY gid, part, role ORDER BY ord)) AS x2,
                   coalesce(lead(y) OVER (PARTITION BY gid, part, role ORDER BY ord),
                            first_value(y) OVER (PARTITION BY gid, part, role ORDER BY ord)) AS y2
            FROM fx_plot_ring) r) q
"""
# Points on the plots' corners and edge middles, and houses.
VIEWS["fx_plot_point"] = """
SELECT o_orderkey AS pid, 5400e0*((o_orderkey*7919) % 100003)/100003e0 - 200e0 AS x,
       5400e0*((o_orderkey*104729) % 99991)/99991e0 - 200e0 AS y FROM orders
UNION ALL SELECT -(gid * 1000 + part * 100 + ord * 2 + CASE WHEN role = 'hole' THEN 50 ELSE 0 END), x, y FROM fx_plot_ring
UNION ALL SELECT -(gid * 1000 + part * 100 + ord * 2 + CASE WHEN role = 'hole' THEN 50 ELSE 0 END + 1), x + 100e0, y FROM fx_plot_ring
"""

# view -> views it reads (base tables are always registered)
DEPS = {
    "fx_nbh": [],
    "fx_nbh_node": [],
    "fx_nbh_edge": ["fx_nbh_node"],
    "fx_tract": [],
    "fx_tract_node": [],
    "fx_tract_edge": ["fx_tract_node"],
    "fx_house": [],
    "fx_zone_ring": [],
    "fx_plot_ring": ["fx_zone_ring"],
    "fx_plot_edge": ["fx_plot_ring"],
    "fx_plot_point": ["fx_plot_ring"],
}


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        for d in DEPS[n]:
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def register_fixtures(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register driver tables and the requested fixture views (all by default)."""
    register_tables(spark, sf_dir, ("nation", "supplier", "orders", "customer"))
    for n in _closure(names or list(VIEWS)):
        spark.sql(VIEWS[n]).createOrReplaceTempView(n)


def with_views(names, body: str) -> str:
    """Prefix ``body`` with the CTEs for ``names`` (and their dependencies).
    ``body`` may begin with ``, name AS (...)`` to append its own CTEs."""
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n].strip()}\n)" for n in _closure(names))
    body = body.lstrip("\n")
    return f"WITH {ctes}\n{body}"
