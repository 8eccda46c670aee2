"""Input layers built from the fixture views (see sources.fixtures).

``Layer`` bundles what every spatial operator needs from a polygon layer:
its oriented edge rows, per-polygon measures, and attribute rows keyed by
``gid``. Measures are derived lazily from the edges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import session_key
from ..operators.polygons import edges_from_vertices, polygon_measures, vertices_from_nodes
from ..sources.fixtures import register_fixtures

# Reporting clock year used by the committed outputs (a parameter, not the run's clock).
CUR_YEAR = 2025


@dataclass
class Layer:
    edges: DataFrame
    attrs: DataFrame
    _measures: DataFrame | None = None
    _index: object = None

    @property
    def measures(self) -> DataFrame:
        if self._measures is None:
            self._measures = polygon_measures(self.edges)
        return self._measures

    _overlaps: bool | None = None

    @property
    def has_overlaps(self) -> bool:
        """Any two polygons overlapping with positive area (computed once)."""
        if self._overlaps is None:
            from ..operators.areal import layer_has_overlaps
            self._overlaps = layer_has_overlaps(self.edges, self.measures)
        return self._overlaps

    @property
    def index(self):
        """Persisted point-in-polygon cell index (built on first use)."""
        if self._index is None:
            from ..operators.spatial import PipIndex
            self._index = PipIndex(self.edges, self.measures)
        return self._index


_REGISTERED: dict = {}
_LAYERS: dict = {}


def _fx(spark: SparkSession, sf_dir: str) -> None:
    # epoch conversions and formatted timestamps are defined in UTC
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = session_key(spark, sf_dir)
    if _REGISTERED.get("key") != key:
        from ..session import ensure_checkpoint_dir, ship_package
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        register_fixtures(spark, sf_dir, ["fx_nbh", "fx_nbh_node", "fx_tract", "fx_tract_node", "fx_house"])
        _REGISTERED["key"] = key


def _layer(spark: SparkSession, sf_dir: str, node_view: str, attr_view: str) -> Layer:
    """Polygon layers are small next to the point data and every spatial
    operator reads them several times (size check, cell size, join), so
    their edges and measures are persisted once per session and folder. A
    lost cached block is recomputed from lineage."""
    key = session_key(spark, sf_dir, node_view)
    if key not in _LAYERS:
        _fx(spark, sf_dir)
        edges = edges_from_vertices(vertices_from_nodes(spark.table(node_view))).persist()
        attrs = spark.table(attr_view)
        _LAYERS[key] = Layer(edges, attrs, polygon_measures(edges).persist())
    _fx(spark, sf_dir)
    return _LAYERS[key]


_OVERLAYS: dict = {}


def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighborhood x tract exact overlay (``a_gid, b_gid, inter_area``),
    computed once per session and folder and persisted: it is the central
    derived relation every areal statistic reads."""
    from ..operators.spatial import overlay_areas
    key = session_key(spark, sf_dir)
    if key not in _OVERLAYS:
        nb, tr = neighborhoods(spark, sf_dir), tracts(spark, sf_dir)
        _OVERLAYS[key] = overlay_areas(nb.edges, nb.measures, tr.edges, tr.measures).persist()
    return _OVERLAYS[key]


def neighborhoods(spark: SparkSession, sf_dir: str) -> Layer:
    return _layer(spark, sf_dir, "fx_nbh_node", "fx_nbh")


def tracts(spark: SparkSession, sf_dir: str) -> Layer:
    return _layer(spark, sf_dir, "fx_tract_node", "fx_tract")


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    _fx(spark, sf_dir)
    return spark.table("fx_house")
