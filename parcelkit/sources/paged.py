"""Paged feature-service scan (S12) as a Spark Python DataSource.

The record count and page size (``maxRecordCount``, default 2,000) are read
once; ``partitions()`` returns one ``PageRange(offset, limit)`` per page, so
pages are fetched in parallel by the executors instead of one after another.
``where`` and ``outFields`` are passed to the fetcher (source-side
pushdown). The fetcher is injectable (``option("fetcher", "module:Class")``):

* ``FilePages`` reads pages stored as parquet folders ``page=<offset>`` under
  ``root`` plus a one-row JSON ``_meta`` with ``count`` and ``maxRecordCount``
  and a ``_manifest`` with each page's rows (tests and staged downloads),
  through ``pyarrow.fs`` (local or shared);
* ``RestPages`` speaks the feature-service query protocol over HTTP
  (``resultOffset``/``resultRecordCount``, ``f=json``); it needs network
  access and is not exercised by the tests.

Nothing is lost unseen: a page with other than its rows of the manifest, a
page longer than the page size and an error in a service's answer raise
``PageError``. Staged positions may have gaps; their pages are shorter.

With ``read_paged(..., pushdown=True)`` the reader also implements
``pushFilters`` (Spark 4.1): comparisons, IN and null tests on top-level
columns go to the fetcher (a ``where`` clause for the service, Arrow filter
expressions for staged pages); everything else stays in Spark.
"""

from __future__ import annotations

import importlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

DEFAULT_PAGE = 2000


class PageRange(InputPartition):
    def __init__(self, offset: int, limit: int):
        self.offset = offset
        self.limit = limit


def _fs(root: str):
    """(filesystem, path) for a local path or a URI (hdfs://, s3://, file://)."""
    import pyarrow.fs as pafs
    if "://" in root:
        return pafs.FileSystem.from_uri(root)
    return pafs.LocalFileSystem(), root


class FilePages:
    """Pages staged as parquet folders ``page=<offset>`` plus a one-row JSON
    ``_meta`` (count, maxRecordCount), read through ``pyarrow.fs`` so the
    root may be any shared filesystem."""

    def __init__(self, options: dict):
        self.root = options["root"].rstrip("/")

    def meta(self) -> tuple[int, int]:
        import pyarrow.fs as pafs
        fs, path = _fs(self.root)
        for info in fs.get_file_info(pafs.FileSelector(f"{path}/_meta")):
            if info.base_name.startswith("part-") and info.size:
                with fs.open_input_stream(info.path) as f:
                    m = json.loads(f.read().decode().splitlines()[0])
                return int(m["count"]), int(m.get("maxRecordCount") or DEFAULT_PAGE)
        return 0, DEFAULT_PAGE

    @staticmethod
    def _rows(fs, path: str) -> dict[int, int]:
        """The manifest: rows of each page that has any."""
        import pyarrow.fs as pafs
        out = {}
        for info in fs.get_file_info(pafs.FileSelector(f"{path}/_manifest")):
            if info.base_name.startswith("part-") and info.size:
                with fs.open_input_stream(info.path) as f:
                    for line in f.read().decode().splitlines():
                        m = json.loads(line)
                        out[int(m["page"])] = int(m["count"])
        return out

    def fetch(self, offset: int, limit: int, fields: list[str], pushed=()):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        fs, path = _fs(self.root)
        d = f"{path}/page={offset}"
        want = self._rows(fs, path).get(offset, 0)
        found = fs.get_file_info(d).type != pafs.FileType.NotFound
        t = pq.read_table(d, columns=fields, filesystem=fs) if found else None
        have = t.num_rows if found else 0
        if have != want:
            raise PageError(f"page {offset} has {have} rows, the manifest says {want}")
        if have > limit:
            raise PageError(f"page {offset} has {have} rows, more than the page size {limit}")
        if not found:
            return None
        if pushed:
            t = t.filter(_arrow_predicate(pushed))
        return t


class PageError(RuntimeError):
    """A page or a service answer that does not hold what it must."""


def _answer(d: dict) -> dict:
    """A service's answer; services report errors in a normal answer's body."""
    if "error" in d:
        raise PageError(f"service error: {d['error']}")
    return d


class RestPages:
    """Feature-service query endpoint (``<layer_url>/query``)."""

    def __init__(self, options: dict):
        self.url = options["url"].rstrip("/")
        self.where = options.get("where", "1=1")
        self.timeout = float(options.get("timeout", 60))

    def _get(self, params: dict) -> dict:
        import urllib.parse
        import urllib.request
        q = urllib.parse.urlencode({**params, "f": "json"})
        with urllib.request.urlopen(f"{self.url}/query?{q}", timeout=self.timeout) as r:
            return _answer(json.load(r))

    def meta(self) -> tuple[int, int]:
        n = self._get({"where": self.where, "returnCountOnly": "true"})["count"]
        return int(n), int(self._layer().get("maxRecordCount") or DEFAULT_PAGE)

    def _layer(self) -> dict:
        import urllib.request
        with urllib.request.urlopen(f"{self.url}?f=json", timeout=30) as r:
            return _answer(json.load(r))

    def _order(self) -> str:
        """The object id, by which pages are cut: without an order a service
        may repeat or skip rows between offsets."""
        layer = self._layer()
        return layer.get("objectIdField") or next(
            f["name"] for f in layer["fields"] if f["type"] == "esriFieldTypeOID")

    def fetch(self, offset: int, limit: int, fields: list[str], pushed=()):
        import pyarrow as pa
        where = " AND ".join([f"({self.where})"] + [_sql_predicate(p) for p in pushed])
        d = self._get({"where": where, "outFields": ",".join(fields) or "*", "outSR": 4326,
                       "orderByFields": self._order(), "resultOffset": offset, "resultRecordCount": limit})
        if "features" not in d:
            raise PageError(f"page {offset}: answer without features")
        feats = d["features"]
        if len(feats) > limit:
            raise PageError(f"page {offset} has {len(feats)} rows, more than the page size {limit}")
        if not feats:
            if not pushed:
                raise PageError(f"page {offset} is empty, though within the service's count")
            return None
        rows = [dict(f.get("attributes") or {}) for f in feats]
        for r, f in zip(rows, feats):
            g = f.get("geometry") or {}
            if "x" in g and "y" in g:
                r.setdefault("lon", g["x"])
                r.setdefault("lat", g["y"])
        return pa.Table.from_pylist([{k: r.get(k) for k in fields} for r in rows])


def _load(spec: str, options: dict):
    mod, cls = spec.split(":")
    return getattr(importlib.import_module(mod), cls)(options)


# ------------------------------------------------------------- pushdown

_OPS = {"EqualTo": "=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<",
        "LessThanOrEqual": "<=", "In": "IN", "IsNull": "IS NULL", "IsNotNull": "IS NOT NULL"}


def _as_pushed(f):
    """(column, op, value) for a supported filter on a top-level column, else None."""
    op = _OPS.get(type(f).__name__)
    if op is None or len(f.attribute) != 1:
        return None
    return (f.attribute[0], op, getattr(f, "value", None))


def _arrow_predicate(pushed):
    import pyarrow.compute as pc
    expr = None
    for col, op, v in pushed:
        c = pc.field(col)
        e = {"=": lambda: c == v, ">": lambda: c > v, ">=": lambda: c >= v, "<": lambda: c < v,
             "<=": lambda: c <= v, "IN": lambda: c.isin(list(v)), "IS NULL": lambda: c.is_null(),
             "IS NOT NULL": lambda: c.is_valid()}[op]()
        expr = e if expr is None else (expr & e)
    return expr


def _sql_literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _sql_predicate(p) -> str:
    col, op, v = p
    if op in ("IS NULL", "IS NOT NULL"):
        return f"{col} {op}"
    if op == "IN":
        return f"{col} IN ({', '.join(_sql_literal(x) for x in v)})"
    return f"{col} {op} {_sql_literal(v)}"


class PagedFeatureSource(DataSource):
    @classmethod
    def name(cls):
        return "paged_features"

    def schema(self):
        return self.options["schema"]

    def reader(self, schema):
        if str(self.options.get("pushdown", "false")).lower() == "true":
            return PagedPushdownReader(schema, self.options)
        return PagedReader(schema, self.options)


class PagedReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema = schema
        self.options = dict(options)
        self.pushed = []

    def partitions(self):
        f = _load(self.options.get("fetcher", "parcelkit.sources.paged:FilePages"), self.options)
        total, mrc = f.meta()
        mrc = int(self.options.get("maxRecordCount", mrc))
        return [PageRange(o, mrc) for o in range(0, total, mrc)]

    def read(self, partition: PageRange):
        import pyarrow as pa
        f = _load(self.options.get("fetcher", "parcelkit.sources.paged:FilePages"), self.options)
        fields = [fl.name for fl in self.schema.fields]
        t = f.fetch(partition.offset, partition.limit, fields, self.pushed)
        if t is None or t.num_rows == 0:
            return
        target = pa.schema([(fl.name, _arrow_type(fl.dataType)) for fl in self.schema.fields])
        t = t.select(fields).cast(target)
        for b in t.to_batches():
            yield b


class PagedPushdownReader(PagedReader):
    def pushFilters(self, filters):
        for f in filters:
            p = _as_pushed(f)
            if p is None:
                yield f
            else:
                self.pushed.append(p)


def _arrow_type(dt):
    import pyarrow as pa
    n = dt.typeName()
    return {"long": pa.int64(), "integer": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary()}[n]


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedFeatureSource)


def stage_pages(df: DataFrame, position_col: str, root: str, page: int = DEFAULT_PAGE) -> None:
    """Write ``df`` as a paged service under ``root``: parquet folders
    ``page=<offset>`` keyed by the record position, plus ``meta.json``."""
    from pyspark.sql import functions as F
    df.withColumn("page", (F.floor(F.col(position_col) / page) * page).cast("long")) \
      .repartition("page").write.mode("overwrite").partitionBy("page").parquet(root)
    pages = df.groupBy((F.floor(F.col(position_col) / page) * page).cast("long").alias("page")).count()
    worst = pages.agg(F.max("count"), F.min("page"), F.max("page")).first()
    if worst[0] and (worst[0] > page or worst[1] is None or worst[1] < 0):
        raise PageError(f"positions repeat or lie below 0: a page of {worst[0]} rows at page size {page}")
    n = df.agg(F.max(position_col)).first()[0]
    total = 0 if n is None else int(n) + 1
    # what each page must hold when it is read again
    pages.write.mode("overwrite").json(root.rstrip("/") + "/_manifest")
    # one-row metadata written by Spark, so ``root`` may be shared storage
    (df.sparkSession.createDataFrame([(total, page)], "count long, maxRecordCount long")
       .coalesce(1).write.mode("overwrite").json(root.rstrip("/") + "/_meta"))


def read_paged(spark: SparkSession, schema: str, pushdown: bool = False, **options) -> DataFrame:
    register(spark)
    if pushdown:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    r = spark.read.format("paged_features").option("schema", schema).option("pushdown", str(pushdown).lower())
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()
