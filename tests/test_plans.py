"""Physical-plan properties the scale design relies on."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import SF01
from parcelkit.operators import spatial
from parcelkit.plans import inputs


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_pip_broadcast_when_bounded_and_shuffle_fallback(spark):
    nb = inputs.neighborhoods(spark, SF01)
    pts = inputs.houses(spark, SF01).select("pid", "x", "y")
    attrs = nb.attrs.select("gid", "name")
    j = spatial.pip_join(pts, nb.index, attrs)
    p = _plan(j)
    assert "BroadcastHashJoin LeftOuter" in p
    # no broadcast allowed at all: the same join as a shuffle join on the cell keys
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        k = spatial.pip_join(pts, nb.index, attrs, broadcast_limit=0)
        pk = _plan(k)
        assert "BroadcastHashJoin LeftOuter" not in pk
        assert ("SortMergeJoin LeftOuter" in pk) or ("ShuffledHashJoin LeftOuter" in pk)
        a = sorted(tuple(r) for r in j.select("pid", "gid").collect())
        b = sorted(tuple(r) for r in k.select("pid", "gid").collect())
        assert a == b
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_parquet_scan_prunes_columns(spark):
    h = inputs.houses(spark, SF01).select("pid", "x", "y")
    p = _plan(h)
    # the orders scan reads only the key columns the fixture needs for x, y
    orders_schema = [l for l in p.splitlines() if "ReadSchema" in l and "o_orderkey" in l]
    assert orders_schema and "o_totalprice" not in orders_schema[0] and "o_orderdate" not in orders_schema[0]
