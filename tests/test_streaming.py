"""The streaming lead summary equals the batch one over the same points."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import SF001
from parcelkit.plans import catalog, inputs
from parcelkit.session import ensure_checkpoint_dir
from parcelkit.streaming import lead_stream


def test_stream_equals_batch(spark):
    root = os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex[:8]}")
    h = inputs.houses(spark, SF001).select("pid", "x", "y", "bothsidesstatus", "yearstructbuilt")
    # two arrivals: even and odd order keys land as separate files
    h.filter(F.col("pid") % 2 == 0).write.parquet(os.path.join(root, "in", "a"))
    h.filter(F.col("pid") % 2 == 1).write.parquet(os.path.join(root, "in", "b"))
    nb = inputs.neighborhoods(spark, SF001)
    schema = "pid BIGINT, x DOUBLE, y DOUBLE, bothsidesstatus STRING, yearstructbuilt STRING"
    s = lead_stream.lead_count_stream(spark, os.path.join(root, "in", "*"), schema, nb.index,
                                      nb.attrs.select("gid", "name"), max_files_per_trigger=1)
    lead_stream.run_available(s, "lead_counts_test", os.path.join(root, "ckpt"))
    got = lead_stream.summary_from_counts(spark.table("lead_counts_test"))
    want = catalog.QUERIES["lead_by_neighborhood"](spark, SF001)
    cols = sorted(want.columns)
    g = sorted(tuple(r) for r in got.select(*[F.col(f"`{c}`") for c in cols]).collect())
    w = sorted(tuple(r) for r in want.select(*[F.col(f"`{c}`") for c in cols]).collect())
    assert len(g) == len(w)
    for a, b in zip(g, w):
        for x, y in zip(a, b):
            assert (x == y) or (isinstance(x, float) and abs(x - y) < 1e-9)
