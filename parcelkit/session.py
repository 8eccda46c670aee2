"""Session construction and shared-storage helpers."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every parcelkit session relies on. AQE re-plans joins and
# partition counts from runtime statistics; the UTC zone keeps epoch
# conversions identical to the SQL oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "parcelkit", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the submit config supplies master
    and sizes; this only fills in what is unset."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``parcelkit`` importable in every Python worker (the WKB stages,
    the paged data source): zip the package once per application and add it
    with ``addPyFile``, which distributes it to the executors. The zip is a
    code artifact written next to the checkpoint folder when that is a local
    path (tests), else in the driver's scratch space; Spark serves it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    ck = spark.conf.get("spark.checkpoint.dir", None)
    base = ck if ck and "://" not in ck and os.path.isdir(ck) else tempfile.mkdtemp(prefix="parcelkit-code-")
    zpath = os.path.join(base, f"parcelkit-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/S3/...) folder there; it is used as is.
    Only when it is unset on a local master (tests) is a private scratch
    folder set; elsewhere the executors would not see each other's files.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="parcelkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    spark.sparkContext.setCheckpointDir(cur)
    return cur


def session_key(spark: SparkSession, *parts) -> tuple:
    """Key of things kept for one application: unlike an object's id, it is
    never another session's."""
    return (spark.sparkContext.applicationId, *parts)


def materialize(df: DataFrame, name: str, **options) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint
    folder and reading it back. Survives executor loss (the data lives in
    shared storage, not on executors). ``options`` are the writer's."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.options(**options).mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let go the shuffle files of finished steps. Spark deletes them when the
    driver's garbage collection meets the plans that made them, which a driver
    with memory to spare puts off while the files fill the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
