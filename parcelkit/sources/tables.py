"""Driver tables: parquet scans registered as temp views.

Views keep the scan lazy, so Catalyst prunes columns and pushes filters
into each parquet read of whatever query is built on top.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        p = table_path(sf_dir, n)
        if os.path.exists(p) or "://" in p:
            read_table(spark, sf_dir, n).createOrReplaceTempView(n)
