"""Streaming lead summary by neighborhood.

New point files (parquet) are read with ``readStream``; each micro-batch is
joined to the static, size-checked polygon cell index (a stream-static
left join: the polygon side is broadcast, points are never shuffled for the
join) and folded into per-neighborhood counts held in the state store.
State is one row per neighborhood - bounded by the polygon layer, not by
the number of points. Rates are derived from the counts by the reader of
the sink (``summary_from_counts``), exactly as in the batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as X
from ..operators import spatial


def lead_count_stream(spark: SparkSession, points_dir: str, schema: str, index: "spatial.PipIndex",
                      names: DataFrame, status_col: str = "bothsidesstatus",
                      year_col: str = "yearstructbuilt", cur_year: int = 2025,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of running ``name, Lead, Non-Lead, Unknown,
    _year_sum, _year_n`` counts (complete output mode)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    pts = r.parquet(points_dir)
    j = spatial.pip_join(pts, index, names, predicate="within", how="left")
    s = X.normalize_status(status_col)
    y = X.to_double(year_col)
    yv = F.when(X.year_valid(y, cur_year, "a"), y)
    return (j.filter(F.col("name").isNotNull()).groupBy("name").agg(
        F.count(F.when(s == X.LEAD, 1)).alias(X.LEAD),
        F.count(F.when(s == X.NON_LEAD, 1)).alias(X.NON_LEAD),
        F.count(F.when(s == X.UNKNOWN, 1)).alias(X.UNKNOWN),
        F.sum(yv).alias("_year_sum"), F.count(yv).alias("_year_n")))


def summary_from_counts(counts: DataFrame, cur_year: int = 2025) -> DataFrame:
    """A8/A9 columns from the streamed counts (same formulas as batch)."""
    lead, non, unk = F.col(f"`{X.LEAD}`"), F.col(f"`{X.NON_LEAD}`"), F.col(f"`{X.UNKNOWN}`")
    tot, known = lead + non + unk, lead + non
    avg = F.col("_year_sum") / F.nullif(F.col("_year_n"), F.lit(0))
    return counts.select(
        "name", lead.alias(X.LEAD), non.alias(X.NON_LEAD), unk.alias(X.UNKNOWN),
        tot.alias("total_points"), known.alias("known_points"),
        X.safe_ratio(lead, tot).alias("pct_lead_total"), X.safe_ratio(non, tot).alias("pct_nonlead_total"),
        X.safe_ratio(unk, tot).alias("pct_unknown"), X.safe_ratio(lead, known).alias("pct_lead_known"),
        X.safe_ratio(non, known).alias("pct_nonlead_known"), avg.alias("avg_year_built"),
        F.nullif(F.col("_year_n"), F.lit(0)).alias("count_year_samples"),
        (F.lit(float(cur_year)) - avg).alias("avg_house_age"))


def run_available(stream: DataFrame, query_name: str, checkpoint: str):
    """Drain all available files once (``availableNow``) into a memory table."""
    q = (stream.writeStream.outputMode("complete").format("memory").queryName(query_name)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
