"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is executed fully with the ``noop`` sink (no collect); the
session start-up is excluded, polygon-layer caching is part of the run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelkit.plans.catalog import QUERIES  # noqa: E402
from parcelkit.session import build_session  # noqa: E402

HEADLINE = [
    "lead_by_neighborhood",   # J1 + X1 + A7-A9 (flagship)
    "house_master",           # three PIP joins with prefixes
    "match_table",            # J3 exact overlay + A3
    "race_from_matches",      # J6 + A4
    "areal_shares",           # F1 + J3 + J11 + A1
    "three_tier_fill",        # A2 + J4 + J5 + J7
    "imputed_summary",        # X2-X5 + A12
    "numeric_profile",        # A16 exact distributed quantiles
    "categorical_profile",    # A17
    "year_bins",              # A18
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # warm the scheduler and JIT with a trivial job (no fixture or query work)
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
