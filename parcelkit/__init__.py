"""parcelkit: areal statistics and point-inventory analytics on Spark DataFrames.

Sub-packages:
  functions  - Column-level rules (cleaning, geometry, schema resolution)
  operators  - DataFrame -> DataFrame operators (spatial joins, areal
               aggregation, summaries, model, map-layer tables)
  sources    - scans and sinks (parquet, CSV, GeoJSON, WKB, paged services)
  plans      - end-to-end flows and the registered query catalogue
  streaming  - incremental (micro-batch) form of the point summaries
"""

__version__ = "0.1.0"
