"""zonecast: hourly mobility demand on Spark.

Trip records, station ridership and zone polygons are cleaned, assigned to
zones and aggregated to one row per (zone, hour); exploratory profiles and two
demand models run on the combined table. Everything is a DataFrame plan;
nothing but a few model-sized numbers ever reaches the driver.

Sub-packages:
  sources    - readers (Parquet, CSV, multi-month scans) and the test views
  functions  - column expressions (renames, casts, time parts, geometry math)
  operators  - cleaning rules, hourly aggregation, spatial join, combine,
               exploration, models
  sinks      - writers (partitioned Parquet, CSV, GeoJSON lines)
  plans      - end-to-end demand plans and the query registry
  streaming  - intentionally empty (the surveyed workload is batch only)
"""

__version__ = "0.1.0"
