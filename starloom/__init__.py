"""starloom: a Spark-native star-schema warehouse.

Layers (raw -> staging -> core -> aggregation) are plain DataFrame -> DataFrame
functions; Catalyst and AQE do the planning. Sub-packages:

- ``sources``   raw table scans, staging views, seed files
- ``functions`` column-expression helpers (keys, calendar parts, money)
- ``operators`` dimensions, SCD2, point-in-time join, facts, upsert,
                data-quality checks, marts, layout and workload jobs
- ``plans``     the named query catalogue and its DuckDB oracle SQL
- ``streaming`` Structured Streaming drivers (foreachBatch upsert / SCD2)
"""

__version__ = "0.1.0"
