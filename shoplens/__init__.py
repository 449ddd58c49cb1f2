"""shoplens: clickstream analytics for shops, expressed as Spark DataFrame plans.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``sources``   raw CSV reader, incremental file discovery, fixture adapter
* ``functions`` column expressions (buckets, calendar, exact rounded ratios)
* ``operators`` reusable distributed operators (global rank / NTILE / exact
  percentile, two-level distinct aggregation, size-checked joins, DQ rules)
* ``plans``     ingest, staging, facts, marts, checks, dashboards
* ``streaming`` incremental ingest on Structured Streaming
"""

__version__ = "0.1.0"
