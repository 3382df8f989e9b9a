"""staygrid: travel, weather and geo analytics written as Spark DataFrame jobs.

Layout
------
sources/    readers, writers, declared schemas, driver-table surrogates
functions/  Column-level building blocks (geohash cells, calendar ranges, geodesy)
operators/  reusable DataFrame -> DataFrame jobs (top-k, profiling, geo joins)
plans/      the composite queries (enrichment, temperature range, busy hotels, ...)
streaming/  Structured Streaming ingest, enrichment and publishing
"""

from staygrid.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
