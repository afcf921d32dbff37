"""strata: layered (bronze / silver / gold) analytics tables on Spark.

Everything is expressed as DataFrame / SQL / Structured Streaming plans:

* ``strata.sources``   - raw feeds, versioned Parquet tables, JSON scans, change feeds
* ``strata.functions`` - pure Column helpers (JSON paths, cleaning, time)
* ``strata.operators`` - dedup, upsert, incremental slices, rollups, quality checks
* ``strata.plans``     - the silver / gold builds, reports and table maintenance
* ``strata.streaming`` - streaming ingest, streaming upsert, windowed rates
"""

from strata.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
