"""access_lake: a PySpark-native lakehouse that measures how fairly services
are spread over areas.

Layout
------
functions/  column expressions (standardisers, name keys, rates, scores)
operators/  DataFrame operators (dedup, aggregates, joins, ranking, history,
            data-quality checks, roll-ups)
sources/    readers and writers (landing NDJSON, census CSV, GeoJSON, seeds,
            raw tables) and the adapters that map the driver's tables onto
            the product's raw tables
plans/      composite products: staging views, marts, dashboards, monthly run
streaming/  incremental landing-to-raw ingestion with Structured Streaming
"""

from access_lake.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
