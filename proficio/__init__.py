"""proficio — school-growth analytics expressed as Spark DataFrame plans.

Layout:
  functions/  column expressions (cleaning, rounding, labels, ratios)
  sources/    catalog, raw-table adaptors, seed CSV reader, table writers
  operators/  reusable table operators (yoy, endpoints, ranking, top-n,
              dedupe, upsert, SCD-2, data checks, profiling)
  plans/      the dataset pipelines (staging, marts, stories, snapshot)
  streaming/  incremental yearly releases driven by Structured Streaming
"""

from proficio.params import Params
from proficio.plans.build import Models
from proficio.session import get_session
from proficio.sources.catalog import Catalog, csv_catalog, parquet_catalog

__all__ = ["Catalog", "Models", "Params", "csv_catalog", "get_session", "parquet_catalog"]
