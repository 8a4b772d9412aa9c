"""Sources and sinks: raw-table catalog, test-table adaptors, seeds, writers."""

from proficio.sources.catalog import Catalog, csv_catalog, parquet_catalog, test_table_catalog
from proficio.sources.seeds import LOCATIONS_SCHEMA, REGIONS_SCHEMA, read_seed, write_seed
from proficio.sources.sinks import write_clustered, write_csv_extract, write_table

__all__ = [
    "Catalog", "csv_catalog", "parquet_catalog", "test_table_catalog",
    "LOCATIONS_SCHEMA", "REGIONS_SCHEMA", "read_seed", "write_seed",
    "write_clustered", "write_csv_extract", "write_table",
]
