"""Seed CSV files: typed read (key kept as text) and write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# Keys and zip codes are text: type inference would turn '0089' into 89.
REGIONS_SCHEMA = StructType([
    StructField("organization_code", StringType()),
    StructField("region", StringType()),
])
LOCATIONS_SCHEMA = StructType([
    StructField("organization_code", StringType()),
    StructField("school_name", StringType()),
    StructField("address", StringType()),
    StructField("city", StringType()),
    StructField("state", StringType()),
    StructField("zip_code", StringType()),
])

_CSV = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
        "multiLine": "false", "mode": "FAILFAST"}


def read_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """RFC-4180 CSV with header: doubled quotes inside quoted fields, UTF-8.

    The explicit schema replaces type inference (no extra pass over the file)
    and keeps code columns as text.
    """
    return spark.read.schema(schema).options(**_CSV).csv(path)


def write_seed(df: DataFrame, path: str) -> None:
    """Write a DataFrame as seed CSV (header, doubled quotes), one task per partition."""
    (df.write.mode("overwrite").option("header", "true").option("quote", '"')
       .option("escape", '"').option("encoding", "UTF-8").csv(path))
