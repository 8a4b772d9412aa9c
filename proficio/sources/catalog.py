"""Named raw tables.

The pipelines ask for raw tables by name (``demographic``, ``assessment``,
``absenteeism``, ``school_regions``, ``school_locations``); a catalog maps
each name to a lazy DataFrame.  Production points the names at Parquet or
CSV paths; the test catalog reshapes the driver's tables into the raw
school schemas (see :mod:`proficio.sources.adaptors`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("demographic", "assessment", "absenteeism", "school_regions", "school_locations")


class Catalog:
    """name -> lazy DataFrame loader (loaders run once per catalog)."""

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._loaders:
                raise KeyError(f"unknown raw table {name!r}; known: {sorted(self._loaders)}")
            self._cache[name] = self._loaders[name]()
        return self._cache[name]

    def point(self, name: str, path: str) -> None:
        """Read ``name`` from a Parquet table from now on (a loaded seed)."""
        self._loaders[name] = lambda: self.spark.read.parquet(path)
        self._cache.pop(name, None)

    def names(self) -> list[str]:
        return sorted(self._loaders)


def parquet_catalog(spark: SparkSession, paths: Mapping[str, str]) -> Catalog:
    """Raw tables stored as Parquet (one path per name)."""
    return Catalog(spark, {n: (lambda p=p: spark.read.parquet(p)) for n, p in paths.items()})


def csv_catalog(spark: SparkSession, paths: Mapping[str, str]) -> Catalog:
    """Raw tables stored as CSV with a header.

    The two seeds get their typed schemas (codes stay text); the raw extracts
    are read with every column as text (no inference pass), which is what the
    cleaning functions expect.
    """
    from proficio.sources.seeds import LOCATIONS_SCHEMA, REGIONS_SCHEMA, read_seed

    schemas = {"school_regions": REGIONS_SCHEMA, "school_locations": LOCATIONS_SCHEMA}

    def loader(name: str, path: str):
        if name in schemas:
            return lambda: read_seed(spark, path, schemas[name])
        return lambda: (spark.read.option("header", "true").option("escape", '"')
                        .option("inferSchema", "false").csv(path))

    return Catalog(spark, {n: loader(n, p) for n, p in paths.items()})


def test_table_catalog(spark: SparkSession, sf_dir: str, cutoff: str | None = None,
                       revised: int | None = None, shared_from: int | None = None) -> Catalog:
    """Raw school tables built from the driver's test tables in ``sf_dir``.

    ``cutoff`` ('YYYY-MM-DD') simulates an earlier extract of the
    demographic source: only orders before that day are counted; ``revised``
    (a school year) a later one, with renamed, closed and withdrawn schools.
    ``shared_from`` (a school year): the plan reads the assessment and the
    absenteeism extract from that year on, so the lines behind both are
    scanned once, with the columns of both.
    """
    from proficio.sources import adaptors as A

    tables: dict[str, DataFrame] = {}

    def t(name: str) -> DataFrame:
        if name not in tables:
            tables[name] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        return tables[name]

    def li() -> DataFrame:
        if "_li_agg" not in tables:
            tables["_li_agg"] = (A.lineitem_by_part_year(t("lineitem")) if shared_from is None else
                                 A.lineitem_shared(t("lineitem"), shared_from))
        return tables["_li_agg"]

    return Catalog(spark, {
        "demographic": lambda: (A.raw_demographic(t("orders"), t("customer"), cutoff) if revised is None else
                                A.revised_demographic(A.raw_demographic(t("orders"), t("customer"), cutoff), revised)),
        "assessment": lambda: A.raw_assessment(t("lineitem"), t("part"), li()),
        "absenteeism": lambda: A.raw_absenteeism(t("lineitem"), t("part"), li()),
        "school_regions": lambda: A.raw_regions(t("part"), t("region")),
        "school_locations": lambda: A.raw_locations(t("part")),
    })
