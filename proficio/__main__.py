"""Command line: seed / build / run / snapshot / test / story / extract over configured raw tables.

    python -m proficio seed     --config project.json
    python -m proficio build    --config project.json
    python -m proficio run      --config project.json [--select fct_enrollment_trends] [--full-refresh]
    python -m proficio snapshot --config project.json
    python -m proficio test     --config project.json [--select dim_schools]
    python -m proficio story    --config project.json --select story_consistency_top5
    python -m proficio extract  --config project.json [--select fct_school_performance] --out folder

Tests, snapshots, stories, extracts and selected runs read the tables that a build has
written under ``target``; a model without a written table is computed from raw.

project.json:
    {"format": "parquet" | "csv",
     "tables": {"demographic": path, "assessment": path, "absenteeism": path,
                "school_regions": path, "school_locations": path},
     "target": path,
     "params": {"start_year": 2019, "current_school_year": "2023-2024"}}
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from proficio.params import Params
from proficio.plans import Models, stories
from proficio.plans.incremental import run_enrollment_trends
from proficio.plans.marts import AUDIT_COL
from proficio.plans.project import SEEDS, TABLE_MODELS, TRENDS, build, use_built, use_seeds
from proficio.plans.quality import test_summary
from proficio.plans.snapshots import school_directory_snapshot
from proficio.session import get_session
from proficio.sources.catalog import csv_catalog, parquet_catalog
from proficio.sources.sinks import write_csv_extract, write_table

STORIES = ["story_yoy_trends", "story_consistency_top5", "story_single_group",
           "story_breakthroughs_top3", "story_needs_support"]


def _models(spark, cfg: dict) -> Models:
    make = csv_catalog if cfg.get("format", "parquet") == "csv" else parquet_catalog
    return Models(make(spark, cfg["tables"]), Params(**cfg.get("params", {})))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="proficio")
    ap.add_argument("command", choices=["seed", "build", "run", "snapshot", "test", "story", "extract"])
    ap.add_argument("--config", required=True)
    ap.add_argument("--select", default=None)
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--out", default=None, help="folder of an extract")
    ap.add_argument("--show", type=int, default=20, help="rows to print for test/story")
    a = ap.parse_args(argv)
    with open(a.config, encoding="utf-8") as f:
        cfg = json.load(f)
    spark = get_session()
    target = cfg.get("target", "").rstrip("/")
    m = _models(spark, cfg)
    if a.command == "seed":
        # the two seeds as tables (codes typed as text), like loading seed CSVs
        for name in SEEDS:
            if name in cfg["tables"]:
                write_table(m.catalog.table(name), f"{target}/seeds/{name}")
        return 0
    if a.command == "build":
        res = build(spark, m.catalog, m.p, target, full_refresh=a.full_refresh)
        res.tests.show(100, truncate=False)
        return 0 if res.tests.filter(F.col("failures") > 0).isEmpty() else 1
    use_seeds(m, target)
    if a.command == "run":
        if a.select:
            use_built(m, target, skip=[a.select])
        names = [a.select] if a.select else ["dim_schools", TRENDS,
                                             *[n for n in TABLE_MODELS if n != "dim_schools"]]
        for name in names:
            if name == TRENDS:
                run_enrollment_trends(spark, f"{target}/{name}", m, full_refresh=a.full_refresh)
            elif name in TABLE_MODELS:
                write_table(getattr(m, TABLE_MODELS[name]), f"{target}/{name}")
            else:
                ap.error(f"unknown model {name!r}")
        return 0
    built = use_built(m, target)
    if a.command == "snapshot":
        school_directory_snapshot(spark, f"{target}/scd_school_directory", m.dim_schools,
                                  F.current_timestamp())
        return 0
    if a.command == "test":
        t = test_summary(m, built, select=a.select)
        t.show(100, truncate=False)
        return 0 if t.filter(F.col("failures") > 0).isEmpty() else 1
    if a.command == "extract":
        name = a.select or "fct_school_performance"
        if not a.out or (name not in TABLE_MODELS and name != TRENDS):
            ap.error(f"extract needs --out and one of {[*TABLE_MODELS, TRENDS]}")
        table = built.get("enrollment_trends") if name == TRENDS else getattr(m, TABLE_MODELS[name])
        table = m.enrollment_trends() if table is None else table
        write_csv_extract(table, a.out, drop=[AUDIT_COL])
        return 0
    name = a.select or STORIES[0]
    if name not in STORIES:
        ap.error(f"unknown story {name!r}; one of {STORIES}")
    getattr(stories, name)(m.school_improvement_yoy).show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
