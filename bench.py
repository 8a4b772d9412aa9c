"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "headline_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query runs to completion through the no-op sink (every row computed,
nothing collected); the value per query is the median of the timed rounds
after one warm-up round of all queries.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "school_improvement",       # flagship: growth, score, nine distributed ranks
    "school_improvement_yoy",   # window lag fact
    "story_consistency_top5",   # aggregation + top-n per region
    "global_rank",              # distributed rank over all school-years
    "school_performance",       # four-way scorecard join
    "incremental_upsert",       # partition-local MERGE
    "scd2_check_snapshot",      # five SCD-2 runs
]


def session(cpus: str) -> SparkSession:
    return (SparkSession.builder.master(f"local[{cpus}]").appName("proficio-bench")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "16g")
            .getOrCreate())


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    from proficio.plans.registry import queries
    qs = queries()
    errors: dict[str, str] = {}
    samples: dict[str, list[float]] = {name: [] for name in only or HEADLINE}
    for rep in range(reps + 1):  # round 0 warms up; rounds are interleaved, so drift hits all queries alike
        for name in [n for n in samples if n not in errors]:
            try:
                t0 = time.perf_counter()
                run(qs[name](spark, sf_dir))
                if rep:
                    samples[name].append(time.perf_counter() - t0)
            except Exception as e:  # report the failure, keep measuring the others
                errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    times = {n: round(statistics.median(x), 3) for n, x in samples.items() if x and n not in errors}
    extra = {}
    if not only and os.environ.get("BENCH_COMPARE", "1") == "1":
        # reference point: the same global rank as one unpartitioned window (single task)
        from pyspark.sql import Window
        from pyspark.sql import functions as F
        from proficio.plans.registry import models, portable

        def plain(spark, d):
            y = models(spark, d).assessment_yoy.select("school_id", "school_year", "composite_pct")
            return portable(y.withColumn("composite_rank", F.rank().over(
                Window.orderBy(F.col("composite_pct").desc_nulls_last()))))

        run(plain(spark, sf_dir))
        samples = []
        for _ in range(reps):
            t0 = time.perf_counter()
            run(plain(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        extra["global_rank_single_task_window"] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "compare": extra, "sf": float(m.group(1)) if m else sf_dir}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
