"""Print the physical operator tree of registered queries (explain "formatted", tree part).

usage: python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from proficio.plans.registry import queries  # noqa: E402
from proficio.session import get_session  # noqa: E402


def tree(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan, without AQE wrappers
    try:
        jvm = spark._jvm
        text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    out = []
    for line in text.splitlines()[1:]:
        if not line.strip():
            break
        out.append(line)
    return "\n".join(out)


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    for name in args:
        if name == "rank_pass":  # the distributed rank of global_rank, before its write
            from proficio.operators.ranking import RankSpec, ranked_values
            from proficio.plans.registry import models
            y = models(spark, sf).assessment_yoy.select("school_id", "school_year", "composite_pct")
            df = ranked_values(y, [RankSpec("composite_rank", "composite_pct")])[0]
        elif name == "scd2_pass":  # one SCD-2 comparison: history of 1997 vs the 1998 release
            from pyspark.sql import functions as F
            from proficio.operators import scd2
            from proficio.plans.registry import models
            from proficio.session import new_table_path
            att = models(spark, sf).stg_attendance.select("school_id", "school_year",
                                                          "absenteeism_tier")
            path = new_table_path(spark, "explain-scd2")
            scd2.snapshot_run(spark, path, att.filter("school_year = 1997").drop("school_year"),
                              ["school_id"], ["absenteeism_tier"], F.lit("1997-07-01 00:00:00"))
            hist = scd2.latest(spark, path)[1]
            df = scd2.scd2_apply(hist, att.filter("school_year = 1998").drop("school_year"),
                                 ["school_id"], ["absenteeism_tier"], F.lit("1998-07-01 00:00:00"))
        else:
            df = queries()[name](spark, sf)
        print(f"### {name}\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
