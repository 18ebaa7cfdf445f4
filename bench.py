"""Time the headline queries; prints one JSON line.

Each query runs three times over the whole tables into a sink that discards the rows;
the median counts. Queries that fit a model run once: a fit takes far longer than
compiling, and uses the operators' own rounds and depths on all rows. BENCH_SF_DIR and BENCH_CPUS choose
the tables and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

HEADLINE = (
    "feature_table",
    "training_candidates",
    "item_cooccurrence",
    "candidates_from_cooc",
    "cand_hybrid",
    "rank_topk",
    "evaluate_recommendations",
    "groundtruth_eval",
    "sample_customers",
    "customer_stats",
    "iqr_outliers",
    "cohort_retention",
    "submission_lists",
    "train_logistic",
    "train_gbt_lgbm",
)


def main() -> None:
    from cartwise.plans.registry import QUERIES
    from cartwise.session import build_session

    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    times = {}
    for name in chosen:
        runs = []
        for _ in range(1 if name.startswith("train_") else 3):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(median(runs), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
