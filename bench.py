"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR names the test tables (default sf0.1), BENCH_CPUS the local threads (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import suite.catalog  # noqa: E402,F401
from suite.registry import QUERIES  # noqa: E402
from zonecraft.session import build_session  # noqa: E402

HEADLINE = [
    "j03_zone_control_join",
    "o01_zones_sorted",
    "j12_region_controls",
    "j01_seed_households",
    "j02_seed_persons",
    "w01_assign_hhid",
    "y01_incidence",
    "y03_seed_targets",
    "u03_stack_comparisons",
    "a10_run_report",
    "p33_report_columns",
    "a11_summarize_controls",
    "y08_integerize",
    "y04_rake",
    "y09_sub_balance",
    "y13_gq_synthesis",
    "y10_expand",
    "j13_replica_persons",
    "y11_zone_summary",
    "y04_fit_all_controls",
    "y07_fit_regional",
    "y09_fit_zones",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["s02_read_forecast_years"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
