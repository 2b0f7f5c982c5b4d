"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from crossfoot.plans.queries import QUERIES
from crossfoot.runtime import build_session

HEADLINE = (
    "unpivot_category_entity",
    "table_profile",
    "num_checks_fused",
    "validation_suite_all",
    "src_total_checks",
    "rec_do04_origin_marginals",
    "rec_all",
    "stat_suite_all",
    "ks_line_prices",
    "psi_line_prices",
    "order_total_vs_lines",
    "unq_natural_key",
    "fk_orphans",
    "gate_decision",
    "incident_aggregate",
    "overview_kpis",
    "detection_matrix",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    names = sys.argv[1:] or HEADLINE
    warm_up = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_up):
        for name in names:
            QUERIES[name](spark, warm_up).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
