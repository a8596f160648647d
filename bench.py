"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local threads, BENCH_SLICE (optional)
a comma-separated list of query names to time instead of the headline set.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lodeworks.queries import QUERIES
from lodeworks.session import build_session

HEADLINE = [
    # layers and marts
    "cln_vbak",
    "cln_vbap",
    "cln_tags",
    "agg_sales_daily",
    "agg_tag_alarm",
    "agg_coal_quality",
    # the four-table join and its questions
    "join_left_chain",
    "agg_wide_production_sales",
    "agg_wide_pricing",
    "agg_wide_safety",
    "agg_wide_fulfillment",
    # quality: single checkpoint, full run, root causes
    "dq_rule_run_vbak",
    "dq_rule_run_vbap",
    "dq_rule_run_kna1",
    "dq_rule_run_tags",
    "dq_rule_run_samples",
    "dq_rule_run_doc_flow",
    "dq_checkpoint",
    "dq_check_orders",
    "dq_check_sensor",
    "dq_check_lab",
    "dq_root_link",
    "dq_root_spike",
    # repairs and series
    "rep_link_flag",
    "rep_clamp_p995",
    "rep_clamp_range",
    "rep_fill_gap",
    "win_dedup_first",
    "win_diff_gap",
    "agg_quantile",
    "agg_monthly_rollup",
    "dim_mine",
    "dim_scd2",
    "lin_blast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    picked = os.environ.get("BENCH_SLICE")
    names = picked.split(",") if picked else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The JVM starts cold; one small job keeps that out of the first query's time.
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    cold, timings = {}, {}
    for name in names:
        # Each query runs twice in full, nothing cached in between. The second time is reported:
        # the first also pays for compiling the query's generated code.
        for target in (cold, timings):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            target[name] = round(time.perf_counter() - start, 3)
            spark.catalog.clearCache()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "first_run_total": round(sum(cold.values()), 3),
        "first_run": cold,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
