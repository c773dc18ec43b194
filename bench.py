"""Benchmark the headline queries.

Runs each query end to end from the parquet tables (no caching between
queries) into Spark's ``noop`` sink, so every row is computed but nothing
is shipped to the driver. The L4 and K11 queries read stored warehouse tables;
their second load is timed once as ``load_2_*``. One warm-up pass, then ``BENCH_RUNS`` timed
passes; the per-query figure is the median. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (default 3), BENCH_QUERIES (comma list, default headline set)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlake.plans.etl import warehouse  # noqa: E402
from marketlake.plans.model import stored_fact  # noqa: E402
from marketlake.plans.registry import all_queries  # noqa: E402
from marketlake.session import build_session  # noqa: E402

HEADLINE = [
    "v1_seller_quarterly", "v2_market_leaders", "v3_segment_median", "v4_seller_delay_tier",
    "v5_segment_delay_risk", "v6_late_counts", "v7_l6m_late_rate", "v8_delay_rank",
    "v9_category_performance", "v10_top_categories", "v11_price_tiers", "v12_state_reliability",
    "v13_mom_growth", "l1_latest", "l2_collapse_items", "l3_review_dedup", "k4_missing_pct",
    "a1_box_stats", "a14_a15_state_median",
    "l4_upsert_orders", "l4_upsert_items", "k11_link_orphans",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def load_times(spark, sf_dir) -> dict[str, float]:
    """Seconds of the second load of orders and items into stored tables, once; the warehouse then serves the L4 and K11 queries."""
    wh = warehouse(spark, sf_dir, refresh=True)
    for name in wh.TABLES:
        wh.versions(name, 1)
    out = {}
    for name in ("orders", "geolocation", "products", "sellers", "items"):
        t0 = time.perf_counter()
        wh.versions(name, 2)
        if name in ("orders", "items"):
            out[f"load_2_{name}"] = time.perf_counter() - t0
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": "64m"})
    qs = all_queries()

    def build_fact(spark, sf_dir):
        # the load step the views depend on: lineitem grain collapse -> stored item fact
        t0 = time.perf_counter()
        stored_fact(spark, sf_dir, refresh=True)
        return time.perf_counter() - t0

    build_fact(spark, sf_dir)
    loads = load_times(spark, sf_dir) if any(n.startswith(("l4_", "k11_")) for n in names) else {}
    for n in names:  # warm-up: JIT, file listing, parquet footers
        run_once(spark, qs[n], sf_dir)
    timings = {"model_fact_build": statistics.median(build_fact(spark, sf_dir) for _ in range(runs))}
    timings.update(loads)
    timings.update({n: statistics.median(run_once(spark, qs[n], sf_dir) for _ in range(runs)) for n in names})
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": {k: round(v, 3) for k, v in timings.items()},
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
