"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # silver: cleanse + flags + dedup (window with partial group limit)
    "silver_customers", "silver_products", "silver_orders", "silver_items", "silver_deliveries",
    "silver_tickets",
    # gold: dimensions, calendar, facts with FK resolution
    "gold_dim_vendedor", "gold_dim_data", "gold_fact_pedidos", "gold_fact_pedidos_itens",
    "gold_fact_entregas", "gold_fact_ocorrencias",
    # business questions
    "k01_kpis", "k04_revenue_by_region", "k06_revenue_by_category", "k07_monthly_revenue",
    "k08_lead_time_by_carrier", "k09_item_customer_product", "k10_segment_kpis",
    # checks and profiles
    "v01_row_counts", "v05_unique_grain", "l05_duplicate_keys", "l10_format_shapes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("starloom-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions",
                     os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
             # The test tables are single files of few row groups: deal them to all cores.
             .config("spark.starloom.spread", os.environ.get("BENCH_SPREAD", cpus))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from starloom import get_session
    get_session()  # applies the library's runtime settings to this session
    from starloom.plans.catalog import queries

    qs = queries()
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or HEADLINE
    # Warm-up: JIT and file listing, not timed.
    qs["silver_channels"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep benchmarking; report the failure in the JSON line
            timings[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(v for v in timings.values() if v is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
