"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written to the ``noop`` sink, so that every row and column is
computed and nothing is collected. The best of ``BENCH_RUNS`` runs counts,
after one warm-up query for the JVM.
"""

from __future__ import annotations

import json
import os
import time

from storespark.session import build_session
from storespark.testbed import registry

HEADLINE = [
    "daily_kpis", "sales_by_shelf_historical", "sales_by_shelf_current", "breakage_by_shelf_historical",
    "breakage_by_shelf_current", "margins_by_product_shelf", "inventory_by_shelf", "shelf_detail",
    "shelf_movements_current", "overview_totals", "overview_trend", "shelf_products_grid", "shelf_level_kpis",
    "share_of_shelf", "share_of_sales", "shelf_mix_kpis", "validate_split", "validation_counts",
    "enrich_shelf_position", "net_stock_delta", "inventory_apply", "replenishment_candidates", "brand_names",
    "extract_brand", "sample_by_category", "dedupe_products", "product_registry", "audit_foreign_keys",
    "audit_domains", "batch_load",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "storespark-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__log__level="ERROR",
    )
    spark.sparkContext.setLogLevel("OFF")

    def once(key: str) -> float:
        start = time.perf_counter()
        registry.QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once("table_row_count")
    seconds = {}
    for key in HEADLINE:
        # the pipeline writes a new warehouse per run, so it runs once
        seconds[key] = round(min(once(key) for _ in range(1 if key == "batch_load" else runs)), 3)
    result = {
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
        "cpus": cpus,
        "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
