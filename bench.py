"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.plans.catalog import QUERIES  # noqa: E402
from plumbline.session import build_session  # noqa: E402

HEADLINE = [
    "burst_day_store",
    "burst_all",
    "l1_audit",
    "l1_filter",
    "nearest_seed",
    "l2_audit",
    "stage2",
    "embed_missing",
    "template_collisions",
    "semantic_collisions",
    "edges",
    "store_stats",
    "funnel",
    "hist_l2",
    "calibration",
    "upsert_result",
    "merge_preview",
    "copy_forward",
    "pending",
    "sanitize",
    "normalize_reviews",
    "text_norm",
    "pseudonyms",
    "page_reviews",
    "page_facts",
    "crawl_completeness",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    QUERIES["label_summary"](spark, folder).collect()
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[1]) if scale else None,
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
