"""Time the headline queries: warm session, whole result computed, nothing collected."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hazardlake.plans.catalog import REGISTRY  # noqa: E402
from hazardlake.session import build_session  # noqa: E402

HEADLINE = [
    "station_window_status",
    "silver_iot_routed",
    "gold_iot_flat",
    "fire_classify",
    "silver_sat_pixels",
    "gold_sat_flat",
    "gold_sat_from_messages",
    "vocabulary_terms",
    "tfidf_weights",
    "centroid_classify",
    "embedding_centroid",
    "recent_per_stream",
    "latest_per_key",
    "near_station_match",
    "point_in_cell",
    "dim_upsert_lww",
    "time_remap",
    "stratified_split",
    "stream_area_windows",
    "stream_gold_iot",
    "stream_gold_sat",
    "gold_iot_event",
    "gold_sat_from_arrays",
    "gold_social_classified",
    "class_rebalance",
    "fire_forest",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.hazardlake.spreadTasks": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)  # warm-up: class loading, code generation, file cache
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
