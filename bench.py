"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of tables (default /root/testdata/sf0.1). BENCH_CPUS: local cores (default 8).
Each query runs once to warm up, then BENCH_RUNS times (default 3); its value is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from shelfcast.catalogue.queries import QUERIES
from shelfcast.session import build_session

HEADLINE = ["daily_ma_all", "enrich_train", "features_vector", "grid_scores_linear", "predict_forest", "predict_gbt",
            "predict_decision", "grid_scores_tree"]
LONG = {"predict_gbt", "predict_decision", "grid_scores_tree"}  # one timed run


def seconds(spark, sf_dir: str, name: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.catalog.clearCache()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("shelfcast-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        if name not in LONG:
            seconds(spark, sf_dir, name)
        timings[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(1 if name in LONG else runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
