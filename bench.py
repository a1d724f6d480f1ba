"""Benchmark: run the headline registered queries end to end and print ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list, optional)
Each query is executed fully with the ``noop`` sink (no collect to the driver); the value is the sum of the
per-query wall times of a warm run (one cold run first warms the JVM and the file cache).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mvbs_big", "mvbs", "nasc", "compute_sv", "denoise_chain", "seabed_composite", "correct_echo_range",
    "extract_track", "add_location", "nav_carry_forward", "segment_summary", "config_fold", "segment_trigger",
    "file_summary", "run_report", "echogram_raster",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from acoustispark.plans import registry
    from acoustispark.session import get_session
    spark = get_session(f"local[{cpus}]", max(cpus, 8), extra={"spark.ui.enabled": "false",
                                                              "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    reg = registry()
    names = os.environ.get("BENCH_QUERIES")
    names = [n for n in (names.split(",") if names else HEADLINE) if n in reg]
    timings: dict[str, float] = {}
    cold: dict[str, float] = {}
    for n in names:
        fn = reg[n][0]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        cold[n] = round(time.time() - t0, 3)
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[n] = round(time.time() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_warm_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "cold": cold, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
