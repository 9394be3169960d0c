"""Time the headline queries; prints one JSON line.

Each query is run in full into a sink that discards rows, once to warm up and
once timed, so the figure is the work of the query and not of fetching rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import load  # noqa: E402
from loamgrid.session import local_session  # noqa: E402

HEADLINE = [
    "depth_overlap_join", "linear_mean", "composition_mean", "least_transmissive", "dominant_component", "aws_family",
    "soc_family", "root_zone", "crop_ratings", "wetland_percent", "surface_texture", "horizon_properties", "valu1",
    "soil_properties", "rasterize_2d_float", "rasterize_3d_slice", "unmatched_keys", "region_key_inventory",
    "point_lookup", "pixel_window", "key_equality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(
        cores, int(cores) if cores.isdigit() else 8,
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            # small inputs: let a stage use every core
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = load(), {}
    for name in HEADLINE:
        for attempt in range(2):
            start = time.perf_counter()
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
