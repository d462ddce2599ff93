"""Benchmark: headline queries on the driver tables, one JSON line on stdout.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).
Each query is built and fully executed into the ``noop`` sink, so the time
covers planning, any staged intermediates and the whole result, without
pulling rows to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "address_list",
    "area_assembly_stats",
    "point_in_area",
    "point_in_area_multi",
    "point_in_area_hole",
    "nearest_left",
    "nearest_cells",
    "features_union",
    "house_numbers",
    "way_geometry_kind",
    "explode_struct",
    "collect_sorted",
    "dedupe_max",
    "reproject_utm",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]

    from mapweave.plans import catalog
    from mapweave.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus)), app="mapweave-bench")
    # warm-up outside the timings (JVM classes, Python workers) on the smallest tables when present
    warm_dir = "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    for name in ("point_in_area", "area_assembly_stats"):
        catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
