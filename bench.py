"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

QUERIES = [
    "flagship_road_classes",
    "d2_pois",
    "d5_roads",
    "d6_buildings",
    "d8_admin_boundaries",
    "g1_node_lookup_join",
    "g2_join_intersects",
    "g3_join_within",
    "h7_tile_features",
    "h7_tile_features_lines",
    "h14_tile_mvt",
    "h16_tileset",
    "h18_zoom_pyramid_lines",
    "i2_metric_windows",
    "i2_metric_windows_daily",
    "i4_alerts",
    "l1_stream_windows",
    "m3_road_junctions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or QUERIES
    from geoloom import session
    from geoloom.plans import QUERIES as registered

    spark = session.build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr)
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
