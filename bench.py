"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Each query runs once to warm up and is then timed;
rows are consumed by a no-op sink, so nothing is gathered on the driver.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from starfold.checks import load_all  # noqa: E402

HEADLINE = [
    "flagship_sample_counts", "j01_cone", "j02_match_one_to_one", "j03_nearest_many_to_one", "j05_merge_pairs_left",
    "j16_precedence_dedupe", "s09_epoch_propagation", "s14_dense_id", "h01_histogram_2d", "m03_maximum_filter",
    "m06_lookup_membership", "r02_priorities_ursaminor", "f17_field_of_view", "j17_reach", "j18_visible_edges",
    "j22_colliding_elbows", "u01_merge_lists", "u04_merge_flux_lists", "u06_wide_magnitudes", "w02_rank_by_brightness",
    "w05_conflict_free_assignment", "v05_objective", "g04_completeness", "w09_flux_by_band", "io12_export_rows",
]


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.log.level", "ERROR").getOrCreate())
    queries = load_all()[0]
    spent = {}
    for name in names:
        times = []
        for k in range(runs + 1):
            t = time.time()
            queries[name](spark, data).write.format("noop").mode("overwrite").save()
            if k or runs == 0:
                times.append(time.time() - t)
        spent[name] = round(statistics.median(times), 3)
        print(name, spent[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_time_headline_queries", "value": round(sum(spent.values()), 3), "unit": "sec",
                      "queries": spent, "sf": data.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


main()
