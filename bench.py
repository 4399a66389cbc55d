"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local threads, BENCH_QUERIES
(comma separated name prefixes, or ``all``) another selection.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbside.plans import catalog  # noqa: E402
from kerbside.session import build_session  # noqa: E402

HEADLINE = [
    "s2_page_messages", "s3_structured_readings", "s4_insert_if_absent", "s9_snapshot_log",
    "a1_snapshot_totals", "w1_sequences", "m12_slot_multipliers",
    "a3_summary", "a4_histograms", "a5_box_summary", "a11_auc", "m13_scored_fleet", "a10_classification_report",
    "j1_district_waste", "g3_centroids", "j4_nearest_nodes", "g1_travel_matrix", "g2_trip_paths", "j3_slot_matrix",
    "j6_greedy_fill", "w4_drawn_slots", "a7_plan_costs", "o1_best_plan", "n1_p10_plan_view", "r8_plan_audit",
    "w2_capacity_split", "w6_tour_lengths", "w8_depot_shares",
    "r1_initial_population", "r2_population_costs", "r3_tournament", "r4_crossover", "r5_repaired_plans", "r6_mutated_plans",
]


def chosen(names: list[str]) -> list[str]:
    wanted = os.environ.get("BENCH_QUERIES")
    if not wanted:
        return [n for n in HEADLINE if n in names]
    if wanted == "all":
        return names
    return [n for n in names if n.startswith(tuple(wanted.split(",")))]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warm the JVM
    queries = catalog.queries()
    seconds = {}
    for name in chosen(list(queries)):
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
