"""Benchmark: run the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed in full with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabiya.plans import registry  # noqa: E402
from tabiya.session import get_session  # noqa: E402

HEADLINE = [
    "s01_a01_opening_dashboard", "w08_dashboard_categories", "a02_relative_dashboard", "j01_p26_enriched_games",
    "a10_j03_label_profile", "a11_j11_p14_opening_labels", "w01_theory_exit_tolerant", "w04_w05_post_theory_acl",
    "w07_worst_blunder", "t01_t02_t03_t04_retier_catalog", "t18_i05_message_resources", "m11_w10_opening_levels",
    "r01_j07_resource_search", "r02_direct_profile_recommender", "j09_knn_neighbours", "a12_audit_by_band",
    "r07_r08_label_driven_plan", "t01_t05_t14_documents_volume", "r05_three_priority_search", "r06_study_plan",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", cpus, shuffle_partitions=int(cpus) * 2)
    qs = registry.queries()
    # warm-up: JVM, code paths, file listing
    qs["s01_a01_opening_dashboard"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
