"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is fully executed (written to a no-op sink, so every row and
column is computed) after one warm-up run of the flagship query; the
reported value is the sum of the per-query wall times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["bronze_contacts", "golden_contacts", "steward_queue", "rfm_features", "fact_events",
            "anomaly_flags", "dq_rules", "null_rate", "merge_upsert", "duplicates_exact",
            "match_tiers", "merged_groups", "personas", "feedback_scored", "row_filter",
            "review_queue", "daily_run", "unique_check", "accepted_values", "dictionary_rules"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from goldvein.session import build_session
    from goldvein.plans.catalog import QUERIES
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="goldvein-bench-")})
    QUERIES["fact_events"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(name)
    except ValueError:
        sf = name
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
