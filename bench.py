"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) is the input, ``BENCH_CPUS``
(default 8) the number of local cores. Every query runs from the source tables
to the last row; nothing is shared between queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from certwatch.checks.queries import QUERIES
from certwatch.session import local_session

HEADLINE = (
    "eligible_scan", "dn_clean", "flatten_documents", "token_sort_ratio_pairs",
    "renewal_candidates", "renewals", "possible_matches", "match_outcomes",
    "alert_documents", "upsert_alerts", "run_summary_by_source",
    "action_table", "possible_match_table", "source_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    names = sys.argv[1:] or HEADLINE
    QUERIES["match_outcomes"](spark, "/root/testdata/sf0.001").count()  # start the JVM's and Python's workers
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "certificate analytics, total time of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
