"""Headline queries, timed: one JSON line for the driver.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from maskmetrics.plans import load_queries  # noqa: E402
from maskmetrics.session import local_session  # noqa: E402

HEADLINES = (
    "revenue_by_client_masked", "revenue_billing_series", "sla_performance_table", "ticket_volume_series",
    "project_phase_summary", "resource_utilization_table", "quarter_against_prior", "alias_registry",
    "masked_line_texts", "masked_line_texts_by_join", "masked_table_by_value", "restored_line_texts",
    "rewritten_query_log", "detections_by_source", "replaced_documents", "searched_documents",
    "model_columns", "verified_reports",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, 8 if cpus == "*" else int(cpus), "bench")
    queries, _ = load_queries()
    # One untimed round on the smaller tables beside the measured ones: the JVM compiles, the
    # Python workers start. The measured tables themselves are not touched before.
    warm = str(Path(sf_dir).parent / "sf0.001")
    for name in wanted if Path(warm).is_dir() else ():
        queries[name](spark, warm).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        # Every column of every row is computed and dropped.
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
