"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_QUERIES
(comma-separated names, or "all") choose what runs. Each query runs once to warm up
and once timed, into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskfeat.plans.oracle import oracle  # noqa: E402
from riskfeat.plans.queries import REGISTRY  # noqa: E402
from riskfeat.session import local_session  # noqa: E402

HEADLINE = [
    "user_amount_stats",
    "trailing_day_stats",
    "sessionize",
    "first_last_behaviour",
    "popularity_user_stats",
    "value_user_popularity",
    "shared_resource_stats",
    "pairwise_cross",
    "label_encode",
    "stratified_folds",
    "oof_mean_encode",
    "event_target_encode",
    "user_sequences",
    "tfidf_weights",
    "roc_auc",
    "blend_scores",
    "pivot_amount_by_category",
    "user_nunique",
    "has_and_session_counts",
    "group_amount_to_rows",
    "woe_encode",
    "event_target_encode_rows",
    "ordered_target",
    "user_tfidf_weights",
]


def chosen() -> list[str]:
    wanted = os.environ.get("BENCH_QUERIES", "")
    if wanted == "all":
        return list(oracle())
    return wanted.split(",") if wanted else HEADLINE


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds: dict[str, float] = {}
    for name in chosen():
        for _ in range(2):
            start = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
