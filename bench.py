"""Time the headline queries; print one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` apply."""

from __future__ import annotations

import json
import os
import statistics
import time

from catalog import QUERIES
from targetlens.session import local_session

HEADLINE = [
    "mart_select",
    "keyword_filter",
    "keyword_extract",
    "token_match",
    "dedup_keep_first",
    "max_per_key",
    "principal_isoform",
    "argmax_per_group",
    "human_orthologue",
    "string_join_repeats",
    "conserved_value",
    "annotation_regex",
    "domain_go_map",
    "descendants",
    "ontology_criterion",
    "family_criteria_table",
    "criteria_fold",
    "chunk_numbers",
    "quality_report",
    "manual_table",
    "full_target_table",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, median wall time of each, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "runs": RUNS,
                "spark": spark.version,
                "cpus": spark.sparkContext.defaultParallelism,
            }
        )
    )


if __name__ == "__main__":
    main()
