"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  Every query is
run once to warm up and then three times, or once if slow; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from tidemill.session import local_session  # noqa: E402

HEADLINE = [
    "group_aggregate_mean",
    "clean_dataset",
    "profile_dataset",
    "clean_corpus",
    "dedup_paragraphs",
    "extract_all",
    "chunk_words",
    "chunk_chars",
    "html_to_markdown",
    "api_to_dataset",
    "doc_assemble",
    "vector_topk",
    "semantic_query",
    "web_corpus_search",
]
RUNS = 3
SLOW_SECONDS = 4.0


def seconds(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, sf_dir, name)
        runs = [seconds(spark, sf_dir, name)]
        while len(runs) < RUNS and runs[0] < SLOW_SECONDS:
            runs.append(seconds(spark, sf_dir, name))
        times[name] = round(statistics.median(runs), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir}))


if __name__ == "__main__":
    main()
