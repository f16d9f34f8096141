"""Benchmark: headline queries at one scale factor, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (full execution, no collect); PageRank queries
run their rounds eagerly.  Every query runs ``BENCH_RUNS`` times (3) after a warm-up and the median counts.

The driver's tables are files of one row group, which Parquet cannot split, so that a scan is one task however
many cores there are.  The queries are timed on a copy in several files, the layout of any larger table, made
before the clock starts (``"layout": "split"``); ``"plain_scan"`` has each query's time, run once, on the tables as
they are.

``BENCH_EVENT_LOG_DIR=<folder>`` also writes Spark's event log there, for per-stage and per-task times
without the web UI.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankloom import local_session  # noqa: E402
from rankloom.plans import catalog  # noqa: E402

HEADLINE = [
    "doc_word_count", "term_frequency", "tfidf", "search", "search_keyword_table", "rank_documents",
    "top_k_documents", "page_links", "wiki_parse_all", "node_count_union",
    "pagerank_keep_uncited", "pagerank_all_nodes", "pagerank_cited_only",
]
TABLES = ["documents", "benchmark", "pages", "lineitem", "orders"]


def seconds(spark, name: str, sf_dir: str, runs: int) -> float:
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", 3))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(cpus, shuffle_partitions=cpus, extra=extra)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    with tempfile.TemporaryDirectory(prefix="rankloom-bench-") as split:
        for table in TABLES:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(2 * cpus).write.parquet(f"{split}/{table}.parquet")
        for name in ("doc_word_count", "pagerank_cited_only"):  # warm-up
            seconds(spark, name, split, 1)
        times = {name: seconds(spark, name, split, runs) for name in HEADLINE}
        plain = {name: seconds(spark, name, sf_dir, 1) for name in HEADLINE}
        spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs, "layout": "split", "plain_scan": plain}))


if __name__ == "__main__":
    main()
