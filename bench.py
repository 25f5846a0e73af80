"""Time the headline queries and print one JSON line.

Every query runs to the end into a sink that discards its rows, once to warm
up and then ``BENCH_RUNS`` times; the median is reported. Each time is printed as
it comes. A query that takes longer than ``BENCH_LIMIT`` seconds is stopped,
named under ``stopped`` and counted with that limit; the others go on.
"""

from __future__ import annotations

import json
import os
import signal
import statistics
import sys
import threading
import time

from tallycast.catalog import QUERIES
from tallycast.session import build_session

HEADLINE = (
    "monthly_panel",
    "dense_panel",
    "forward_label",
    "temporal_features",
    "temporal_features_rows",
    "impute_median",
    "cv_fold_bounds",
    "cv_rolling_origin",
    "cv_purged_group",
    "cv_summary",
    "category_stats",
    "target_encode",
    "target_encode_high_cardinality",
    "target_encode_oof",
    "tokenize",
    "term_stats",
    "tfidf_vocab",
    "tfidf",
    "feature_hash",
    "encode_all",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    limit = float(os.environ.get("BENCH_LIMIT", "90"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    stopped: list[str] = []

    def report(*_) -> None:
        line = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds}
        line["sf"] = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
        print(json.dumps(line | ({"stopped": stopped} if stopped else {})), flush=True)

    def ended(*_) -> None:
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            watch = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
            watch.start()
            try:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception:
                if time.perf_counter() - start < limit:
                    raise
                stopped.append(name)
                taken = [limit, limit]
                break
            finally:
                watch.cancel()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]} s (first run {taken[0]:.2f} s)", file=sys.stderr, flush=True)
    spark.stop()
    report()


if __name__ == "__main__":
    main()
