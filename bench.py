"""Benchmark: run the headline query keys and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_KEYS (comma list, default HEADLINE + both sweeps), BENCH_SWEEP=0 to
leave the two 31-fit sweeps out, BENCH_EVENT_LOG=1 to write Spark's event log
(stage and task timings) to a fresh temp folder named on stderr.
Each key is executed to completion with the ``noop`` sink (full compute, no
driver collect). One untimed warm-up run of the flagship on sf0.001 first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumage.plans.registry import QUERIES  # noqa: E402
from plumage.session import local_session  # noqa: E402

HEADLINE = [
    "train_evaluate", "feature_pipeline", "decision_tree", "random_forest", "compare_models",
    "csv_scan_dropmalformed", "malformed_report", "describe_csv_modes", "describe_profile",
    "stage_counts", "preview_steps",
    "filter_label_train", "hex_to_int", "normalize_text", "tokenize", "term_frequency",
    "idf", "tfidf", "hashing_tf", "standard_scale", "l2_normalize", "string_indexer",
    "hash_split", "confusion_matrix", "eval_metrics",
]
SWEEPS = ["sweep_decision_tree", "sweep_random_forest"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = os.environ.get("BENCH_KEYS")
    keys = keys.split(",") if keys else list(HEADLINE)
    if not os.environ.get("BENCH_KEYS") and os.environ.get("BENCH_SWEEP", "1") != "0":
        keys += SWEEPS
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG") == "1":  # stage/task timings without the UI
        import tempfile

        log_dir = tempfile.mkdtemp(prefix="plumage-eventlog-")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="plumage-bench", extra=extra)
    run(QUERIES["train_evaluate"](spark, "/root/testdata/sf0.001"))  # JVM / codegen warm-up

    times = {}
    for k in keys:
        t0 = time.perf_counter()
        run(QUERIES[k](spark, sf_dir))
        times[k] = round(time.perf_counter() - t0, 3)
        print(f"{k}: {times[k]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
