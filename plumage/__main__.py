"""Run the three programs on a raw profile CSV, like the reference's mains.

    python -m plumage train   <csv> [--key COL] [--fit-on all|train]
    python -m plumage profile <csv> [--key COL]
    python -m plumage sweep   <csv> [--key COL] [--algorithm tree|forest|both]

The CSV needs a header with at least the eight columns the programs use
(gender, gender_gold, gender:confidence, description, text, tweet_count,
link_color, sidebar_color). Every column is read as text (no inference pass)
and cast explicitly; malformed rows are quarantined. Without ``--key`` a row
key is derived from a hash of the whole record. Results are shown as tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plumage.operators.profile import describe_modes, preview_steps, stage_counts
from plumage.operators.sweep import sweep
from plumage.plans import jobs
from plumage.session import cut_lineage, ensure_checkpoint_dir
from plumage.sources.csv import CORRUPT, good_rows, malformed_reasons, malformed_report, scan_with_quarantine


def _raw(spark: SparkSession, path: str, key: str | None, multi_line: bool):
    header = spark.read.option("header", True).option("multiLine", multi_line).csv(path).columns
    schema = ", ".join(f"`{c}` string" for c in header)
    scanned = scan_with_quarantine(spark, path, schema, multi_line=multi_line)
    good = good_rows(scanned)
    if key is None:
        good = good.withColumn("doc_id", F.xxhash64(*[F.col(f"`{c}`") for c in header]))
        key = "doc_id"
    return scanned, good, key


def _show(report, truncate: int | bool = False) -> None:
    """Every row of a report (reports have a few rows per class, column or step); it is worked out once."""
    report = cut_lineage(report, "report")
    report.show(max(1, report.count()), truncate)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="plumage")
    ap.add_argument("program", choices=["train", "profile", "sweep"])
    ap.add_argument("csv")
    ap.add_argument("--key", default=None, help="unique row id column (default: a row hash)")
    ap.add_argument("--fit-on", default="all", choices=["all", "train"])
    ap.add_argument("--algorithm", default="both", choices=["tree", "forest", "both"])
    ap.add_argument("--multi-line", action="store_true", help="quoted cells may hold newlines")
    args = ap.parse_args(argv)

    spark = (SparkSession.builder.appName(f"plumage-{args.program}")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    scanned, good, key = _raw(spark, args.csv, args.key, args.multi_line)

    if args.program == "profile":
        keyed = good if key == "doc_id" else good.withColumnRenamed(key, "doc_id")
        _show(malformed_report(scanned))
        columns = [c for c in scanned.columns if c not in (CORRUPT, "is_malformed")]
        _show(malformed_reasons(scanned, ", ".join(f"`{c}` string" for c in columns)))
        _show(describe_modes(scanned, [c for c in good.columns if c != key]), 40)
        _show(stage_counts(keyed))
        _show(preview_steps(keyed), 20)

    form = "sweep" if args.program == "sweep" else "train"
    if args.program != "sweep":
        clean, seen = jobs.observed_profiles(good, form, key)
        ev = jobs.train_evaluate_clean(clean, args.fit_on)
        _show(jobs.observed_counts(spark, seen))  # counted on the way, without a pass of their own
        _show(ev.metrics)
        _show(ev.matrix)
        return
    cleaned = jobs.clean_raw(good, form, key)
    _show(jobs.dropped(cleaned).groupBy("reason", "split").count())
    fs = jobs.build_features(jobs.usable(cleaned), fit_on=args.fit_on)
    for algo in (["tree", "forest"] if args.algorithm == "both" else [args.algorithm]):
        _show(sweep(fs.features, algo).orderBy("sweep", "value"))


if __name__ == "__main__":
    main()
