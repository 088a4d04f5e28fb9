from pyspark.sql import functions as F

from plumage.__main__ import _raw
from plumage.plans import jobs
from plumage.session import scratch_path
from plumage.sources.tables import profiles

from conftest import SF001

COLS = ["gender", "gender_gold", "gender:confidence", "description", "text", "tweet_count",
        "link_color", "sidebar_color"]


def test_raw_csv_runs_the_train_program(spark):
    path = scratch_path(spark, "cli-csv")
    profiles(spark, SF001).select(*[F.col(f"`{c}`") for c in COLS]) \
        .write.option("header", True).csv(path)
    scanned, good, key = _raw(spark, path, None, multi_line=True)
    assert good.count() == 200 and key == "doc_id"
    # the row-hash key is stable across reads
    again = _raw(spark, path, None, multi_line=True)[1]
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in again.collect())
    ev = jobs.train_evaluate_clean(jobs.usable(jobs.clean_raw(good, "train", key)))
    assert ev.metrics.count() == 4


def test_profile_program_prints_its_reports(spark, capsys):
    from plumage.__main__ import main

    path = scratch_path(spark, "cli-csv")
    profiles(spark, SF001).select(*[F.col(f"`{c}`") for c in COLS]) \
        .write.options(header=True, escape='"').csv(path)
    main(["profile", path, "--multi-line"])
    out = capsys.readouterr().out
    for part in ("rows_malformed", "dropmalformed", "filtered_sweep_form", "4_final", "dropped_null_label", "accuracy_pct"):
        assert part in out
