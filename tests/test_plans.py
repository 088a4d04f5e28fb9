"""Plan-shape checks: the properties that matter at scale, asserted on plans."""

import pytest

import __spark_entry__ as E
from plumage.operators import features
from plumage.plans import registry
from plumage.plans.oracle import ORACLE
from plumage.sources import csv as csvsrc
from plumage.sources.tables import load_table

from conftest import SF001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                "MapInPandas")


def _plan(df) -> str:
    """Before execution: what Spark plans without measured sizes."""
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df._jdf.queryExecution().toRdd().count()  # runs this very plan: AQE's final form
    plan = _plan(df)
    assert "isFinalPlan=false" not in plan
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_no_python_in_query_plans(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    assert not any(n in plan for n in PYTHON_NODES), key


def test_profiles_scan_reads_only_needed_columns(spark):
    def read_schema(df):
        return [line.split("ReadSchema: ")[1] for line in _plan(df).splitlines() if "ReadSchema" in line]

    # colours derive from md5(doc_id) only: the text column is never read
    assert read_schema(registry.q_hex_to_int(spark, SF001)) == ["struct<doc_id:bigint>"]
    assert read_schema(registry.q_stage_counts(spark, SF001)) == [
        "struct<doc_id:bigint,text:string,lang:string,n_chars:bigint>"]


def test_good_rows_read_prunes_the_bad_partition(spark):
    scanned = registry._quarantined(spark, SF001)
    plan = _plan(csvsrc.good_rows(scanned))
    assert "PartitionFilters: [isnotnull(is_malformed" in plan


def test_fit_reads_only_the_train_files(spark):
    from plumage.plans import rules

    fs = rules.rule_features(spark, SF001, rules.TREE_COLUMNS, rules.TREE_RULE)
    assert "PartitionFilters: [isnotnull(split" in _plan(fs.features.where("split = 'train'"))


def test_preview_takes_the_rows_before_cleaning_them(spark):
    lines = _plan(registry.q_preview_top10(spark, SF001)).splitlines()
    assert any("TakeOrderedAndProject" in line for line in lines)  # projects what it has taken
    assert not any("regexp_replace" in line for line in lines if "TakeOrderedAndProject" not in line)


def test_term_frequency_needs_at_most_one_shuffle(spark):
    docs = load_table(spark, SF001, "documents").select("doc_id", "text")
    plan = _final_plan(features.term_frequency(docs))
    assert plan.count("Exchange hashpartitioning") <= 1


def test_evaluation_is_one_pass_over_scored_rows(spark):
    from plumage.operators.evaluate import joint_confusion

    df = spark.createDataFrame([(0.0, 0.0, 1.0, "a", "test")] * 10,
                               "gender_indexed double, pred_a double, pred_b double, gender string, split string")
    plan = _plan(joint_confusion(df, ["a", "b"], by=("split",)))
    assert plan.count("Scan") <= 1 and "Generate stack" in plan


def test_spread_only_repartitions_narrow_small_scans(spark):
    from plumage.session import spread

    docs = load_table(spark, SF001, "documents").select("doc_id", "text")
    assert docs.rdd.getNumPartitions() == 1
    assert spread(docs, "doc_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    agg = docs.groupBy("doc_id").count()
    assert spread(agg, "doc_id") is agg          # already shuffled: left alone, nothing executed
