import pytest
from pyspark.sql import functions as F

from plumage.functions.hex import hex_to_int
from plumage.functions.named import FUNCTIONS, register_functions
from plumage.functions.text import normalize_text
from plumage.operators import features, profile
from plumage.operators.evaluate import label_name, positioned
from plumage.plans import jobs
from plumage.session import cut_lineage
from plumage.sources.tables import profiles

from conftest import SF001


def test_a_million_labels_go_there_and_back(spark):
    n = 1_000_000
    rows = spark.range(n + n // 2).select("id", F.format_string("label %07d", F.col("id") % n).alias("label"))
    table = cut_lineage(features.label_index_twin(rows, "label"), "labels")
    indexed = features.index_labels(rows, "label", table)
    back = features.name_labels(indexed, "label_index", table, "label", "again")
    # the first half million labels occur twice: they come first, in the order of their names
    want = (F.col("id") % n).cast("double")
    found = back.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") != F.col("again")).alias("lost"),
                     F.count_if(F.col("label_index") != want).alias("wrong")).first()
    assert tuple(found) == (n + n // 2, 0, 0)


def test_unknown_and_null_labels_have_no_index(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",), ("a",)], "label string")
    table = cut_lineage(features.label_index_twin(rows.where("label <> 'b' or label is null"), "label"), "labels")
    got = features.name_labels(features.index_labels(rows, "label", table), "label_index", table, "label", "again").collect()
    assert sorted(((r.label, r.label_index, r.again) for r in got), key=repr) == sorted(
        [("a", 0.0, "a"), ("a", 0.0, "a"), ("b", None, None), (None, None, None)], key=repr)


def test_label_name_is_a_place_in_one_array(spark):
    labels = [f"l{i}" for i in range(500)]
    rows = spark.createDataFrame([(0.0,), (499.0,), (500.0,), (None,)], "i double").select(label_name(labels, "i").alias("n"))
    assert [r.n for r in rows.collect()] == ["l0", "l499", None, None]
    assert "CASE" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_positions_of_a_matrix(spark):
    rows = spark.createDataFrame([("b", "x", 1), ("a", "z", 2), ("a", "y", 3)], "g string, p string, n long")
    assert [r.n for r in sorted(positioned(rows, "g", "p").collect(), key=lambda r: r.position)] == [3, 2, 1]


HEX = ["9.99E+08", "", None, "-1a2B", "+00ff", "FFFFFFFF", "7fffffff", "-80000000", "zz", " 1", "1\n", "0"]


def test_named_functions_are_the_native_expressions(spark):
    register_functions(spark)
    rows = spark.createDataFrame([(x, f"a_b-{x}\té") for x in HEX], "h string, t string")
    got = rows.selectExpr("toInteger(h) as h", "cleanText(t) as t")
    want = rows.select(hex_to_int("h").alias("h"), normalize_text("t").alias("t"))
    assert got.collect() == want.collect()
    assert rows.select(F.call_function("toInteger", "h").alias("h")).collect() == want.select("h").collect()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "udf" not in plan.lower() and not any(name in plan for name in FUNCTIONS)


@pytest.mark.parametrize("form", ["train", "sweep"])
def test_counts_seen_on_the_way_are_those_of_the_report(spark, form):
    raw = profiles(spark, SF001)
    clean, seen = jobs.observed_profiles(raw, form)
    plain = jobs.usable(jobs.clean_raw(raw, form))
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted(map(tuple, plain.select(clean.columns).collect()), key=repr)
    want = {r.stage: r.n for r in profile.stage_counts(raw).collect()}
    assert {r.stage: r.n for r in jobs.observed_counts(spark, seen).collect()} == want


def test_both_modes_are_described_in_one_scan(spark):
    rows = spark.createDataFrame([(False, 1.0, "2"), (True, 5.0, "x"), (False, 4.0, None), (True, None, "10")],
                                 "is_malformed boolean, a double, b string")
    landed = cut_lineage(rows, "modes")
    got = profile.describe_modes(landed, ["a", "b"])
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    found = {(r.mode, r.column_name): tuple(r)[2:] for r in got.collect()}
    assert found[("permissive", "a")] == (3, 3.333333, 2.081666, 1.0, 5.0, None, None)
    assert found[("dropmalformed", "a")] == (2, 2.5, 2.12132, 1.0, 4.0, None, None)
    assert found[("permissive", "b")] == (3, 6.0, 5.656854, None, None, "10", "x")
    assert found[("dropmalformed", "b")] == (1, 2.0, None, None, None, "2", "2")


def test_modes_without_malformed_rows_and_large_means(spark):
    rows = cut_lineage(spark.range(1000).select(F.lit(False).alias("is_malformed"), (F.col("id") + 10**12).alias("a")), "modes")
    got = {r.mode: (r.n, r["mean"], r.stddev) for r in profile.describe_modes(rows, ["a"]).collect()}
    assert got["permissive"] == got["dropmalformed"] and got["permissive"][2] == pytest.approx(288.819436, abs=1e-3)
