from pyspark.sql import functions as F

from plumage.operators.clean import prepare, select_profile, trust_filter, trust_predicate
from plumage.sources.tables import profiles

from conftest import SF01


def test_profiles_fixture_counts(spark):
    p = select_profile(profiles(spark, SF01))
    assert p.count() == 1000
    assert trust_filter(p, "train").count() == 551
    assert trust_filter(p, "sweep").count() == 459


def test_train_and_sweep_forms_differ_as_documented(spark):
    rows = [
        # gender, gold, confidence, description, text -> (train keeps, sweep keeps)
        (None, "male", 1.0, "d", "t", True, False),
        ("unknown", "female", None, "d", "t", True, False),
        ("male", None, 1.0, "d", None, True, False),
        ("male", "brand", 0.5, "d", "t", True, True),
        ("male", None, 0.5, "d", "t", False, False),
        ("brand", None, 1.0, None, "t", False, False),
    ]
    df = spark.createDataFrame(
        [r[:5] for r in rows],
        "gender string, gender_gold string, gender_confidence double, description string, text string")
    got = df.select(F.coalesce(trust_predicate("train"), F.lit(False)).alias("a"),
                    F.coalesce(trust_predicate("sweep"), F.lit(False)).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(r[5], r[6]) for r in rows]


def test_prepare_output_schema(spark):
    out = prepare(profiles(spark, SF01), "sweep")
    assert out.columns == ["doc_id", "gender", "description", "link_color_indexed",
                           "sidebar_color_indexed", "text", "tweet_count"]
    assert dict(out.dtypes)["link_color_indexed"] == "int"
    assert out.where(F.col("text").rlike(r"[A-Z]")).count() == 0
