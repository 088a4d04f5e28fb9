import math

import pytest
from pyspark.ml.feature import IDF, HashingTF, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from plumage.operators import features
from plumage.plans import jobs
from plumage.sources.tables import load_table

from conftest import SF001, SF01


def test_idf_formula(spark):
    # N = 2 documents; bucket 0 in both, bucket 1 in one, bucket 2 in none
    df = spark.createDataFrame([(Vectors.dense([1.0, 1.0, 0.0]),), (Vectors.dense([1.0, 0.0, 0.0]),)], ["v"])
    idf = IDF(inputCol="v", outputCol="w").fit(df).idf.toArray()
    assert [round(x, 6) for x in idf] == [0.0, 0.405465, 1.098612]


def test_idf_twin_formula(spark):
    tf = spark.createDataFrame([(1, "a", 1), (2, "a", 3), (1, "b", 2)], "doc_id long, term string, tf long")
    n = spark.createDataFrame([(2,)], "n_docs long")
    got = {r.term: round(r.idf, 6) for r in features.inverse_document_frequency(tf, n).collect()}
    assert got == {"a": 0.0, "b": 0.405465}


def test_label_index_ties_alphabetical(spark):
    df = spark.createDataFrame([(x,) for x in ["female", "female", "male", "male", "brand"]], "g string")
    assert StringIndexer(inputCol="g", outputCol="i").fit(df).labels == ["female", "male", "brand"]
    twin = {r.g: r.label_index for r in features.label_index_twin(df, "g").collect()}
    assert twin == {"female": 0.0, "male": 1.0, "brand": 2.0}


def test_std_scale_and_l2_twins_equal_ml(spark):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = load_table(spark, SF001, "lineitem").select("l_orderkey", "l_linenumber", *cols) \
        .withColumn("rid", F.monotonically_increasing_id())
    v = VectorAssembler(inputCols=cols, outputCol="v").transform(li)
    ml = StandardScaler(inputCol="v", outputCol="s").fit(v).transform(v)
    ml = ml.select("rid", vector_to_array("s").alias("a"))
    twin = features.l2_normalize_twin(features.std_scale_twin(li, cols), cols)
    scaled = {r.rid: r.a for r in ml.collect()}
    for r in twin.collect():
        a = scaled[r.rid]
        norm = math.sqrt(sum(x * x for x in a))
        for i, c in enumerate(cols):
            assert r[c] == pytest.approx(a[i] / norm, abs=1e-9)


def test_hashed_tf_sums_to_token_count(spark):
    docs = load_table(spark, SF001, "documents").select("doc_id", "text")
    toks = docs.select("doc_id", features.token_array("text").alias("w"))
    tf = HashingTF(numFeatures=1000, inputCol="w", outputCol="h").transform(toks)
    s = tf.select(F.size("w").alias("n"),
                  F.aggregate(vector_to_array("h"), F.lit(0.0), lambda a, x: a + x).alias("t"))
    assert s.where(F.col("n") != F.col("t")).count() == 0


def test_vector_entries_of_sparse_and_dense_vectors(spark):
    df = spark.createDataFrame([(1, Vectors.sparse(5, [1, 4], [2.0, 0.0])), (2, Vectors.dense([0.0, 3.0])),
                                (3, Vectors.sparse(4, [], []))], ["id", "v"])
    got = {(r.id, r.pos, r.value) for r in features.explode_vector(df, "v", ["id"]).collect()}
    assert got == {(1, 1, 2.0), (2, 1, 3.0)}
    assert [r.width for r in features.vector_summary(df, "v").orderBy("id").collect()] == [5, 2, 4]


def test_tfidf_names_no_join_strategy(spark):
    tf = spark.createDataFrame([(1, "a", 1), (2, "a", 3), (1, "b", 2)], "doc_id long, term string, tf long")
    idf = features.inverse_document_frequency(tf, spark.createDataFrame([(2,)], "n_docs long"))
    out = features.tfidf(tf, idf)
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()
    assert {(r.doc_id, r.term): round(r.tfidf, 6) for r in out.collect()} == {
        (1, "a"): 0.0, (2, "a"): 0.0, (1, "b"): 0.81093}


def test_invalid_rows_are_an_error_unless_left_out(spark):
    clean = jobs.clean_raw(jobs.profiles(spark, SF01), "train")
    with pytest.raises(Exception, match="NULL value"):
        jobs.build_features(clean)
    n, out = clean.count(), jobs.dropped(clean)
    assert {r.reason for r in out.select("reason").distinct().collect()} <= {"null_label", "null_count"}
    assert out.count() + jobs.usable(clean).count() == n
    only = jobs.usable(clean, ("male", "female", "brand"))
    assert {r.gender for r in only.select("gender").distinct().collect()} <= {"male", "female", "brand"}


def test_feature_pipeline_width_and_norm(spark):
    fs = jobs.build_features(jobs.cleaned_profiles(spark, SF01, "sweep"), checkpoint=False)
    s = features.vector_summary(fs.features)
    stats = s.agg(F.min("width"), F.max("width"), F.min("l2_norm"), F.max("l2_norm"), F.count("*")).first()
    assert stats[0] == stats[1] == 2003
    assert stats[2] == pytest.approx(1.0) and stats[3] == pytest.approx(1.0)
    assert stats[4] == 443
    assert set(fs.labels) <= {"male", "female", "brand"}


def test_feature_pipeline_twophase_equals_single_pipeline(spark):
    clean = jobs.cleaned_profiles(spark, SF001, "sweep")
    two = features.featurize(clean, features.fit_features(clean))
    one = features.feature_pipeline().fit(clean).transform(clean).select("doc_id", features.FEATURES)
    landed = jobs.build_features(clean).features  # phase-one reuse + Parquet lineage cut
    a = {r.doc_id: r[features.FEATURES].toArray().tolist() for r in two.collect()}
    b = {r.doc_id: r[features.FEATURES].toArray().tolist() for r in one.collect()}
    c = {r.doc_id: r[features.FEATURES].toArray().tolist() for r in landed.collect()}
    assert a.keys() == b.keys() == c.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)
        assert c[k] == pytest.approx(b[k], abs=1e-12)


def test_features_do_not_depend_on_layout(spark):
    clean = jobs.cleaned_profiles(spark, SF001, "sweep")
    a = jobs.build_features(clean).features
    b = jobs.build_features(clean.repartition(7)).features
    va = {r.doc_id: r[features.FEATURES].toArray() for r in a.collect()}
    vb = {r.doc_id: r[features.FEATURES].toArray() for r in b.collect()}
    assert va.keys() == vb.keys()
    for k in va:
        assert va[k] == pytest.approx(vb[k], abs=1e-9)
