from pyspark.sql import functions as F

from plumage.operators.sweep import _point_id, grid
from plumage.plans import jobs

from conftest import SF001


def test_train_evaluate_invariants(spark):
    ev = jobs.train_evaluate(spark, SF001)
    m = ev.metrics.collect()
    assert sorted((r.model, r.split) for r in m) == [
        ("decision_tree", "test"), ("decision_tree", "train"),
        ("random_forest", "test"), ("random_forest", "train")]
    for r in m:
        for c in ("accuracy", "weighted_precision", "weighted_recall", "f1"):
            assert 0.0 <= r[c] <= 1.0
        assert r.weighted_recall == r.accuracy
    mat = ev.matrix.collect()
    assert {r.predicted_gender for r in mat} <= set(ev.labels)
    # every cleaned row is counted once per model
    per_model = ev.matrix.groupBy("model").agg(F.sum("n").alias("n")).collect()
    n_rows = ev.confusion.where(F.col("model") == "decision_tree").agg(F.sum("n")).first()[0]
    assert {r.n for r in per_model} == {n_rows}


def test_split_is_layout_independent(spark):
    clean = jobs.cleaned_profiles(spark, SF001, "train")
    a = {r.doc_id: r.split for r in clean.select("doc_id", "split").collect()}
    b = {r.doc_id: r.split for r in clean.repartition(7).select("doc_id", "split").collect()}
    assert a == b


def test_sweep_grid_shape():
    for algo in ("tree", "forest"):
        g = grid(algo)
        assert len(g) == 32
        assert len({_point_id(r["params"]) for r in g}) == 31
    tree_bins = [r for r in grid("tree") if r["sweep"] == "minInstancesPerNode"]
    assert all(r["params"]["maxBins"] == 9 and r["params"]["maxDepth"] == 12 for r in tree_bins)


def test_profile_report_on_raw_csv(spark):
    from plumage.session import scratch_path
    from plumage.sources.tables import profiles

    cols = ["doc_id", "gender", "gender_gold", "gender:confidence", "description", "text",
            "tweet_count", "link_color", "sidebar_color"]
    path = scratch_path(spark, "raw-profiles")
    profiles(spark, SF001).select(*[F.col(f"`{c}`") for c in cols]) \
        .write.option("header", True).csv(path)
    schema = ", ".join(f"`{c}` {'bigint' if c == 'doc_id' else 'string'}" for c in cols)
    rep = jobs.profile_report(spark, path, schema, ["doc_id"], multi_line=True)
    m = rep.malformed.first()
    assert m.rows_read == 200 and m.rows_malformed == 0
    assert rep.stages.where(F.col("stage") == "read").first().n == 200
    assert rep.previews.select("step").distinct().count() == 4
    assert rep.describe.count() == 2


def test_fit_on_train_does_not_see_test_rows(spark):
    from plumage.operators.features import fit_and_featurize

    clean = jobs.cleaned_profiles(spark, SF001, "sweep")
    m_all, _ = fit_and_featurize(clean, fit_on="all", sink=lambda d: d)
    m_train, feats = fit_and_featurize(clean, fit_on="train", sink=lambda d: d)
    idf_all = m_all.stages[7].idf.toArray()
    idf_train = m_train.stages[7].idf.toArray()
    assert (idf_all != idf_train).any()
    assert feats.count() == clean.where(F.col("tweet_count").isNotNull()).count()


def test_one_pass_metrics_equal_ml_evaluator_on_model_predictions(spark):
    import pytest
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    fs = jobs.build_features(jobs.cleaned_profiles(spark, SF001, "train"))
    models = jobs.fit_models(fs)
    ours = {(r.model, r.split): r for r in jobs.evaluate(fs, models).metrics.collect()}
    for name, model in models.items():
        scored = model.transform(fs.features)
        for split in ("train", "test"):
            part = scored.where(F.col("split") == split)
            ev = MulticlassClassificationEvaluator(labelCol="gender_indexed", predictionCol="prediction")
            row = ours[(name, split)]
            for metric, col in [("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                                ("weightedRecall", "weighted_recall"), ("f1", "f1")]:
                assert row[col] == pytest.approx(ev.setMetricName(metric).evaluate(part), abs=1e-6)


def test_sweep_scoring_batches_by_model_size():
    from plumage.operators.sweep import model_batches

    class M:
        def __init__(self, n):
            self.numNodes = n

    models = {"a": M(40), "b": M(70), "c": M(10), "d": M(200), "e": M(5)}
    assert model_batches(models, 100) == [["a"], ["b", "c"], ["d"], ["e"]]
    assert model_batches(models, 10**9) == [["a", "b", "c", "d", "e"]]
