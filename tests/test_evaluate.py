import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from plumage.operators.evaluate import confusion_matrix, joint_confusion, metrics


def _frame(spark, pairs):
    return spark.createDataFrame(
        [(["a", "b", "c"][int(l)], float(l), float(p), "test") for l, p in pairs],
        "gender string, gender_indexed double, pred_m double, split string")


def test_metrics_fixture_rows(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (0, 0)]
    conf = joint_confusion(_frame(spark, pairs), ["m"], by=("split",))
    m = metrics(conf, label="gender_indexed", by=("model", "split")).first()
    assert (m.accuracy, m.weighted_precision, m.weighted_recall, m.f1) == (
        0.666667, 0.888889, 0.666667, 0.705556)
    assert m.accuracy_pct == 67


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_equal_ml_evaluator(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(3), rnd.randrange(3)) for _ in range(300)]
    df = _frame(spark, pairs)
    conf = joint_confusion(df, ["m"], by=("split",))
    m = metrics(conf, label="gender_indexed", by=("model", "split")).first()
    ev = MulticlassClassificationEvaluator(labelCol="gender_indexed", predictionCol="pred_m")
    for name, col in [("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                      ("weightedRecall", "weighted_recall"), ("f1", "f1")]:
        assert m[col] == pytest.approx(ev.setMetricName(name).evaluate(df), abs=1e-6)


def test_never_predicted_class_scores_zero(spark):
    pairs = [(0, 1), (1, 1), (2, 1)]  # every prediction is class 1
    conf = joint_confusion(_frame(spark, pairs), ["m"], by=("split",))
    m = metrics(conf, label="gender_indexed", by=("model", "split")).first()
    ev = MulticlassClassificationEvaluator(labelCol="gender_indexed", predictionCol="pred_m")
    df = _frame(spark, pairs)
    assert m.weighted_precision == pytest.approx(ev.setMetricName("weightedPrecision").evaluate(df), abs=1e-6)
    assert m.f1 == pytest.approx(ev.setMetricName("f1").evaluate(df), abs=1e-6)


def test_confusion_matrix_labels_and_order(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (0, 0)]
    conf = joint_confusion(_frame(spark, pairs), ["m"], by=("split",))
    rows = [tuple(r) for r in confusion_matrix(conf, ["a", "b", "c"]).collect()]
    assert rows == [("m", "test", "a", "a", 2), ("m", "test", "a", "b", 1), ("m", "test", "b", "b", 1),
                    ("m", "test", "c", "b", 1), ("m", "test", "c", "c", 1)]
