"""Learned keys with known answers: the model jobs on labels made by a rule.

A tree's result on profiles has no SQL form. On ``lineitem`` rows whose label
follows a rule that the model must learn exactly, DuckDB states every row's
prediction, every matrix cell, metric and sweep row. The jobs are those of the
profile keys; only the feature table differs.

The tree and the forest learn a rule of several levels over columns with at
most as many values as the model has bins, so depth, bins and minimum
instances matter. Sweeps and comparisons are in :mod:`plumage.plans.staircase`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumage.functions.split import split_label, split_label_sql
from plumage.operators.evaluate import label_name
from plumage.operators.features import FEATURES
from plumage.operators.models import decision_tree, random_forest, train, with_prediction
from plumage.plans import jobs
from plumage.session import cut_lineage
from plumage.sources.tables import load_table

KEYS = ["l_orderkey", "l_linenumber"]
# Columns as SQL that Spark and DuckDB read alike; the number of values is in the name.
LINE7, LINE4 = "l_linenumber", "floor((l_linenumber - 1) / 2.0)"
QUANTITY5, TAX9 = "floor((l_quantity - 1) / 10.0)", "round(l_tax * 100)"
DISCOUNT6 = "floor(round(l_discount * 100) / 2.0)"

TREE_COLUMNS = [LINE7, QUANTITY5, TAX9]
TREE_RULE = (f"case when {LINE7} <= 3 then case when {TAX9} <= 4 then 'male' else 'female' end"
             f" when {QUANTITY5} <= 1 then 'female' else 'brand' end")
FOREST_COLUMNS = [LINE4, QUANTITY5, DISCOUNT6]
FOREST_RULE = (f"case when {LINE4} <= 1 then case when {DISCOUNT6} <= 2 then 'male' else 'female' end"
               f" when {QUANTITY5} <= 1 then 'female' else 'brand' end")


def rule_features(spark: SparkSession, sf_dir: str, columns: list[str], rule: str) -> jobs.FeatureSet:
    """All of ``lineitem`` as a feature table in the form of ``jobs.build_features``."""
    rows = load_table(spark, sf_dir, "lineitem").select(
        *KEYS, split_label("l_orderkey").alias("split"), F.expr(rule).alias("gender"),
        *[F.expr(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    indexer = StringIndexer(inputCol="gender", outputCol="gender_indexed").fit(rows)
    inputs = [f"x{i}" for i in range(len(columns))]
    vectors = VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(indexer.transform(rows))
    landed = cut_lineage(vectors.drop(*inputs), "rule-features", partition_by="split")
    return jobs.FeatureSet(landed, list(indexer.labels), indexer)


def _predictions(fs: jobs.FeatureSet, estimator) -> DataFrame:
    scored = with_prediction(fs.features, train(fs.features, estimator, fs.counted), "rule")
    return scored.select(*KEYS, "split", "gender", label_name(fs.labels, "pred_rule").alias("predicted_gender"))


def q_decision_tree_rule(spark, sf_dir):
    return _predictions(rule_features(spark, sf_dir, TREE_COLUMNS, TREE_RULE), decision_tree())


def q_random_forest_rule(spark, sf_dir):
    return _predictions(rule_features(spark, sf_dir, FOREST_COLUMNS, FOREST_RULE), random_forest())


def q_train_evaluate_rows(spark, sf_dir):
    """Row sums of the profile matrix: what does not depend on the models."""
    matrix = jobs.train_evaluate(spark, sf_dir).matrix
    return matrix.groupBy("model", "split", "gender").agg(F.sum("n").cast("long").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decision_tree_rule": q_decision_tree_rule,
    "random_forest_rule": q_random_forest_rule,
    "train_evaluate_rows": q_train_evaluate_rows,
}

SPLIT = split_label_sql("l_orderkey")


def _exact(rule: str) -> str:
    return (f"select l_orderkey, l_linenumber, {SPLIT} as split, {rule} as gender, {rule} as predicted_gender"
            " from lineitem")


ORACLE: dict[str, str] = {
    "decision_tree_rule": _exact(TREE_RULE),
    "random_forest_rule": _exact(FOREST_RULE),
}
