"""Tree and forest classifiers (Spark MLlib, distributed histogram training).

Training looks at rows through sums per vector and label only, so rows with
equal vectors, labels and splits can be counted in one aggregate and trained on
as one weighted row (:func:`counted`). The fitted tree is the same: weights are
whole numbers, and a limit on rows per node becomes one on weight. Rows whose
vectors hardly repeat are trained on as they are, in partitions of bounded size.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.operators.features import FEATURES
from plumage.session import cut_lineage

SEED = 46
# The reference's chosen hyper-parameters.
TREE_PARAMS = {"maxDepth": 12, "minInfoGain": 0.0, "maxBins": 9, "minInstancesPerNode": 9}
FOREST_PARAMS = {"maxDepth": 18, "minInfoGain": 0.0, "maxBins": 6, "minInstancesPerNode": 8}
# More nodes per pass than Spark's 256 MB allows on 2,003 features; the fitted model is the same.
SCALE_PARAMS = {"maxMemoryInMB": 1024}
# No walk from the root of every tree per level. One tree does not gain: its walk is
# a few steps beside 2,003 histogram updates a row.
FOREST_SCALE_PARAMS = SCALE_PARAMS | {"cacheNodeIds": True, "checkpointInterval": 10}


def decision_tree(label_col: str = "gender_indexed", params: dict | None = None,
                  **extra) -> DecisionTreeClassifier:
    p = SCALE_PARAMS | dict(TREE_PARAMS if params is None else params) | extra
    return DecisionTreeClassifier(labelCol=label_col, featuresCol=FEATURES, seed=SEED, **p)


def random_forest(label_col: str = "gender_indexed", params: dict | None = None,
                  **extra) -> RandomForestClassifier:
    """Forest with node-id caching, checkpointed every 10 iterations into the
    shared checkpoint folder."""
    p = FOREST_SCALE_PARAMS | dict(FOREST_PARAMS if params is None else params) | extra
    return RandomForestClassifier(labelCol=label_col, featuresCol=FEATURES, seed=SEED, **p)


N_EQUAL = "n_equal"
# Counting pays from this many equal rows per distinct one on; it costs one shuffle of the distinct ones.
MIN_EQUAL = 20
# What a training partition may take in the cache, as binned points.
MAX_PARTITION_BYTES = 768 * 2**20


def counted(features: DataFrame, label_col: str = "gender", index_col: str = "gender_indexed") -> DataFrame:
    """Equal rows (split, label, vector) as one with their number ``n_equal``, or ``features`` if few are equal."""
    if N_EQUAL in features.columns:
        return features
    keys = [c for c in dict.fromkeys(("split", label_col, index_col, FEATURES)) if c in features.columns]
    digest = F.xxhash64(*[F.unwrap_udt(c) if c == FEATURES else F.col(c) for c in keys])
    size = features.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(digest).alias("n_distinct")).first()
    if size["n"] < MIN_EQUAL * size["n_distinct"]:
        return features
    return cut_lineage(features.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(N_EQUAL)), "counted")


def in_bounded_partitions(rows: DataFrame, n_rows: int, n_trees: int = 1) -> DataFrame:
    """``rows`` in as many partitions as keep the binned points of each under ``MAX_PARTITION_BYTES``, and hardly more.

    A small file of well compressed vectors is one partition of many rows otherwise.
    Each partition shuffles its own sums for every node, and nodes grow with the
    rows: partitions that grow with them too would make the shuffle grow with the
    square. So there are no more than run at once, or whole rounds of those.
    """
    first = rows.select(FEATURES).first()
    if first is None:
        return rows
    # objects of a point and its bag, a bin per feature, a count per tree
    needed = -(-n_rows * (128 + 4 * len(first[0]) + 4 * n_trees) // MAX_PARTITION_BYTES)
    at_once = rows.sparkSession.sparkContext.defaultParallelism
    most = max(1, -(-needed // at_once)) * at_once
    found = rows.rdd.getNumPartitions()
    if found < needed:
        return rows.repartition(needed)
    return rows.repartition(most) if found > most else rows


def on_counts(estimator, total: float):
    """``estimator`` for rows of :func:`counted` that stand for ``total`` rows; None if it has no such form.

    A resampled forest has none (see :func:`resampled_forest`). So has one
    whose least node is half of the rows or more.
    """
    if isinstance(estimator, RandomForestClassifier) and (estimator.getBootstrap() or estimator.getSubsamplingRate() < 1):
        return None
    least = (estimator.getMinInstancesPerNode() - 0.5) / total if total else 1.0
    if least >= 0.5:
        return None
    out = estimator.copy().setWeightCol(N_EQUAL)
    return out.setMinInstancesPerNode(1).setMinWeightFractionPerNode(least)


def resampled_forest(rows: DataFrame, estimator: RandomForestClassifier):
    """Forest of ``estimator`` on :func:`counted` training rows; None if one tree has too few rows for :func:`on_counts`.

    The forest draws each row a Poisson(1) number of times for each tree, so n
    equal rows are drawn a Poisson(n) number of times together. Draws depend on
    the vector, the label and the seed, not on partitions. Each tree is one
    weighted fit.
    """
    n_trees, seed = estimator.getNumTrees(), estimator.getSeed()

    @F.pandas_udf("array<double>")
    def draws(key: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([np.random.default_rng([seed, k % 2**64]).poisson(lam, n_trees).astype(float)
                          for k, lam in zip(key.tolist(), n)])

    key = F.xxhash64(F.unwrap_udt(estimator.getFeaturesCol()), estimator.getLabelCol())
    drawn = cut_lineage(rows.withColumn("_draws", draws(key, N_EQUAL)), "draws")
    totals = drawn.agg(*[F.coalesce(F.sum(F.col("_draws")[t]), F.lit(0.0)) for t in range(n_trees)]).first()
    columns = estimator.getFeatureSubsetStrategy()
    one = estimator.copy().setNumTrees(1).setBootstrap(False)
    one.setFeatureSubsetStrategy("sqrt" if columns == "auto" else columns)  # "auto" means all for one tree
    each = [on_counts(one.copy().setSeed(seed + t), totals[t]) for t in range(n_trees)]
    if None in each:
        return None

    def fit(t: int):
        mine = drawn.withColumn(N_EQUAL, F.col("_draws")[t]).drop("_draws").where(F.col(N_EQUAL) > 0)
        return each[t].fit(mine)

    with ThreadPoolExecutor(max_workers=8) as pool:
        models = list(pool.map(fit, range(n_trees)))
    sc = rows.sparkSession.sparkContext
    spark_ml = sc._jvm.org.apache.spark.ml.classification
    trees = sc._gateway.new_array(spark_ml.DecisionTreeClassificationModel, n_trees)
    for t, model in enumerate(models):
        trees[t] = model._java_obj.trees()[0]
    joined = spark_ml.RandomForestClassificationModel(
        estimator.uid, trees, models[0].numFeatures, max(m.numClasses for m in models))
    return estimator._copyValues(RandomForestClassificationModel(joined))


def train(features: DataFrame, estimator, counts: DataFrame | None = None):
    """Fit on the rows of the train split, or on ``counts`` (``features`` :func:`counted`) where that gives the same."""
    forest = isinstance(estimator, RandomForestClassifier)
    if counts is not None and N_EQUAL in counts.columns:
        rows = counts.where(counts.split == "train")
        model = None
        if forest and estimator.getBootstrap():
            model = resampled_forest(rows, estimator) if estimator.getSubsamplingRate() == 1 else None
        else:
            weighted = on_counts(estimator, rows.agg(F.coalesce(F.sum(N_EQUAL), F.lit(0.0))).first()[0])
            model = weighted.fit(rows) if weighted is not None else None
        if model is not None:
            return model
    rows = features.where(features.split == "train")
    return estimator.fit(in_bounded_partitions(rows, rows.count(), estimator.getNumTrees() if forest else 1))


def with_prediction(features: DataFrame, model, name: str) -> DataFrame:
    """Add ``pred_<name>`` only (raw/probability columns are not produced)."""
    m = model.copy()
    m.setPredictionCol(f"pred_{name}")
    if hasattr(m, "setRawPredictionCol"):
        m.setRawPredictionCol("")
    if hasattr(m, "setProbabilityCol"):
        m.setProbabilityCol("")
    return m.transform(features)
