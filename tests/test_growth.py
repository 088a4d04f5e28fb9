"""Work that may not grow faster than the rows: counted training rows, bounded files and partitions, one shuffle of texts."""

import re
import threading

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from plumage.functions import text as T
from plumage.operators import models as M
from plumage.operators import sweep as S
from plumage.operators import trees
from plumage.operators.features import FEATURES
from plumage.plans import registry


@pytest.fixture(scope="module")
def repeated(spark):
    """4,000 rows with 24 vectors and three labels that no tree learns exactly."""
    rows = spark.range(4000).select(
        F.when(F.col("id") % 10 < 7, "train").otherwise("test").alias("split"),
        (F.col("id") % 6).cast("double").alias("a"), (F.col("id") * 7 % 4).cast("double").alias("b"),
        F.concat(F.lit("c"), (F.col("id") * F.col("id") % 11 % 3).cast("string")).alias("gender"))
    rows = StringIndexer(inputCol="gender", outputCol="gender_indexed").fit(rows).transform(rows)
    return VectorAssembler(inputCols=["a", "b"], outputCol=FEATURES).transform(rows).drop("a", "b")


def _nodes(model):
    return [tuple(r) for r in trees.node_table(model).orderBy("tree", "node").collect()]


@pytest.mark.parametrize("least", [1, 9, 400])
def test_fits_on_counted_rows_are_the_fits_on_the_rows(repeated, least):
    counts = M.counted(repeated)
    assert M.N_EQUAL in counts.columns and counts.count() < 200
    assert counts.agg(F.sum(M.N_EQUAL)).first()[0] == 4000
    for make, fixed in ((M.decision_tree, {}), (M.random_forest, {"bootstrap": False, "numTrees": 3})):
        estimator = make(params={"maxDepth": 8, "maxBins": 9, "minInstancesPerNode": least}, **fixed)
        assert _nodes(M.train(repeated, estimator, counts)) == _nodes(M.train(repeated, estimator))


def test_a_forest_draws_counted_rows_as_often_as_single_ones(repeated):
    model = M.train(repeated, M.random_forest(params={"maxDepth": 6}, numTrees=5), M.counted(repeated))
    nodes = trees.node_table(model)
    assert [tuple(r) for r in trees.node_checks(nodes).orderBy("tree").collect()] == [(t, 0, 0, 0) for t in range(5)]
    drawn = [r.n for r in nodes.where("node = 0").select(F.aggregate("counts", F.lit(0.0), lambda a, x: a + x).alias("n")).collect()]
    assert len(set(drawn)) == 5 and all(abs(n - 2800) < 5 * 2800 ** 0.5 for n in drawn)  # Poisson(2800)
    assert M.with_prediction(repeated, model, "m").where("pred_m is null").count() == 0


def test_rows_that_do_not_repeat_stay_rows(repeated, spark):
    single = VectorAssembler(inputCols=["x"], outputCol=FEATURES).transform(
        spark.range(500).select(F.lit("train").alias("split"), F.col("id").cast("double").alias("x"),
                                F.lit("c").alias("gender"), F.lit(0.0).alias("gender_indexed")))
    assert M.counted(single) is single


def test_training_partitions_are_bounded(repeated, monkeypatch):
    rows = repeated.coalesce(1)
    assert M.in_bounded_partitions(rows, 4000) is rows
    monkeypatch.setattr(M, "MAX_PARTITION_BYTES", 100_000)
    assert M.in_bounded_partitions(rows, 4000).rdd.getNumPartitions() == 6


def test_training_partitions_are_no_more_than_run_at_once(repeated, spark):
    at_once = spark.sparkContext.defaultParallelism
    assert M.in_bounded_partitions(repeated.repartition(5 * at_once), 4000).rdd.getNumPartitions() == at_once


@pytest.fixture(scope="module")
def single(spark):
    """900 rows with vectors of their own and three labels."""
    h = F.xxhash64("id")
    rows = spark.range(900).select(
        F.when(F.col("id") % 10 < 7, "train").otherwise("test").alias("split"), *[
            F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)).cast("double").alias(f"x{k}") for k in range(6)], h.alias("h"))
    label = F.when(F.col("x0") * 3 + F.col("x1") + F.pmod("h", F.lit(900)) > 2400, "a").when(F.col("x2") > 500, "b").otherwise("c")
    rows = rows.withColumn("gender", label)
    rows = StringIndexer(inputCol="gender", outputCol="gender_indexed").fit(rows).transform(rows)
    out = VectorAssembler(inputCols=[f"x{k}" for k in range(6)], outputCol=FEATURES).transform(rows)
    return out.select("split", "gender", "gender_indexed", FEATURES).cache()


def test_a_cut_forest_is_the_fit_with_that_depth(single):
    deep = M.train(single, M.random_forest(params={"maxDepth": 12, "maxBins": 8}, numTrees=4))
    for depth, cut in trees.cut_forest(deep, [0, 3, 7, 12]):
        fit = M.train(single, M.random_forest(params={"maxDepth": depth, "maxBins": 8}, numTrees=4))
        # the fit states no impurity for a leaf that it tried to split
        a, b = ([tuple(r) for r in trees.node_table(m).drop("impurity").orderBy("tree", "node").collect()] for m in (cut, fit))
        assert a == b
        both = M.with_prediction(M.with_prediction(single, cut, "cut"), fit, "fit")
        assert both.where("pred_cut <> pred_fit").count() == 0


def test_forest_sweep_fits_21_times_on_rows_dealt_once(single, monkeypatch):
    points = {S._point_id(r["params"]): S._full(r["params"]) for r in S.grid("forest")}
    served = S.families(points, "forest")
    fits = S.fits_of(served, "forest")
    assert len(fits) == 21 and sorted(fid for fids in fits for fid in fids) == sorted(points)
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, rows, *a: seen.append(rows) or fit(self, rows, *a))
    got = {r.value: r.accuracy for r in S.sweep(single, "forest", only=("maxDepth",), numTrees=3).collect()}
    assert len(seen) == 1 and len(got) == 11
    S.sweep(single, "forest", only=("minInfoGain",), numTrees=2).count()
    assert len(seen) == 4 and seen[1] is seen[2] is seen[3] and not seen[1].is_cached  # kept while the sweep ran
    test = single.where("split = 'test'")
    for depth in (10, 16):
        one = fit(M.random_forest(params={"maxDepth": depth}, numTrees=3), single.where("split = 'train'").select("gender_indexed", FEATURES))
        right = M.with_prediction(test, one, "one").agg(F.avg((F.col("pred_one") == F.col("gender_indexed")).cast("double"))).first()[0]
        assert got[float(depth)] == pytest.approx(right, abs=1e-6)


def test_two_fits_run_at_once_where_both_copies_fit(spark, monkeypatch):
    monkeypatch.setattr(S, "storage_memory_bytes", lambda _: 1000 * 4)
    at_once = {n: S.fit_parallelism(n, 1, 21, spark) for n in (100, 240, 260, 420, 430, 2000)}
    assert at_once == {100: 5, 240: 2, 260: 2, 420: 2, 430: 1, 2000: 1}
    assert S.fit_parallelism(420, 1, 21, spark, max_parallel=1) == S.fit_parallelism(420, 1, 1, spark) == 1


def test_forests_are_fitted_two_at_once_where_one_copy_takes_four_tenths(single, monkeypatch):
    n_train = single.where("split = 'train'").count()
    monkeypatch.setattr(S, "storage_memory_bytes", lambda _: int(n_train * 6 * 4 / 0.4))
    running, most, lock, fit = [], [], threading.Lock(), RandomForestClassifier.fit

    def counted_fit(self, rows, *a):
        with lock:
            running.append(self)
            most.append(len(running))
        try:
            return fit(self, rows, *a)
        finally:
            with lock:
                running.remove(self)

    monkeypatch.setattr(RandomForestClassifier, "fit", counted_fit)
    assert S.sweep(single, "forest", only=("minInfoGain",), numTrees=2).count() == 3
    assert max(most) == 2


def test_spaces_of_a_text_are_no_matches(spark):
    texts = ["a  b", " ", "", "a-b_c,\t\u00a0d\n", "\u00c9t\u00e9 \U0001f600!", "x\u2003\u200b\r\x0b\x00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern, before, unicode_words in ((T.NON_WORD, r"[\W]", False), (T.NON_WORD_UNICODE, r"(?U)[\W]", True)):
        got = rows.select(F.regexp_count("t", F.lit(pattern)).alias("n"), T.normalize_text("t", unicode_words).alias("t"),
                          F.lower(F.regexp_replace("t", before, " ")).alias("was")).collect()
        assert [r.n for r in got][:3] == [0, 0, 0]
        assert [r.t for r in got] == [r.was for r in got]


def _documents(spark, folder, files):
    texts = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit('a "b",\n'), F.col("id").cast("string")).alias("text"),
                                    F.lit("en").alias("lang"), F.lit(9).cast("long").alias("n_chars"))
    texts.repartition(files).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_csv_files_grow_in_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "FILE_RECORDS", 20, raising=False)
    df = registry.q_csv_by_name(spark, _documents(spark, tmp_path, 1))
    assert len(df.inputFiles()) >= 300 // 20
    assert sorted(r.doc_id for r in df.select("doc_id").collect()) == list(range(300))


def test_terms_meet_without_a_shuffle_of_their_own(spark, tmp_path):
    tf, _ = registry._idf(spark, _documents(spark, tmp_path, 64), materialize=False)
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?(, [a-z]\w*)?", plan) == [("doc_id", "")]
