"""The reference's three programs as composable Spark jobs.

* ``train_evaluate`` (train program): clean -> features -> tree + forest ->
  metrics and confusion matrices for train and test.
* ``profile_report`` pieces (profile program): CSV quarantine, describe,
  stage counts, previews (see ``plumage.operators.profile`` and
  ``plumage.sources.csv``).
* ``sweep`` (sweep program): ``plumage.operators.sweep`` over the same
  features, with the sweep-form filter.

Plan shape at scale: cleaning is narrow (no shuffle); the feature table is
fitted with three bounded tree-aggregates (label counts, two IDF vectors of
1,000 entries, one 2,003-wide summary), then written once to the shared
checkpoint folder so tree training (one pass per level) and scoring never
replay the text work, and a lost executor re-reads it instead of recomputing.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumage.functions.split import split_label
from plumage.operators.clean import clean_text, convert_colours, drop_reason, final_projection, prepare
from plumage.operators.evaluate import confusion_matrix, joint_confusion, metrics
from plumage.operators.features import fit_and_featurize, featurize, fit_features, label_list
from plumage.operators.models import counted, decision_tree, random_forest, train, with_prediction
from plumage.operators.profile import STAGES, stage_aggregates, stage_flags
from plumage.session import cut_lineage, spread
from plumage.sources.tables import profiles


def clean_raw(raw: DataFrame, form: str = "train", key: str = "doc_id",
              train_fraction: float = 0.7, seed: int = 46) -> DataFrame:
    """Cleaned rows of raw profile records with a deterministic ``split``.

    A NULL text (possible under the train-form filter) becomes '' so the
    tokenizer does not abort the job. The result is keyed by ``doc_id``.
    """
    if key != "doc_id":
        raw = raw.withColumnRenamed(key, "doc_id")
    clean = prepare(raw, form)
    clean = clean.withColumns({
        "text": F.coalesce(F.col("text"), F.lit("")),
        "split": split_label("doc_id", train_fraction, seed),
    })
    return spread(clean, "doc_id")


def cleaned_profiles(spark: SparkSession, sf_dir: str, form: str = "train",
                     train_fraction: float = 0.7, seed: int = 46) -> DataFrame:
    """:func:`usable` rows of :func:`clean_raw` over the ``profiles`` view of the driver tables."""
    return usable(clean_raw(profiles(spark, sf_dir), form, "doc_id", train_fraction, seed))


def observed_profiles(raw: DataFrame, form: str = "train", key: str = "doc_id",
                      train_fraction: float = 0.7, seed: int = 46) -> tuple[DataFrame, Observation]:
    """:func:`usable` rows of :func:`clean_raw`, and an observation that the first job over them fills
    with the counts of ``profile.stage_counts``: no pass of its own is needed for them."""
    if key != "doc_id":
        raw = raw.withColumnRenamed(key, "doc_id")
    seen = Observation("stages")
    flagged = stage_flags(raw, "doc_id", train_fraction, seed).observe(seen, *stage_aggregates())
    kept = flagged.where(F.col("_kept" if form == "train" else "_kept_sweep"))
    clean = final_projection(clean_text(convert_colours(kept)))
    clean = clean.withColumns({"text": F.coalesce(F.col("text"), F.lit("")),
                               "split": split_label("doc_id", train_fraction, seed)})
    return usable(spread(clean, "doc_id")), seen


def observed_counts(spark: SparkSession, seen: Observation) -> DataFrame:
    """(stage, n) of a filled observation; waits for the first job over the observed rows."""
    found = seen.get
    return spark.createDataFrame([(stage, found[stage]) for stage in STAGES], "stage string, n long")


def usable(clean: DataFrame, allowed_labels: tuple[str, ...] | None = None) -> DataFrame:
    """Rows the pipeline can take; :func:`dropped` lists the others."""
    return clean.where(drop_reason(allowed_labels).isNull())


def dropped(clean: DataFrame, allowed_labels: tuple[str, ...] | None = None) -> DataFrame:
    """(doc_id, split, reason) of every filtered row that :func:`usable` leaves out."""
    return clean.select("doc_id", "split", drop_reason(allowed_labels).alias("reason")).where("reason is not null")


@dataclass
class FeatureSet:
    features: DataFrame  # doc_id, split, gender, gender_indexed, normalizedFeatures
    labels: list[str]
    model: object

    @cached_property
    def counted(self) -> DataFrame:
        """The features with equal rows counted, for fits and matrices."""
        return counted(self.features)


def build_features(clean: DataFrame, fit_on: str = "all", checkpoint: bool = True) -> FeatureSet:
    """Fit the pipeline and featurize; with ``checkpoint`` the feature table is
    written to the shared folder (training and scoring then read Parquet)."""
    if checkpoint:
        model, feats = fit_and_featurize(clean, fit_on=fit_on,
                                         sink=lambda d: cut_lineage(d, "features", partition_by="split"))
    else:
        model = fit_features(clean, fit_on=fit_on)
        feats = featurize(clean, model)
    return FeatureSet(feats, label_list(model), model)


def fit_models(fs: FeatureSet, parallel: bool = True) -> dict:
    """Tree and forest with the reference's parameters, fitted side by side."""
    estimators = {"decision_tree": decision_tree(), "random_forest": random_forest()}
    rows = fs.counted
    with ThreadPoolExecutor(max_workers=2 if parallel else 1) as pool:
        futures = {k: pool.submit(train, fs.features, e, rows) for k, e in estimators.items()}
        return {k: f.result() for k, f in futures.items()}


def score(fs: FeatureSet, models: dict) -> DataFrame:
    """The feature rows, counted where many are equal, with each model's prediction."""
    scored = fs.counted
    for name, m in models.items():
        scored = with_prediction(scored, m, name)
    return scored


@dataclass
class Evaluation:
    confusion: DataFrame  # model, split, gender, gender_indexed, prediction, n
    metrics: DataFrame    # model, split, accuracy, weighted_precision, weighted_recall, f1 (+ _pct)
    matrix: DataFrame     # model, split, gender, predicted_gender, n
    labels: list[str]


def evaluate(fs: FeatureSet, models: dict) -> Evaluation:
    # Cached: at most models x splits x classes^2 rows, and both reports read it,
    # so scoring runs once however many reports are used.
    conf = joint_confusion(score(fs, models), list(models), by=("split",)).cache()
    return Evaluation(conf, metrics(conf, label="gender_indexed", by=("model", "split")),
                      confusion_matrix(conf, fs.labels), fs.labels)


def train_evaluate(spark: SparkSession, sf_dir: str, form: str = "train",
                   fit_on: str = "all") -> Evaluation:
    """The train program end to end on the driver tables."""
    return train_evaluate_clean(cleaned_profiles(spark, sf_dir, form), fit_on)


def train_evaluate_clean(clean: DataFrame, fit_on: str = "all") -> Evaluation:
    fs = build_features(clean, fit_on=fit_on)
    return evaluate(fs, fit_models(fs))


@dataclass
class ProfileReport:
    malformed: DataFrame       # rows read / good / malformed
    describe: DataFrame        # describe of the columns (default: all), permissive vs good rows, in one scan
    stages: DataFrame          # row counts per stage
    previews: DataFrame        # first rows after each cleaning step


def profile_report(spark: SparkSession, csv_path: str, schema, columns: list[str] | None = None,
                   key: str = "doc_id", form: str = "train", header: bool = True,
                   multi_line: bool = False) -> ProfileReport:
    """The profile program on a raw CSV of profile records.

    One PERMISSIVE parse landed as Parquet (see ``scan_with_quarantine``);
    every report below reads the landed table, never the CSV again.
    """
    from plumage.operators.profile import describe_modes, preview_steps, stage_counts
    from plumage.sources.csv import good_rows, malformed_report, scan_with_quarantine

    scanned = scan_with_quarantine(spark, csv_path, schema, header=header, multi_line=multi_line)
    good = good_rows(scanned)
    return ProfileReport(malformed_report(scanned), describe_modes(scanned, columns or good.columns), stage_counts(good, key),
                         preview_steps(good, form, key))
