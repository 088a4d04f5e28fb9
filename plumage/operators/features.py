"""Feature operators: the ML pipeline and its relational twins.

The pipeline is the reference's twelve stages (label index, 2x tokenise,
2x stop words, 2x hashed TF with 1,000 buckets, 2x IDF, assemble to 2,003
columns, scale by sample stddev, L2-normalise), built from ``pyspark.ml``.

The relational twins express the same arithmetic with DataFrame operators on
exact terms (no hashing), so DuckDB can check them:

* term frequency: explode tokens, ``groupBy(key, term).count()``. Map-side
  partial aggregation collapses a document's repeated tokens inside the task
  that exploded them, so the shuffle carries distinct (doc, term) pairs only,
  and hashing on both columns spreads a huge document over many reducers.
* document frequency: ``groupBy(term).count()`` over those distinct pairs; a
  term present in every document (the empty token) is pre-aggregated per map
  task, so a hot term costs one partial row per task, not one row per document.
* the corpus size N is a scalar subquery (one aggregate, used as a constant).
* TF-IDF joins the per-(doc, term) table to the landed per-term table without
  a hint: Spark broadcasts it only under its measured-size threshold, else
  shuffles and splits hot terms by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    Normalizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.functions.text import normalize_text, remove_stop_words, tokenize
from plumage.operators.ranking import ranked
from plumage.session import cut_lineage

NUM_FEATURES = 1000
NUMERIC_INPUTS = ("link_color_indexed", "tweet_count", "sidebar_color_indexed")
TEXT_INPUTS = ("text", "description")
FEATURES = "normalizedFeatures"


# ---------------------------------------------------------------------------
# ML pipeline
# ---------------------------------------------------------------------------

def token_stages(label_col: str = "gender", num_features: int = NUM_FEATURES,
                 label_invalid: str = "error") -> list:
    """Stages up to hashed TF. Only the label indexer needs fitting."""
    stages = [StringIndexer(inputCol=label_col, outputCol=f"{label_col}_indexed",
                            handleInvalid=label_invalid)]
    stages += [Tokenizer(inputCol=c, outputCol=f"{c}_words") for c in TEXT_INPUTS]
    stages += [StopWordsRemover(inputCol=f"{c}_words", outputCol=f"{c}_removed") for c in TEXT_INPUTS]
    stages += [HashingTF(numFeatures=num_features, inputCol=f"{c}_removed",
                         outputCol=f"hashingtf_{c[:4]}") for c in TEXT_INPUTS]
    return stages


def weighting_stages(feature_invalid: str = "error") -> list:
    """IDF, assembly, scaling and normalisation (fitted on hashed TF)."""
    stages = [IDF(inputCol=f"hashingtf_{c[:4]}", outputCol=f"idf_{c[:4]}") for c in TEXT_INPUTS]
    stages.append(VectorAssembler(
        inputCols=[*NUMERIC_INPUTS, *[f"idf_{c[:4]}" for c in TEXT_INPUTS]],
        outputCol="features", handleInvalid=feature_invalid))
    stages.append(StandardScaler(inputCol="features", outputCol="scaledFeatures",
                                 withMean=False, withStd=True))
    stages.append(Normalizer(inputCol="scaledFeatures", outputCol=FEATURES, p=2.0))
    return stages


def feature_pipeline(label_col: str = "gender", num_features: int = NUM_FEATURES,
                     label_invalid: str = "error", feature_invalid: str = "error") -> Pipeline:
    """The reference's twelve stages as one ``Pipeline`` (single-shot fit)."""
    return Pipeline(stages=token_stages(label_col, num_features, label_invalid)
                    + weighting_stages(feature_invalid))


def fit_and_featurize(df: DataFrame, label_col: str = "gender", num_features: int = NUM_FEATURES,
                      label_invalid: str = "error", feature_invalid: str = "error",
                      fit_on: str = "all", keep: tuple[str, ...] = ("doc_id", "split"),
                      sink=None) -> tuple[PipelineModel, DataFrame]:
    """Fit the pipeline in two phases and featurize, tokenising text once.

    ``Pipeline.fit`` followed by ``transform`` would tokenise and hash every
    document four times (once per later estimator: two IDFs and the scaler,
    and again to transform). Here phase one (label index + tokenise + stop
    words + hashed TF) is landed once as sparse TF vectors with the row keys in
    the shared folder, so a lost executor re-reads it; phase two (IDF x2,
    assembler, scaler, normaliser) fits on it and transforms it. ``sink`` (e.g.
    a lineage cut) receives the featurized rows.
    ``fit_on='train'`` fits both phases on rows with ``split = 'train'`` only;
    the default ``'all'`` reproduces the reference, which fitted before
    splitting. A NULL label or number is an error unless ``*_invalid`` says
    ``skip``; ``plumage.plans.jobs.usable`` removes and reports such rows.
    """
    fit_rows = (lambda d: d.where(F.col("split") == "train")) if fit_on == "train" else (lambda d: d)
    phase1 = Pipeline(stages=token_stages(label_col, num_features, label_invalid)).fit(fit_rows(df))
    cols = [c for c in keep if c in df.columns]
    hashed = cut_lineage(phase1.transform(df).select(
        *cols, label_col, f"{label_col}_indexed", *NUMERIC_INPUTS,
        *[f"hashingtf_{c[:4]}" for c in TEXT_INPUTS],
    ), "hashed-tf")
    phase2 = Pipeline(stages=weighting_stages(feature_invalid)).fit(fit_rows(hashed))
    out = phase2.transform(hashed).select(*cols, label_col, f"{label_col}_indexed", FEATURES)
    if sink is not None:
        out = sink(out)
    return PipelineModel(stages=phase1.stages + phase2.stages), out


def fit_features(df: DataFrame, label_col: str = "gender", num_features: int = NUM_FEATURES,
                 label_invalid: str = "error", feature_invalid: str = "error",
                 fit_on: str = "all") -> PipelineModel:
    """The fitted twelve-stage ``PipelineModel`` (see :func:`fit_and_featurize`)."""
    model, _ = fit_and_featurize(df, label_col, num_features, label_invalid, feature_invalid,
                                 fit_on, keep=(), sink=lambda d: d)
    return model


def label_list(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def featurize(df: DataFrame, model: PipelineModel, keep: tuple[str, ...] = ("doc_id", "split"),
              label_col: str = "gender") -> DataFrame:
    """Apply the fitted pipeline; keep only key, label, split and the vector."""
    out = model.transform(df)
    cols = [c for c in keep if c in out.columns]
    return out.select(*cols, label_col, f"{label_col}_indexed", FEATURES)


def vector_entries(col: str):
    """The non-zero (pos, value) pairs of a vector column, as an array.

    A sparse vector's own indices are used: no row is widened to a dense array.
    """
    v = F.unwrap_udt(F.col(col))
    at = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    pairs = F.zip_with(at, v["values"], lambda pos, value: F.struct(pos.alias("pos"), value.alias("value")))
    return F.filter(pairs, lambda e: e["value"] != 0.0)


def explode_vector(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """(*keys, pos, value) for every non-zero entry of a vector column."""
    return df.select(*keys, F.explode(vector_entries(col)).alias("_e")).select(*keys, "_e.pos", "_e.value")


def vector_summary(df: DataFrame, col: str = FEATURES) -> DataFrame:
    """Width, active entries and L2 norm of a vector column (plain types)."""
    v = F.unwrap_udt(F.col(col))
    return df.withColumns({
        "width": F.when(v["type"] == 0, v["size"]).otherwise(F.size(v["values"])),
        "n_active": F.size(F.filter(v["values"], lambda x: x != 0.0)),
        "l2_norm": F.sqrt(F.aggregate(v["values"], F.lit(0.0), lambda acc, x: acc + x * x)),
    }).drop(col)


# ---------------------------------------------------------------------------
# Relational twins (exact terms, DuckDB-checkable)
# ---------------------------------------------------------------------------

def token_array(text_col: str, drop_stop_words: bool = True, normalize: bool = True):
    t = normalize_text(text_col) if normalize else F.col(text_col)
    toks = tokenize(t)
    return remove_stop_words(toks) if drop_stop_words else toks


def term_frequency(df: DataFrame, key: str = "doc_id", text_col: str = "text",
                   drop_stop_words: bool = True) -> DataFrame:
    """(key, term, tf): exact per-document term counts."""
    terms = df.select(key, F.explode(token_array(text_col, drop_stop_words)).alias("term"))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).cast("long").alias("tf"))


def corpus_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_docs"))


def inverse_document_frequency(tf: DataFrame, n_docs: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = ln((N + 1) / (df + 1)), as ML's IDF."""
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).cast("long").alias("df"))
    n = n_docs.select("n_docs").scalar()  # scalar subquery: computed once, used as a constant
    return dfreq.select("term", "df", F.log((n + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def tfidf(tf: DataFrame, idf: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, term, tf, idf, tfidf); the join strategy is Spark's, by measured bytes."""
    joined = tf.join(idf.select("term", "idf"), "term")
    return joined.select(key, "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def std_scale_twin(df: DataFrame, cols: list[str]) -> DataFrame:
    """Divide each column by its sample stddev (0 stays 0 when stddev is 0).

    Each stddev is a scalar subquery over one aggregate (computed once, then a
    constant in the projection); no join and no unpartitioned window.
    """
    sds = [df.select(F.stddev_samp(c)).scalar() for c in cols]
    return df.withColumns({c: F.when(sd != 0, F.col(c) / sd).otherwise(0.0)
                           for c, sd in zip(cols, sds)})


def l2_normalize_twin(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row-wise division by the L2 norm; an all-zero row stays zero."""
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0)))
    return df.withColumns({c: F.when(norm != 0, F.col(c) / norm).otherwise(F.col(c)) for c in cols})


def label_index_twin(df: DataFrame, label_col: str) -> DataFrame:
    """(label, n, label_index): descending frequency, ties alphabetical.

    Counted once and ranked range by range, so the number of labels is not
    bounded (StringIndexer collects its list to the driver).
    """
    counts = cut_lineage(df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(
        F.count(F.lit(1)).cast("long").alias("n")), "label-counts")
    ranks = ranked(counts, F.col("n").desc(), F.col(label_col).asc(), name="_rank")
    return ranks.select(label_col, "n", (F.col("_rank") - 1).cast("double").alias("label_index"))


def index_labels(df: DataFrame, label_col: str, table: DataFrame, index_col: str = "label_index") -> DataFrame:
    """``df`` with its labels' index by a join with ``table`` (see :func:`label_index_twin`); an unknown or NULL label has none."""
    known = table.select(F.col(label_col).alias("_label"), F.col("label_index").alias(index_col))
    return df.join(known, F.col(label_col) == F.col("_label"), "left").drop("_label")


def name_labels(df: DataFrame, index_col: str, table: DataFrame, label_col: str, name: str) -> DataFrame:
    """``df`` with the label of ``index_col`` as ``name``: the inverse of :func:`index_labels`."""
    known = table.select(F.col("label_index").alias("_index"), F.col(label_col).alias(name))
    return df.join(known, F.col(index_col) == F.col("_index"), "left").drop("_index")
