"""Toxicity categories by a classifier chain.

Categories are predicted one after the other by linear (logistic) models over
word features; each later model also sees the earlier categories'
probabilities. For training these come out of fold: a labelled row's
probability is given by a model that was not fitted on it, so a later model
never learns from over-confident inputs. Models are fitted on a bounded sample
of the labelled rows; every document is scored, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm.common import LETTERS, flat_bytes, land, slices, words

#: Labelled rows a chain is fitted on, at most.
SAMPLE_ROWS = 20_000
#: Features picked for a category, at most.
FEATURES = 192
#: Labelled rows of the sample a feature must be in.
MIN_ROWS = 8
FOLDS = 3
PARTITIONS = 6
#: A feature is a word, or the first bytes of a longer word.
PREFIXES = (4, 5)


@dataclass(frozen=True)
class Chain:
    """Fitted chain: sorted feature hashes; per category a bias, feature weights
    and weights of the earlier categories' probabilities."""

    categories: tuple[str, ...]
    features: np.ndarray
    bias: np.ndarray
    weights: np.ndarray   # categories x features
    earlier: np.ndarray   # categories x categories, lower triangle


def _present(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature hash) pairs of a slice, by document."""
    offsets, raw = flat_bytes(batch.column(column))
    whole, _, bounds, *heads = words(offsets, raw, LETTERS, PREFIXES)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
    doc, value = np.tile(doc, 1 + len(heads)), np.concatenate([whole, *heads])
    return doc[value != 0], value[value != 0]


def _pairs(doc: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(doc * width + at)
    return both // width, both % width


def _count(categories: int):
    """Per slice: feature -> rows it is in, and rows of each category it is in."""
    names = ["feature", "n", *[f"n{c}" for c in range(categories)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc, value = _present(batch, "text")
            known, at = np.unique(value, return_inverse=True)
            if not len(known):
                continue
            doc, at = _pairs(doc, at, len(known))
            labels = [np.asarray(batch.column(2 + c)) for c in range(categories)]
            counts = [np.bincount(at, minlength=len(known))]
            counts += [np.bincount(at, weights=y[doc], minlength=len(known)) for y in labels]
            yield pa.record_batch([pa.array(known.view(np.int64)), *[pa.array(c.astype(np.int64)) for c in counts]],
                                  names)
    return run


def _matrix(features: np.ndarray, categories: int, names: list[str]):
    """Rows with a dense 0/1 feature array, for fitting."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            doc, value = _present(batch, "text")
            x = np.zeros((batch.num_rows, len(features)))
            at = np.minimum(np.searchsorted(features, value), len(features) - 1)
            hit = features[at] == value
            x[doc[hit], at[hit]] = 1.0
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(features)
            yield pa.record_batch(
                [batch.column(0), *[batch.column(2 + c) for c in range(categories)],
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))], names)
    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: Sequence[str], rows: int = SAMPLE_ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``rows`` labelled documents, the smallest by a hash of their id.

    ``labels`` has the id and one 0/1 column per category; rows with a NULL id
    or category are no labels. Repeated labels of one id count once (the largest).
    NULL texts are empty; other columns of ``docs``, whatever their names, are
    ignored; empty tables give an empty sample.
    """
    known = labels.select(F.col(id_col).alias("_id"), *[F.col(c).cast("double").alias(c) for c in categories]) \
        .dropna().groupBy("_id").agg(*[F.max(c).alias(c) for c in categories])
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)  # the documented bound
    texts = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(picked), F.col("_doc") == F.col("_id")).select(
        F.col("_id").alias("id"), F.col("_text").alias("text"), *categories)


def select_features(sample: DataFrame, categories: Sequence[str], per_category: int = FEATURES,
                    min_rows: int = MIN_ROWS) -> np.ndarray:
    """Hashes of the words and word heads that tell a category best (chi-square)."""
    k = len(categories)
    totals = sample.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(c), F.lit(0.0)) for c in categories]).first()
    counts = (sample.select("id", "text", *categories)
              .mapInArrow(_count(k), "feature long, n long, " + ", ".join(f"n{c} long" for c in range(k)))
              .groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(f"n{c}").alias(f"n{c}") for c in range(k)])
              .where(F.col("n") >= min_rows))
    counts = land(counts, "toxicity-features")
    chosen: set[int] = set()
    rows = float(totals[0])
    for c in range(k):
        a, n, p = F.col(f"n{c}").cast("double"), F.col("n").cast("double"), F.lit(float(totals[1 + c]))
        b = rows * a - n * p
        chi = b * b / (n * p * (rows - n) * (rows - p) + 1)
        chosen |= {r[0] for r in counts.orderBy(chi.desc(), "feature").limit(per_category).select("feature").collect()}
    return np.sort(np.array(sorted(chosen), np.int64).view(np.uint64))


def fit_chain(sample: DataFrame, categories: Sequence[str], folds: int = FOLDS, reg: float = 1e-4) -> Chain:
    """Fit the chain on a labelled sample (see :func:`labelled_sample`).

    A category with one value only in the sample gets a constant model. Without
    any labelled row nothing is known to be toxic: all probabilities are 0 (but
    for rounding).
    """
    k = len(categories)
    features = select_features(sample, categories)
    if not len(features):
        features = np.zeros(1, np.uint64)
    names = ["id", *categories, "x"]
    schema = "id long, " + ", ".join(f"{c} double" for c in categories) + ", x array<double>"
    rows = sample.select("id", "text", *categories).mapInArrow(_matrix(features, k, names), schema)
    # the sample is bounded, so a few partitions hold it; every fitting step is one small job over them
    rows = land(rows.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(folds))).coalesce(PARTITIONS),
                       "toxicity-rows")
    if not rows.take(1):
        return Chain(tuple(categories), features, np.full(k, -50.0), np.zeros((k, len(features))), np.zeros((k, k)))
    bias, weights, earlier = np.zeros(k), np.zeros((k, len(features))), np.zeros((k, k))
    for c, name in enumerate(categories):
        seen = [f"p_{x}" for x in categories[:c]]
        inputs = F.concat("x", F.array(*seen)) if seen else F.col("x")
        rows = rows.withColumn("v", array_to_vector(inputs))
        learner = LogisticRegression(featuresCol="v", labelCol=name, probabilityCol="p", rawPredictionCol="r",
                                     predictionCol="q", regParam=reg, maxIter=40)
        model = learner.fit(rows)
        coefficients = model.coefficients.toArray()
        bias[c] = np.clip(model.intercept, -30, 30)
        weights[c] = coefficients[:len(features)]
        earlier[c, :c] = coefficients[len(features):]
        if c + 1 < k:
            parts = [_out_of_fold(learner, rows, f, f"p_{name}") for f in range(folds)]
            scored = parts[0]
            for part in parts[1:]:
                scored = scored.unionByName(part)
            rows = land(scored, "toxicity-out-of-fold")
    return Chain(tuple(categories), features, bias, weights, earlier)


def _out_of_fold(learner: LogisticRegression, rows: DataFrame, fold: int, name: str) -> DataFrame:
    """Rows of a fold with the probability that a model of the other folds gives (one half if they have no row)."""
    others, mine = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
    if not others.take(1):
        return mine.withColumn(name, F.lit(0.5)).drop("v")
    scored = learner.fit(others).transform(mine)
    return scored.withColumn(name, vector_to_array("p")[1]).drop("v", "p", "r", "q")


def _score(chain: Chain):
    names = ["id", *[f"p_{c}" for c in chain.categories]]
    width = len(chain.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc, value = _present(batch, "text")
            at = np.minimum(np.searchsorted(chain.features, value), width - 1)
            hit = chain.features[at] == value
            doc, at = _pairs(doc[hit], at[hit], width)
            p = np.zeros((len(chain.categories), batch.num_rows))
            for c in range(len(chain.categories)):
                z = chain.bias[c] + np.bincount(doc, weights=chain.weights[c][at], minlength=batch.num_rows)
                p[c] = 1 / (1 + np.exp(-np.clip(z + chain.earlier[c] @ p, -50, 50)))
            yield pa.record_batch([batch.column(0), *[pa.array(x) for x in p]], names)
    return run


def score_chain(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_<category>, ...) for every row, over its whole text.

    NULL and empty texts have no features and get the chain's base rates;
    repeated rows are scored alike; an empty table gives an empty result; other
    columns are ignored. The chain is bounded (a few hundred features), so it
    travels with the tasks.
    """
    schema = "id long, " + ", ".join(f"p_{c} double" for c in chain.categories)
    columns = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return columns.mapInArrow(_score(chain), schema).withColumnRenamed("id", id_col)
