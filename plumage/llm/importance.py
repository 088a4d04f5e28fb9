"""Importance resampling towards a target distribution.

Texts are bags of hashed word n-grams. Every bucket has a gain, the logarithm
of how much more frequent it is in the target texts than in the corpus; a
document's weight is the sum over its n-grams, taken from one array. Gumbel
noise that depends on the document's id alone makes the highest scores a sample
without replacement in proportion to the weights.

The sample's cutoff is found without sorting the corpus: a quantile sketch
brackets it, exact counts outside the bracket confirm that it lies inside (or
the bracket is widened), and only the rows of the bracket are sorted. The
result lists the sample's ranks, so the drawn rows are ranked as well, range by
range (``operators.ranking``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumage.llm import crc
from plumage.llm.common import LETTERS, flat_bytes, land, slices, text_or_empty
from plumage.llm.runs import runs
from plumage.operators.ranking import ranked

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
SEED = 42
#: Accuracy of the quantile sketch: about one row in so many may lie between its answer and the quantile.
ACCURACY = 10_000
SLICE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Buckets of all runs of 1 to LONGEST words.

    Returns, per run length, the buckets in text order and their bounds per
    text, and the number of words of each text.
    """
    offsets, raw = flat_bytes(texts)
    start, end, bounds = runs(LETTERS[raw], offsets)
    raw = _LOWER[raw]
    word = crc.crc_of_runs(raw, start, end)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    blank = np.full(len(word), crc.crc_of_runs(np.array([32], np.uint8), np.zeros(1, int), np.ones(1, int))[0], np.uint32)
    spaced, length = crc.append(blank, word, end - start), end - start + 1
    out, joined, at = [], word, np.arange(len(word))
    for n in range(1, LONGEST + 1):
        if n > 1:
            inside = np.flatnonzero(at + n - 1 < len(word))
            inside = inside[text[at[inside] + n - 1] == text[at[inside]]]
            at = at[inside]
            joined = crc.append(joined[inside], spaced[at + n - 1], length[at + n - 1])
        out.append((joined % np.uint32(buckets), np.searchsorted(text[at], np.arange(len(bounds)))))
    return out, np.diff(bounds)


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, max_bytes=SLICE):
            for found, _ in features(batch.column("text"), buckets)[0]:
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["bucket", "n"])
    return run


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts: one array per task, summed up to ``buckets`` numbers."""
    texts = docs.select(text_or_empty(text_col).alias("text"))
    rows = texts.mapInArrow(_count(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(buckets, np.int64)
    for row in rows:
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target to corpus frequency, rounded down, per bucket."""
    size = len(corpus)
    s_all, t_all = float(corpus.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log(((t + 1) * s_all) / ((s + 1) * t_all)))
                     for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE):
            found, n_words = features(batch.column("text"), len(gain))
            n_features = sum(np.diff(bounds) for _, bounds in found)
            weight = np.zeros(batch.num_rows, np.int64)
            for bucket, bounds in found:
                sums = np.concatenate([[0], np.cumsum(gain[bucket])])
                weight += sums[bounds[1:]] - sums[bounds[:-1]]
            yield pa.record_batch([batch.column("id"), pa.array(n_words.astype(np.int64)),
                                   pa.array(n_features.astype(np.int64)), pa.array(weight)],
                                  ["id", "n_words", "n_features", "weight"])
    return run


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from the hash of ``seed`` and the id (NULL: of the seed alone)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


@dataclass
class Bracket:
    """Scores between ``low`` and ``high`` hold the cutoff; ``above`` rows score higher."""

    low: int
    high: int
    above: int
    inside: int


def bracket(rows: DataFrame, k: int, n: int, accuracy: int = ACCURACY) -> Bracket:
    """Where the ``k``-th highest of the ``n`` scores lies, by a quantile sketch and exact counts."""
    margin = 2 / accuracy
    while True:
        levels = [min(max(1 - k / n + d, 0.0), 1.0) for d in (-margin, margin)]
        low, high = rows.agg(F.percentile_approx("score", levels, accuracy).alias("q")).first()["q"]
        # once the margin covers everything, so must the bracket
        edge = rows.agg(F.min("score").alias("low"), F.max("score").alias("high")).first() if margin >= 1 else None
        low, high = (edge["low"], edge["high"]) if edge else (low, high)
        counts = rows.agg(F.count_if(F.col("score") > high).alias("above"),
                          F.count_if(F.col("score").between(low, high)).alias("inside")).first()
        if counts["above"] < k <= counts["above"] + counts["inside"]:
            return Bracket(low, high, counts["above"], counts["inside"])
        margin *= 4


def highest(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows of highest score with their ``rank``; ties to the smaller id, then the smaller uid.

    ``rows`` is a landed table with the columns score, id and uid (unique).
    """
    n = rows.count()
    if k <= 0:
        return rows.where("false").withColumn("rank", F.lit(None).cast("long"))
    order = F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("uid").asc()
    if k < n:
        found = bracket(rows, k, n)
        middle = land(rows.where(F.col("score").between(found.low, found.high)).select("score", "id", "uid"), "bracket")
        last = ranked(middle, *order).where(F.col("rank") == k - found.above).first()
        before = F.col("score") > last["score"]
        same = F.col("score") == last["score"]
        uid_fits = F.col("uid") <= last["uid"]
        if last["id"] is None:
            smaller, equal = F.col("id").isNotNull(), F.col("id").isNull()
        else:
            smaller, equal = F.coalesce(F.col("id") < last["id"], F.lit(False)), F.col("id").eqNullSafe(F.lit(last["id"]))
        rows = land(rows.where(before | (same & (smaller | (equal & uid_fits)))), "drawn")
    return ranked(rows, *order)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", min_words: int = MIN_WORDS, buckets: int = BUCKETS,
             seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) for every row of ``docs``; rank is NULL if not drawn.

    ``percent`` of the rows with at least ``min_words`` words are drawn (rounded
    down), those of highest score, ties to the smaller id. Words are runs of
    ASCII letters and digits and of all characters above ASCII, A-Z lower-cased.
    A NULL or empty text has no features and weight 0; rows with one id share
    their noise, and each is ranked by itself; NULL ids come last among equal
    scores. Empty tables give an empty result; an empty target leaves the
    smoothed ratio to the corpus alone. Other columns are ignored.
    """
    columns = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    gain = gains(bucket_counts(columns, buckets=buckets), bucket_counts(target, target_text_col, buckets))
    weighed = columns.mapInArrow(_weigh(gain), "id long, n_words long, n_features long, weight long")
    scored = land(weighed.select("*", (F.col("weight") + gumbel(F.col("id"), seed)).alias("score"),
                                 F.monotonically_increasing_id().alias("uid")), "importance")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = highest(able, percent * able.count() // 100)
    kept = scored.join(drawn.select("uid", "rank"), "uid", "left")
    return kept.select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")
