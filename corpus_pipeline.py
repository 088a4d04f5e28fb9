"""The corpus pipeline: documents -> packed training sequences.

Five stages, each over all documents that its predecessor kept. Every stage is
a function ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the
columns of ``docs``. A stage's result is written as Parquet in the shared
folder and read again as the next one's input. Decisions are made per doc_id: a
row goes if its id was decided against; rows without an id are never dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumage.llm import decontaminate, exactdup, neardup, packing, quality
from plumage.llm.common import land
from plumage.sources.tables import load_table

SIMILARITY_PERCENT = 85
TOKENIZER = "word_bpe_49k.json"


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``gone`` (a column doc_id)."""
    return docs.join(land(gone.select("doc_id").distinct(), "pipeline-dropped"), "doc_id", "left_anti").select(
        *[docs[c] for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    trusted = load_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return _without(docs, quality.score_quality(docs, trusted).where("not keep"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return _without(docs, exactdup.exact_duplicates(docs).where("not kept"))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id."""
    return _without(docs, neardup.near_duplicates(docs, SIMILARITY_PERCENT).where("not kept"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return _without(docs, decontaminate.find_leaks(docs, load_table(spark, sf_dir, "benchmark")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), packing.SEQUENCE)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("minhash_dedup", minhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The stages are not expressible in SQL (perplexity model, tokenizer); see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; the last stage's rows."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
