"""Projection, casting, label-trust filters, colour and text cleaning.

Everything here is a narrow transformation (Project / Filter): no shuffle,
whole-stage codegen, and Catalyst pushes ``description IS NOT NULL`` /
``text IS NOT NULL`` into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumage.functions.hex import hex_to_int
from plumage.functions.text import normalize_text

# The trusted class labels.
LABELS = ("male", "female", "brand")


def select_profile(df: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Keep the eight raw columns (plus row keys), cast and alias.

    ``try_cast`` instead of ``cast``: under ANSI mode a non-numeric count
    ('n/a') would abort the job; here it becomes NULL.
    """
    keep = [k for k in keys if k in df.columns]
    return df.select(
        *keep,
        "gender", "description", "link_color", "sidebar_color", "text",
        F.col("tweet_count").try_cast("double").alias("tweet_count"),
        "gender_gold",
        F.col("`gender:confidence`").try_cast("double").alias("gender_confidence"),
    )


def trust_predicate(form: str = "train", labels: tuple[str, ...] = LABELS) -> Column:
    """Which rows carry a trustworthy label.

    ``train``: ((gender valid and confidence = 1.0) or gold valid) and
    description not null. ``sweep``: gender valid and (gold valid or
    confidence = 1.0) and text and description not null. The two forms are not
    equivalent; both are kept.
    """
    gender_ok = F.col("gender").isin(*labels)
    gold_ok = F.col("gender_gold").isin(*labels)
    sure = F.col("gender_confidence") == 1.0
    if form == "train":
        return ((gender_ok & sure) | gold_ok) & F.col("description").isNotNull()
    if form == "sweep":
        return (gender_ok & (gold_ok | sure) & F.col("text").isNotNull()
                & F.col("description").isNotNull())
    raise ValueError(f"unknown filter form {form!r}")


def trust_filter(df: DataFrame, form: Column | str = "train", labels: tuple[str, ...] = LABELS,
                 drop: bool = True) -> DataFrame:
    """Rows that pass: ``form`` is "train", "sweep", a Column or a predicate as SQL text."""
    known = isinstance(form, str) and form in ("train", "sweep")
    out = df.where(trust_predicate(form, labels) if known else form)
    return out.drop("gender_confidence", "gender_gold") if drop else out


def drop_reason(labels: tuple[str, ...] | None = None) -> Column:
    """Why a filtered row cannot be trained on; NULL if it can.

    The pipeline needs a label and a numeric count. ``labels`` allows only
    those labels (default: any label that is not NULL).
    """
    why = F.when(F.col("gender").isNull(), "null_label")
    if labels is not None:
        why = why.when(~F.col("gender").isin(*labels), "label_not_allowed")
    return why.when(F.col("tweet_count").isNull(), "null_count")


def convert_colours(df: DataFrame) -> DataFrame:
    """Hex colours -> ints (``*_indexed``); raw colour columns dropped."""
    return (df.withColumn("link_color_indexed", hex_to_int("link_color"))
              .withColumn("sidebar_color_indexed", hex_to_int("sidebar_color"))
              .drop("link_color", "sidebar_color"))


def clean_text(df: DataFrame, cols: tuple[str, ...] = ("text", "description"),
               unicode_words: bool = False) -> DataFrame:
    return df.withColumns({c: normalize_text(c, unicode_words) for c in cols})


def final_projection(df: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    keep = [k for k in keys if k in df.columns]
    return df.select(*keep, "gender", "description", "link_color_indexed",
                     "sidebar_color_indexed", "text", "tweet_count")


def prepare(df: DataFrame, form: str = "train", keys: tuple[str, ...] = ("doc_id",),
            unicode_words: bool = False) -> DataFrame:
    """The whole cleaning chain: project/cast -> trust filter -> colours -> text."""
    out = trust_filter(select_profile(df, keys), form)
    out = clean_text(convert_colours(out), unicode_words=unicode_words)
    return final_projection(out, keys)
