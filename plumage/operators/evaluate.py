"""Evaluation: confusion matrices and weighted metrics from one aggregate.

The reference evaluates each prediction set with five passes (four evaluator
metrics + a group-by). Here every model's predictions are added as columns of
one scored table, ``stack`` turns them into (model, prediction) rows inside the
map task, and one ``groupBy`` builds all confusion matrices together; map-side
partial aggregation leaves at most models x splits x classes^2 rows to shuffle.
Metrics are then derived from that tiny table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumage.functions.rounding import percent
from plumage.operators.models import N_EQUAL
from plumage.operators.ranking import ranked
from plumage.session import cut_lineage


def label_name(labels: list[str], col: str) -> F.Column:
    """Index -> label name (IndexToString on a column of the small table): a place in one constant array."""
    return F.get(F.array(*[F.lit(name) for name in labels]), F.col(col).cast("int"))


def joint_confusion(scored: DataFrame, models: list[str], label_col: str = "gender",
                    index_col: str = "gender_indexed", by: tuple[str, ...] = ("split",)) -> DataFrame:
    """(model, *by, label, label_index, prediction, n) for every model at once.

    ``scored`` may hold counted rows (see :func:`plumage.operators.models.counted`).
    """
    pairs = ", ".join(f"'{m}', `pred_{m}`" for m in models)
    keys = [*by, label_col, index_col]
    rows = F.col(N_EQUAL) if N_EQUAL in scored.columns else F.lit(1)
    long = scored.select(*keys, rows.alias(N_EQUAL), F.expr(f"stack({len(models)}, {pairs}) as (model, prediction)"))
    return long.groupBy("model", *keys, "prediction").agg(F.sum(N_EQUAL).cast("long").alias("n"))


def confusion_matrix(confusion: DataFrame, labels: list[str], label_col: str = "gender",
                     by: tuple[str, ...] = ("model", "split")) -> DataFrame:
    """(*by, gender, predicted_gender, n), sorted like the reference's output."""
    out = confusion.groupBy(*by, label_col, "prediction").agg(F.sum("n").cast("long").alias("n"))
    out = out.select(*by, label_col, label_name(labels, "prediction").alias(f"predicted_{label_col}"), "n")
    return out.orderBy(*by, label_col, f"predicted_{label_col}")


def positioned(matrix: DataFrame, *order: str) -> DataFrame:
    """A matrix with ``position``, its rows' places 1, 2, 3... in ``order``, so that the order itself can be compared."""
    return ranked(cut_lineage(matrix, "matrix"), *[F.col(c).asc() for c in order], name="position")


def metrics(confusion: DataFrame, label: str = "label", prediction: str = "prediction",
            by: tuple[str, ...] = ("model", "split"), digits: int = 6) -> DataFrame:
    """Accuracy, weighted precision / recall, F1 (MulticlassMetrics semantics).

    For each class c (a value of ``label``): precision = tp / predicted_c (0 if
    never predicted), recall = tp / actual_c, f1 = 2pr / (p + r) (0 if both 0),
    weights = actual_c / total. A class with tp = 0 contributes 0 to every
    weighted sum, so only diagonal cells are summed.
    """
    cells = confusion.groupBy(*by, label, prediction).agg(F.sum("n").alias("n"))
    grp = [F.col(c) for c in by]
    cells = (cells
             .withColumn("actual", F.sum("n").over(Window.partitionBy(*grp, F.col(label))))
             .withColumn("predicted", F.sum("n").over(Window.partitionBy(*grp, F.col(prediction))))
             .withColumn("total", F.sum("n").over(Window.partitionBy(*grp)) if by
                         else F.sum("n").over(Window.partitionBy(F.lit(1)))))
    diag = cells.where(F.col(label) == F.col(prediction))
    p = F.col("n") / F.col("predicted")
    r = F.col("n") / F.col("actual")
    w = F.col("actual") / F.col("total")
    agg = diag.groupBy(*by).agg(
        (F.sum("n") / F.first("total")).alias("accuracy"),
        F.sum(w * p).alias("weighted_precision"),
        F.sum(w * r).alias("weighted_recall"),
        F.sum(w * 2 * p * r / (p + r)).alias("f1"),
    )
    # A group without any correct prediction has no diagonal cell: its metrics are 0.
    groups = cells.select(*by).distinct()
    out = groups.join(agg, list(by), "left") if by else agg
    names = ["accuracy", "weighted_precision", "weighted_recall", "f1"]
    exact = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in names}
    # whole percents come from the unrounded metric: rounding twice can move one up
    return out.select(*by, *[F.round(x, digits).alias(c) for c, x in exact.items()],
                      *[percent(x).alias(f"{c}_pct") for c, x in exact.items()])
