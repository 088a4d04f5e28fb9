"""Sweep and comparison keys whose every parameter shows: labels on stairs.

One ordered column ``step`` decides the class; the cells have sizes for which
a fit with a given limit predicts a known class for each of them. So every
grid point has an accuracy of its own that SQL can state, and a sweep that
ignored a parameter would differ. Rows are seven per order.

* Depth: 22 cells of 22, 21, ... 1 parts. The best split always takes the first
  cell off, one a level, so depth d separates the cells before d; the rest
  gets the class of its largest, d.
* Gain: cells of 1, 49, 42 and 8 parts. The first split (0.42) is in the middle,
  the one on its right gains 0.27, on its left 0.04.
* Bins: 11 falling cells. The quantile rule finds the first b - 1 borders for b
  bins; the rest gets the class of its largest cell.
* Minimum instances: large cells with small ones between them that have a
  fixed number of training rows (the other rows are test rows).

All cells are learned from the whole training split; predictions are stated for
the test split. The forest is fitted without resampling here: each of its
trees sees the same rows, as the statement needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumage.operators import trees
from plumage.operators.features import FEATURES
from plumage.operators.models import decision_tree, train
from plumage.operators.sweep import DEFAULTS, grid, sweep
from plumage.plans import jobs
from plumage.session import cut_lineage
from plumage.sources.tables import load_table

KEYS = ["o_orderkey", "copy"]
COPIES = 7
# ten rows in a row share a cell, seven of them are for training
_ROW = f"(o_orderkey * {COPIES} + copy)"


@dataclass(frozen=True)
class Stairs:
    """Cells by their parts of the rows; ``fixed``: parts are numbers of training rows, test rows fall evenly."""

    parts: tuple[int, ...]
    predicted: str  # SQL: the class (cell number) predicted for cell k at a sweep's ``value``
    fixed: bool = False

    def step(self, div: str) -> str:
        """SQL of a row's cell; ``div`` is the engine's integer division."""
        total = sum(self.parts)
        place = f"{_ROW} % {total}" if self.fixed else f"({_ROW} {div} 10) % {total}"
        cases = " ".join(f"when {place} < {end} then {k}" for k, end in enumerate(accumulate(self.parts)))
        cell = f"case {cases} end"
        return f"case when {_ROW} < {total} then {cell} else {_ROW} % {len(self.parts)} end" if self.fixed else cell

    @property
    def split(self) -> str:
        known = f"{_ROW} < {sum(self.parts)}" if self.fixed else f"{_ROW} % 10 < 7"
        return f"case when {known} then 'train' else 'test' end"


DEPTH = Stairs(tuple(range(22, 0, -1)), "least(k, value)")
GAIN = Stairs((1, 49, 42, 8), "case when k <= 1 and value > 0.1 then 1 when k >= 2 and value > 0.3 then 2 else k end")
BINS = Stairs((160, 72, 44, 27, 17, 11, 8, 6, 4, 3, 2), "least(k, value - 1)")
# a small cell (odd) of k + 1 rows that may not stand alone stays with the large one after it
INSTANCES_TREE = Stairs((900, 2, 700, 4, 500, 6, 300, 8, 150), "case when k % 2 = 1 and k + 1 < value then k + 1 else k end",
                        fixed=True)
# pairs of small cells (2 and 5 rows, 3 and 6 rows) stand together while they may, with the class of the larger
INSTANCES_FOREST = Stairs((900, 2, 5, 500, 3, 6), """case
  when k in (1, 2) then case when value > 7 then 3 when value > 2 then 2 else k end
  when k in (4, 5) then case when value > 9 then 3 when value > 3 then 5 else k end else k end""", fixed=True)

STAIRS = {
    "tree": {"maxDepth": DEPTH, "minInfoGain": GAIN, "maxBins": BINS, "minInstancesPerNode": INSTANCES_TREE},
    "forest": {"maxDepth": DEPTH, "minInfoGain": GAIN, "maxBins": BINS, "minInstancesPerNode": INSTANCES_FOREST},
}


def stairs_features(spark: SparkSession, sf_dir: str, stairs: Stairs) -> jobs.FeatureSet:
    """Rows of the stairs as a feature table in the form of ``jobs.build_features``."""
    rows = load_table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"))
    rows = rows.select(*KEYS, F.expr(stairs.split).alias("split"), F.expr(stairs.step("div")).cast("double").alias("step"))
    rows = rows.withColumn("gender", F.format_string("c%02d", F.col("step").cast("int")))
    indexer = StringIndexer(inputCol="gender", outputCol="gender_indexed").fit(rows)
    vectors = VectorAssembler(inputCols=["step"], outputCol=FEATURES).transform(indexer.transform(rows))
    landed = cut_lineage(vectors.drop("step"), "stairs", partition_by="split")
    return jobs.FeatureSet(landed, list(indexer.labels), indexer)


def _sweep(spark: SparkSession, sf_dir: str, algorithm: str) -> DataFrame:
    fixed = {} if algorithm == "tree" else {"bootstrap": False}
    parts = [sweep(stairs_features(spark, sf_dir, stairs).features, algorithm, only=(name,), **fixed)
             for name, stairs in STAIRS[algorithm].items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_sweep_decision_tree_rule(spark, sf_dir):
    return _sweep(spark, sf_dir, "tree")


def q_sweep_random_forest_rule(spark, sf_dir):
    return _sweep(spark, sf_dir, "forest")


def _evaluation(spark, sf_dir) -> jobs.Evaluation:
    """The flagship's two models (9 and 6 bins) on the stairs for bins: they differ, and neither is perfect."""
    fs = stairs_features(spark, sf_dir, BINS)
    return jobs.evaluate(fs, jobs.fit_models(fs))


def q_train_evaluate_rule(spark, sf_dir):
    return _evaluation(spark, sf_dir).matrix


def q_compare_models_rule(spark, sf_dir):
    return _evaluation(spark, sf_dir).metrics


NODES_DEPTH = 12


def q_decision_tree_nodes_rule(spark, sf_dir):
    """Every node of a tree on the stairs for depth (-1: no parent, no feature), with its counts and those made
    again from the rows."""
    fs = stairs_features(spark, sf_dir, DEPTH)
    model = train(fs.features, decision_tree(params={"maxDepth": NODES_DEPTH}), fs.counted)
    nodes = trees.node_table(model)
    again = trees.recount(model, fs.features.where("split = 'train'")).withColumnRenamed("n", "n_rows")
    names = spark.createDataFrame([(float(i), name) for i, name in enumerate(fs.labels)], "label double, class string")
    counted = trees.node_counts(nodes).join(again, ["node", "label"], "full").join(names, "label")
    return nodes.join(counted, ["tree", "node"]).select(
        "node", F.coalesce("parent", F.lit(-1)).alias("parent"), F.coalesce("feature", F.lit(-1)).alias("feature"),
        F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"),
        "class", "n", "n_rows")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "train_evaluate_rule": q_train_evaluate_rule,
    "compare_models_rule": q_compare_models_rule,
    "sweep_decision_tree_rule": q_sweep_decision_tree_rule,
    "sweep_random_forest_rule": q_sweep_random_forest_rule,
    "decision_tree_nodes_rule": q_decision_tree_nodes_rule,
}

METRICS = ("accuracy", "weighted_precision", "weighted_recall", "f1")


def _rows_sql(stairs: Stairs) -> str:
    return (f"select k, split, count(*)::bigint as n from (select {stairs.step('//')} as k, {stairs.split} as split "
            f"from (select o_orderkey, unnest(range({COPIES})) as copy from orders)) group by all")


def _metrics_sql(by: str) -> str:
    """CTE ``m`` with the four metrics per ``by`` from ``cells`` (..., l, p, n)."""
    exact = ", ".join(f"round({c}, 6) as {c}, floor({c} * 100 + 0.5)::bigint as {c}_pct" for c in METRICS)
    return f"""
sided as (select *, sum(n) over (partition by {by}, l) as actual, sum(n) over (partition by {by}, p) as predicted,
                 sum(n) over (partition by {by}) as total from cells),
raw as (select {by}, coalesce(sum(n) filter (where l = p) / max(total), 0) as accuracy,
  coalesce(sum(actual / total * (n / predicted)) filter (where l = p), 0) as weighted_precision,
  coalesce(sum(actual / total * (n / actual)) filter (where l = p), 0) as weighted_recall,
  coalesce(sum(actual / total * 2 * (n / predicted) * (n / actual) / ((n / predicted) + (n / actual)))
           filter (where l = p), 0) as f1 from sided group by {by}),
m as (select {by}, {exact} from raw)"""


def _sweep_sql(algorithm: str) -> str:
    cells, points = [], []
    for i, (name, stairs) in enumerate(STAIRS[algorithm].items()):
        cells.append(f"select g.*, k as l, {stairs.predicted} as p, sum(n) as n from ({_rows_sql(stairs)}) t, points g "
                     f"where split = 'test' and sweep = '{name}' group by all")
    for r in grid(algorithm):
        p = DEFAULTS | r["params"]
        points.append(f"('{r['sweep']}', {r['value']}::double, {p['maxDepth']}, {p['minInfoGain']}::double, "
                      f"{p['maxBins']}, {p['minInstancesPerNode']})")
    by = "sweep, value, max_depth, min_info_gain, max_bins, min_instances_per_node"
    return f"""with points as (select * from (values {', '.join(points)}) as v({by})),
cells as ({' union all '.join(cells)}),{_metrics_sql(by)}
select '{algorithm}' as algorithm, m.*, row_number() over (partition by sweep order by accuracy desc, value) = 1 as chosen from m"""


_NAME = "'c' || lpad(({})::bigint::varchar, 2, '0')"
_MODELS = f"""(select model, split, k as l, least(k, last) as p, n from ({_rows_sql(BINS)}) t,
  (values ('decision_tree', 8), ('random_forest', 5)) as v(model, last))"""

ORACLE: dict[str, str] = {
    "train_evaluate_rule": f"""select model, split, {_NAME.format('l')} as gender, {_NAME.format('p')} as predicted_gender, n
from {_MODELS}""",
    "compare_models_rule": f"""with cells as {_MODELS},{_metrics_sql('model, split')}
select * from m""",
    "sweep_decision_tree_rule": _sweep_sql("tree"),
    "sweep_random_forest_rule": _sweep_sql("forest"),
    # inner node j holds the cells from j on: number 2 j, cell j is its left child, number 2 j + 1
    "decision_tree_nodes_rule": f"""with t as (select k, n from ({_rows_sql(DEPTH)}) where split = 'train'),
held as (
  select 2 * j as node, j, j < {NODES_DEPTH} as split_on, k, n from range({NODES_DEPTH + 1}) as r(j), t where k >= j
  union all
  select 2 * j + 1, j, false, k, n from range({NODES_DEPTH}) as r(j), t where k = j),
stat as (select node, any_value(j) as j, any_value(split_on) as split_on, sum(n) as size,
                1 - sum(n * n) / (sum(n) * sum(n)) as impurity from held group by node),
gained as (select s.*, s.impurity - (l.size * l.impurity + r.size * r.impurity) / s.size as gain
  from stat s left join stat l on s.split_on and l.node = s.node + 1
  left join stat r on s.split_on and r.node = s.node + 2)
select h.node::int as node, case when h.node = 0 then -1 else 2 * (h.j - (h.node % 2 = 0)::int) end::int as parent,
       case when g.split_on then 0 else -1 end::int as feature, case when g.split_on then g.j + 0.5 end::double as threshold,
       case when g.split_on then round(gain, 6) end as gain, {_NAME.format('k')} as class, n, n as n_rows
from held h join gained g on h.node = g.node""",
}
