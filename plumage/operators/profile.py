"""Data profiling: typed describe, stage counts, previews.

Each report is one aggregate pass with map-side partial aggregation, so its
cost is a scan plus a one-row (or few-row) merge, at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumage.functions.split import split_label
from plumage.operators.clean import drop_reason, select_profile, trust_predicate


def _stack(pairs: list[tuple[str, list[str]]], out_cols: list[str]) -> str:
    rows = ", ".join(f"'{name}', " + ", ".join(cols) for name, cols in pairs)
    return f"stack({len(pairs)}, {rows}) as ({', '.join(out_cols)})"


def describe_long(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Typed long-form ``describe()`` of numeric columns.

    One row per column: n (non-null count), mean, stddev (sample), min, max,
    all computed in a single aggregate and unpivoted with ``stack``.
    """
    numeric = ("int", "bigint", "smallint", "tinyint", "double", "float", "decimal")
    cols = cols or [c for c, t in df.dtypes if t.startswith(numeric)]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"sd{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    pairs = [(c, [f"n{i}", f"mean{i}", f"sd{i}", f"lo{i}", f"hi{i}"]) for i, c in enumerate(cols)]
    long = one.selectExpr(_stack(pairs, ["column_name", "n", "mean", "stddev", "min_value", "max_value"]))
    return long.select(
        "column_name", F.col("n").cast("long").alias("n"),
        *[F.round(c, digits).alias(c) for c in ("mean", "stddev", "min_value", "max_value")],
    )


def describe_strings(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Long-form describe of string columns, as ``describe()`` gives it: non-null count,
    mean and sample stddev of the cells that are numbers, min and max as text."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        number = x.try_cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(number).alias(f"mean{i}"),
                 F.stddev_samp(number).alias(f"sd{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    pairs = [(c, [f"n{i}", f"mean{i}", f"sd{i}", f"lo{i}", f"hi{i}"]) for i, c in enumerate(cols)]
    long = one.selectExpr(_stack(pairs, ["column_name", "n", "mean", "stddev", "min_value", "max_value"]))
    return long.select("column_name", F.col("n").cast("long").alias("n"), F.round("mean", digits).alias("mean"),
                       F.round("stddev", digits).alias("stddev"), "min_value", "max_value")


NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float", "decimal")


def _merged_moments(parts: Column) -> Column:
    """(n, mean, m2) of several (n, mean, m2): counts, means and squared deviations of parts add up exactly."""
    n = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a + p["n"])
    mean = F.aggregate(parts, F.lit(0.0), lambda a, p: a + F.when(p["n"] > 0, p["n"] * p["mean"]).otherwise(0.0)) / n
    m2 = F.aggregate(parts, F.lit(0.0), lambda a, p: a + F.when(
        p["n"] > 0, p["m2"] + p["n"] * (p["mean"] - mean) * (p["mean"] - mean)).otherwise(0.0))
    return F.struct(n.alias("n"), F.when(n > 0, mean).alias("mean"), m2.alias("m2"))


def describe_modes(scanned: DataFrame, cols: list[str], flag: str = "is_malformed", digits: int = 6) -> DataFrame:
    """``describe()`` of every row (mode ``permissive``) and of the rows without ``flag`` (``dropmalformed``).

    One scan: the rows are aggregated once by ``flag``, and the permissive mode
    is both parts merged. One row per mode and column: n (cells that are not
    NULL), mean and sample stddev of the numbers, min_number / max_number of
    numeric columns, min_text / max_text of the others.
    """
    kinds = dict(scanned.dtypes)
    numeric = [kinds[c].startswith(NUMERIC) for c in cols]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        number = x.cast("double") if numeric[i] else x.try_cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.struct(
            F.count(number).alias("n"), F.avg(number).alias("mean"),
            (F.var_pop(number) * F.count(number)).alias("m2")).alias(f"s{i}"),
            F.min(number if numeric[i] else x).alias(f"lo{i}"), F.max(number if numeric[i] else x).alias(f"hi{i}")]
    parts = scanned.groupBy(flag).agg(*aggs)  # at most two rows
    modes = F.when(F.col(flag), F.array(F.lit("permissive"))).otherwise(F.array(F.lit("permissive"), F.lit("dropmalformed")))
    merged = parts.withColumn("mode", F.explode(modes)).groupBy("mode").agg(*[x for i in range(len(cols)) for x in (
        F.sum(f"c{i}").alias(f"c{i}"), _merged_moments(F.collect_list(f"s{i}")).alias(f"s{i}"),
        F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"))])
    none = F.lit(None)
    rows = [F.struct(
        F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n"), F.round(f"s{i}.mean", digits).alias("mean"),
        F.when(F.col(f"s{i}.n") > 1, F.round(F.sqrt(F.col(f"s{i}.m2") / (F.col(f"s{i}.n") - 1)), digits)).alias("stddev"),
        (F.round(f"lo{i}", digits) if numeric[i] else none.cast("double")).alias("min_number"),
        (F.round(f"hi{i}", digits) if numeric[i] else none.cast("double")).alias("max_number"),
        (none.cast("string") if numeric[i] else F.col(f"lo{i}")).alias("min_text"),
        (none.cast("string") if numeric[i] else F.col(f"hi{i}")).alias("max_text")) for i, c in enumerate(cols)]
    return merged.select("mode", F.explode(F.array(*rows)).alias("r")).select("mode", "r.*")


STAGES = ("read", "filtered_train_form", "filtered_sweep_form", "dropped_null_label", "dropped_null_count", "train", "test")


def stage_flags(raw: DataFrame, key: str = "doc_id", train_fraction: float = 0.7, seed: int = 46) -> DataFrame:
    """The selected profile columns and, each worked out once, what the stage counts need of a row:
    ``_kept`` and ``_kept_sweep`` (the two filter forms), ``_why`` (drop reason of a kept row) and
    ``_part`` (split of a row that is trained or scored)."""
    p = select_profile(raw, (key,))
    # a NULL predicate is not kept
    flags = p.withColumns({"_kept": F.coalesce(trust_predicate("train"), F.lit(False)),
                           "_kept_sweep": F.coalesce(trust_predicate("sweep"), F.lit(False))})
    flags = flags.withColumn("_why", F.when(F.col("_kept"), drop_reason()))
    used = F.col("_kept") & F.col("_why").isNull()
    return flags.withColumn("_part", F.when(used, split_label(key, train_fraction, seed)))


def stage_aggregates() -> list[Column]:
    """Counts per stage over :func:`stage_flags`, in the order of STAGES."""
    tests = [F.lit(True), F.col("_kept"), F.col("_kept_sweep"), F.col("_why") == "null_label",
             F.col("_why") == "null_count", F.col("_part") == "train", F.col("_part") == "test"]
    return [F.count_if(test).alias(name) for name, test in zip(STAGES, tests)]


def stage_counts(raw: DataFrame, key: str = "doc_id", train_fraction: float = 0.7,
                 seed: int = 46) -> DataFrame:
    """Row counts at each stage of the training job, in one aggregate pass.

    read -> after the train-form filter -> after the sweep-form filter -> train-form
    rows dropped for a NULL label or a NULL count (a row with both counts as the
    first) -> the train and test parts of what is left (hash split on ``key``):
    the rows that are really trained and scored. A job that reads the rows anyway
    gets the same counts without this pass (``plans.jobs.observed_profiles``).
    """
    one = stage_flags(raw, key, train_fraction, seed).agg(*stage_aggregates())
    long = one.selectExpr(_stack([(n, [n]) for n in STAGES], ["stage", "n"]))
    return long.withColumn("n", F.col("n").cast("long"))


def preview(df: DataFrame, order_by: str = "doc_id", n: int = 10) -> DataFrame:
    """First ``n`` rows by ``order_by`` (a top-k: per-partition top n, then merge)."""
    return df.orderBy(order_by).limit(n)


def preview_steps(raw: DataFrame, form: str = "train", key: str = "doc_id", n: int = 10) -> DataFrame:
    """First ``n`` rows (by ``key``) after each cleaning step, one table.

    Steps: filtered -> colours converted -> text cleaned -> final projection.
    Colours are shown as text so the four steps share one schema.
    """
    from plumage.operators.clean import (
        clean_text, convert_colours, final_projection, select_profile, trust_filter)

    # the steps keep every row, so the first rows are taken once, before them
    filtered = preview(trust_filter(select_profile(raw, (key,)), form), key, n)
    converted = convert_colours(filtered)
    cleaned = clean_text(converted)
    final = final_projection(cleaned, (key,))

    def shape(df: DataFrame, step: str, raw_colours: bool) -> DataFrame:
        link = "link_color" if raw_colours else "link_color_indexed"
        side = "sidebar_color" if raw_colours else "sidebar_color_indexed"
        return df.select(
            F.lit(step).alias("step"), key, "gender", "description", "text", "tweet_count",
            F.col(link).cast("string").alias("link_color"),
            F.col(side).cast("string").alias("sidebar_color"))

    parts = [shape(filtered, "1_filtered", True), shape(converted, "2_colours", False),
             shape(cleaned, "3_text", False), shape(final, "4_final", False)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
