"""Query keys of SURVEY section 2: one Spark callable per key.

Each callable takes (spark, sf_dir) and returns a DataFrame with plain column
types (no vectors), every computed column aliased, doubles rounded to 6
places. The matching DuckDB SQL lives in :mod:`plumage.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import (
    HashingTF,
    IndexToString,
    Normalizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumage.functions.hex import hex_to_int
from plumage.functions.named import register_functions
from plumage.functions.split import split_label
from plumage.functions.text import normalize_text, remove_stop_words, tokenize
from plumage.operators import clean, features, profile, trees
from plumage.operators.evaluate import confusion_matrix, joint_confusion, label_name, metrics, positioned
from plumage.operators.models import decision_tree, random_forest, train, with_prediction
from plumage.operators.sweep import sweep
from plumage.plans import jobs, rules, staircase
from plumage.session import cut_lineage, scratch_path, spread
from plumage.sources import csv as csvsrc
from plumage.sources.headers import read_by_name
from plumage.sources.infer import read_inferred
from plumage.sources.tables import load_table, profiles

R = 6  # decimal places for doubles in results

CSV_COLUMNS = ["doc_id", "gender", "gender_gold", "gender:confidence", "tweet_count",
               "link_color", "sidebar_color", "description", "text"]
# quotes are doubled (RFC 4180) and blanks at the ends of cells kept
CSV_DIALECT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV_SCHEMA = ("doc_id bigint, gender string, gender_gold string, `gender:confidence` string, "
              "tweet_count string, link_color string, sidebar_color string, description string, text string")
LINE_SCHEMA = ("doc_id bigint, gender string, gender_gold string, `gender:confidence` double, "
               "tweet_count double, link_color string, sidebar_color string, description string, text string")
# a file with line breaks in cells is read whole by one task: files grow in number, not in size
FILE_RECORDS = 10_000
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(load_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")


def _rename_conf(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("gender:confidence", "gender_confidence")


# --- sources ---------------------------------------------------------------

def _profiles_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the whole profiles as a headed CSV under the shared folder: the long
    columns bring commas, quotes and line breaks within cells."""
    path = scratch_path(spark, "profiles-csv")
    profiles(spark, sf_dir).select(*[F.col(f"`{c}`") for c in CSV_COLUMNS]) \
        .write.options(header=True, **CSV_DIALECT).csv(path)
    return path


def q_csv_scan_permissive(spark, sf_dir):
    path = _profiles_csv(spark, sf_dir)
    return _rename_conf(csvsrc.read_csv(spark, path, CSV_SCHEMA, header=True, multi_line=True, **CSV_DIALECT))


def q_csv_infer_schema(spark, sf_dir):
    path = _profiles_csv(spark, sf_dir)
    df = read_inferred(spark, path, multi_line=True, **CSV_DIALECT)
    return _rename_conf(df.withColumn("doc_id", F.col("doc_id").cast("bigint")))


def q_csv_by_name(spark, sf_dir):
    """Files with the columns in two orders, read as one table by the names in their headers."""
    path = scratch_path(spark, "profiles-two-orders")
    p = profiles(spark, sf_dir)
    for part, names in enumerate((CSV_COLUMNS, CSV_COLUMNS[::-1])):
        p.where(F.col("doc_id") % 2 == part).select(*[F.col(f"`{c}`") for c in names]) \
            .write.mode("append").options(header=True, maxRecordsPerFile=FILE_RECORDS, **CSV_DIALECT).csv(path)
    return _rename_conf(read_by_name(spark, path, CSV_SCHEMA, multi_line=True, **CSV_DIALECT))


def _malformed_lines(spark: SparkSession, sf_dir: str) -> str:
    """The whole profiles as header-less CSV records, some of them malformed.

    Of every 20 ids, 0 has two cells only, 5 a cell too many and 10 a description
    with quotes that are not doubled; a tweet_count of 'n/a' does not cast.
    """
    path = scratch_path(spark, "profiles-lines")
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in CSV_COLUMNS]
    doubled = [F.replace(c, F.lit('"'), F.lit('""')) for c in cells]
    quoted = [F.when(c.rlike('[",\\r\\n]'), F.concat(F.lit('"'), d, F.lit('"'))).otherwise(c) for c, d in zip(cells, doubled)]
    kind = F.col("doc_id") % 20
    line = F.when(kind == 0, F.concat_ws(",", *quoted[:2])) \
        .when(kind == 5, F.concat_ws(",", *quoted, F.lit("extra"))) \
        .when(kind == 10, F.concat_ws(",", *quoted[:7], F.lit(BROKEN_CELL), quoted[8])) \
        .otherwise(F.concat_ws(",", *quoted))
    profiles(spark, sf_dir).select(line.alias("value")).write.text(path)
    return path


# quotes that are not doubled: the delimiter after the second one ends the cell
BROKEN_CELL = '"so "called, quoted" words"'


def _quarantined(spark, sf_dir):
    return csvsrc.scan_with_quarantine(spark, _malformed_lines(spark, sf_dir), LINE_SCHEMA, header=False,
                                       multi_line=True, **CSV_DIALECT)


def q_csv_scan_dropmalformed(spark, sf_dir):
    return _rename_conf(csvsrc.good_rows(_quarantined(spark, sf_dir)))


def q_malformed_report(spark, sf_dir):
    return csvsrc.malformed_report(_quarantined(spark, sf_dir))


def q_malformed_reasons(spark, sf_dir):
    return csvsrc.malformed_reasons(_quarantined(spark, sf_dir), LINE_SCHEMA)


def q_describe_csv_modes(spark, sf_dir):
    """The profile program's two summaries of one file: every row as a
    permissive read sees it (bad cells NULL), and only the well-formed rows."""
    return profile.describe_modes(_quarantined(spark, sf_dir), CSV_COLUMNS, digits=3)


# --- profiling -------------------------------------------------------------

def q_describe_profile(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINEITEM_NUMERIC]
    return profile.describe_long(li, cols, R)


def q_describe_strings(spark, sf_dir):
    cols = ["gender", "gender_gold", "gender:confidence", "tweet_count", "link_color",
            "sidebar_color", "description", "text"]
    return profile.describe_strings(profiles(spark, sf_dir), cols)


def q_stage_counts(spark, sf_dir):
    return profile.stage_counts(profiles(spark, sf_dir))


def q_observed_stage_counts(spark, sf_dir):
    """The same counts from the training job's own first pass over the rows."""
    clean_rows, seen = jobs.observed_profiles(profiles(spark, sf_dir))
    jobs.build_features(clean_rows)
    return jobs.observed_counts(spark, seen)


def q_preview_top10(spark, sf_dir):
    """The ten rows are taken before the per-row cleaning, which keeps every row."""
    kept = clean.trust_filter(clean.select_profile(profiles(spark, sf_dir)), "train")
    return clean.final_projection(clean.clean_text(clean.convert_colours(profile.preview(kept, "doc_id", 10))))


# --- projections, filters, scalar functions --------------------------------

def q_preview_steps(spark, sf_dir):
    return profile.preview_steps(profiles(spark, sf_dir), "train")


def q_project_cast_alias(spark, sf_dir):
    return clean.select_profile(profiles(spark, sf_dir))


def q_filter_label_train(spark, sf_dir):
    return clean.trust_filter(clean.select_profile(profiles(spark, sf_dir)), "train", drop=False)


def q_filter_label_sweep(spark, sf_dir):
    return clean.trust_filter(clean.select_profile(profiles(spark, sf_dir)), "sweep", drop=False)


# Fixed value: the train-form filter as the reference writes it, as SQL text.
TRUST_SQL = ("((gender in ('male','female','brand') and gender_confidence = 1.0) or gender_gold in ('male','female','brand'))"
             " and description is not null")


def q_filter_sql_text(spark, sf_dir):
    return clean.trust_filter(clean.select_profile(profiles(spark, sf_dir)), TRUST_SQL, drop=False)


def q_drop_columns(spark, sf_dir):
    return clean.trust_filter(clean.select_profile(profiles(spark, sf_dir)), "train", drop=True)


def q_hex_to_int(spark, sf_dir):
    p = profiles(spark, sf_dir)
    return p.select("doc_id", "link_color", hex_to_int("link_color").alias("link_color_indexed"),
                    "sidebar_color", hex_to_int("sidebar_color").alias("sidebar_color_indexed"))


def q_call_by_name(spark, sf_dir):
    """The colour function called by its name, from SQL text and from the DataFrame API."""
    register_functions(spark)
    p = spark.sql("select doc_id, link_color, sidebar_color, toInteger(link_color) as link_color_indexed from {p}",
                  p=profiles(spark, sf_dir))
    return p.withColumn("sidebar_color_indexed", F.call_function("toInteger", "sidebar_color"))


def part_hex(spark, sf_dir) -> DataFrame:
    """Hex strings of varied length and sign derived from part keys."""
    part = load_table(spark, sf_dir, "part").select("p_partkey")
    digits = F.expr("substr(md5(cast(p_partkey as string)), 1, 1 + cast(p_partkey % 12 as int))")
    sign = F.when(F.col("p_partkey") % 3 == 0, F.lit("-")).when(F.col("p_partkey") % 3 == 1, F.lit("+")) \
        .otherwise(F.lit(""))
    return part.select("p_partkey", F.concat(sign, digits).alias("hex"))


def q_hex_to_int_part(spark, sf_dir):
    return part_hex(spark, sf_dir).withColumn("value", hex_to_int("hex"))


def q_normalize_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", normalize_text("text").alias("text_clean"))


def _tokens(spark, sf_dir) -> DataFrame:
    """Tokens as a native expression: same arrays as ml.feature.Tokenizer
    (asserted in tests) but inside whole-stage codegen, no ScalaUDF."""
    return _docs(spark, sf_dir).select("doc_id", tokenize(normalize_text("text")).alias("words"))


def q_tokenize(spark, sf_dir):
    return _tokens(spark, sf_dir).select("doc_id", F.posexplode("words").alias("pos", "token"))


def q_remove_stop_words(spark, sf_dir):
    kept = _tokens(spark, sf_dir).select("doc_id", remove_stop_words("words").alias("removed"))
    return kept.select("doc_id", F.posexplode("removed").alias("pos", "token"))


def _ml_removed(spark, sf_dir) -> DataFrame:
    """The pipeline's ML stages (Tokenizer, StopWordsRemover), as HashingTF input."""
    d = _docs(spark, sf_dir).select("doc_id", normalize_text("text").alias("text"))
    words = Tokenizer(inputCol="text", outputCol="words").transform(d)
    return StopWordsRemover(inputCol="words", outputCol="removed").transform(words)


def q_term_frequency(spark, sf_dir):
    return features.term_frequency(_docs(spark, sf_dir))


def q_hashing_tf(spark, sf_dir):
    tf = HashingTF(numFeatures=features.NUM_FEATURES, inputCol="removed", outputCol="tf") \
        .transform(_ml_removed(spark, sf_dir))
    return features.explode_vector(tf, "tf", ["doc_id"]).toDF("doc_id", "bucket", "tf")


def _idf(spark, sf_dir, materialize: bool):
    """TF and IDF tables. With ``materialize`` the TF table (read twice: for
    document frequencies and for the join) is written once to the shared
    checkpoint folder, so text is tokenised once. Texts are dealt by their key
    before they become terms: the terms of a document then meet without a
    shuffle of their own, which would move several times the bytes."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    tf = features.term_frequency(docs)
    if materialize:
        tf = cut_lineage(tf, "term-frequency")
    n_docs = features.corpus_size(load_table(spark, sf_dir, "documents"))
    return tf, features.inverse_document_frequency(tf, n_docs)


def q_idf(spark, sf_dir):
    _, idf = _idf(spark, sf_dir, materialize=False)
    return idf.withColumn("idf", F.round("idf", R))


def q_tfidf(spark, sf_dir):
    tf, idf = _idf(spark, sf_dir, materialize=True)
    return features.tfidf(tf, cut_lineage(idf, "idf")).withColumns({"idf": F.round("idf", R), "tfidf": F.round("tfidf", R)})


def q_assemble_features(spark, sf_dir):
    c = clean.prepare(profiles(spark, sf_dir), "sweep")
    va = VectorAssembler(inputCols=list(features.NUMERIC_INPUTS), outputCol="v", handleInvalid="skip")
    return va.transform(c).select("doc_id", F.posexplode(vector_to_array("v")).alias("pos", "value"))


def _lineitem_scaled(spark, sf_dir, normalize: bool) -> DataFrame:
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINEITEM_NUMERIC)
    li = spread(li, "l_orderkey", "l_linenumber")  # vector stages are per-row work: use every core
    v = VectorAssembler(inputCols=LINEITEM_NUMERIC, outputCol="v").transform(li)
    s = StandardScaler(inputCol="v", outputCol="s", withMean=False, withStd=True).fit(v).transform(v)
    out = "s"
    if normalize:
        s = Normalizer(inputCol="s", outputCol="n", p=2.0).transform(s)
        out = "n"
    arr = vector_to_array(out)
    return s.select("l_orderkey", "l_linenumber",
                    *[F.round(arr[i], R).alias(f"{c}_out") for i, c in enumerate(LINEITEM_NUMERIC)])


def q_standard_scale(spark, sf_dir):
    return _lineitem_scaled(spark, sf_dir, normalize=False)


def q_l2_normalize(spark, sf_dir):
    return _lineitem_scaled(spark, sf_dir, normalize=True)


def q_string_indexer(spark, sf_dir):
    d = load_table(spark, sf_dir, "documents").select("lang")
    idx = StringIndexer(inputCol="lang", outputCol="label_index").fit(d).transform(d)
    return idx.groupBy(F.col("lang").alias("label"), "label_index") \
        .agg(F.count(F.lit(1)).cast("long").alias("n"))


def q_index_to_string(spark, sf_dir):
    d = load_table(spark, sf_dir, "documents").select("doc_id", "lang")
    model = StringIndexer(inputCol="lang", outputCol="lang_index").fit(d)
    back = IndexToString(inputCol="lang_index", outputCol="lang_roundtrip", labels=model.labels)
    return back.transform(model.transform(d)).select("doc_id", "lang", "lang_index", "lang_roundtrip")


def _customers(spark, sf_dir) -> DataFrame:
    """Orders with their customer as the label: as many labels as customers."""
    orders = load_table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.format_string("customer %d", "o_custkey").alias("label"))


def q_label_ranks(spark, sf_dir):
    return features.label_index_twin(_customers(spark, sf_dir), "label")


def q_label_round_trip(spark, sf_dir):
    rows = _customers(spark, sf_dir)
    table = cut_lineage(features.label_index_twin(rows, "label"), "labels")
    return features.name_labels(features.index_labels(rows, "label", table), "label_index", table, "label", "label_again")


def q_hash_split(spark, sf_dir):
    d = load_table(spark, sf_dir, "documents").select("doc_id")
    return d.select("doc_id", split_label("doc_id", 0.7, 46).alias("split"))


# --- pipeline, models, evaluation ------------------------------------------

def q_feature_pipeline(spark, sf_dir):
    """Rows kept by the pipeline with their label index, vector width and norm."""
    fs = jobs.build_features(jobs.cleaned_profiles(spark, sf_dir, "train"))
    out = features.vector_summary(fs.features).drop("n_active")
    return out.withColumn("l2_norm", F.round("l2_norm", R))


def _single_model(spark, sf_dir, name):
    fs = jobs.build_features(jobs.cleaned_profiles(spark, sf_dir, "train"))
    est = decision_tree() if name == "decision_tree" else random_forest()
    scored = with_prediction(fs.features, train(fs.features, est), name)
    return scored.select("doc_id", "split", "gender", F.col(f"pred_{name}").alias("prediction"),
                         label_name(fs.labels, f"pred_{name}").alias("predicted_gender"))


def q_feature_pipeline_values(spark, sf_dir):
    """Every non-zero value of every finished feature vector."""
    fs = jobs.build_features(jobs.cleaned_profiles(spark, sf_dir, "train"))
    return features.explode_vector(fs.features, features.FEATURES, ["doc_id"]).withColumn("value", F.round("value", R))


def q_dropped_rows(spark, sf_dir):
    """Filtered rows that are not trained on, with the reason."""
    return jobs.dropped(jobs.clean_raw(profiles(spark, sf_dir), "train"))


def q_decision_tree(spark, sf_dir):
    return _single_model(spark, sf_dir, "decision_tree")


def q_random_forest(spark, sf_dir):
    return _single_model(spark, sf_dir, "random_forest")


def q_train_evaluate(spark, sf_dir):
    return jobs.train_evaluate(spark, sf_dir).matrix


def q_compare_models(spark, sf_dir):
    return jobs.train_evaluate(spark, sf_dir).metrics


def q_model_node_checks(spark, sf_dir):
    """Nodes of the flagship's models that contradict their counts, per tree; of the
    tree also those whose counts differ from the training rows that pass them, and the
    cells of the scored training matrix that differ from its leaves' counts (forest: -1,
    its trees have random samples of their own)."""
    fs = jobs.build_features(jobs.cleaned_profiles(spark, sf_dir, "train"))
    models = jobs.fit_models(fs)
    scored = jobs.evaluate(fs, models).confusion.where("split = 'train' and model = 'decision_tree'").groupBy(
        F.col("gender_indexed").alias("label"), "prediction").agg(F.sum("n").alias("n_scored"))
    parts = []
    for name, model in models.items():
        nodes = cut_lineage(trees.node_table(model), "nodes")
        wrong = cells = F.lit(-1).cast("long")
        if name == "decision_tree":
            again = trees.recount(model, fs.features.where("split = 'train'"))
            both = trees.node_counts(nodes).join(again.withColumnRenamed("n", "n_rows"), ["node", "label"], "full")
            wrong = both.where("n is distinct from n_rows").agg(F.count(F.lit(1))).scalar()
            leaves = trees.node_counts(nodes).join(nodes.where("left is null").select("node", "prediction"), "node")
            matrix = leaves.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
            cells = matrix.join(scored, ["label", "prediction"], "full").where("n is distinct from n_scored").agg(
                F.count(F.lit(1))).scalar()
        parts.append(trees.node_checks(nodes).select(
            F.lit(name).alias("model"), "tree", "bad_counts", "bad_gain", "bad_prediction", wrong.alias("bad_recount"), cells.alias("bad_cells")))
    return parts[0].unionByName(parts[1])


def _gold_vs_crowd(spark, sf_dir):
    """Agreement of the gold label with the crowd label, as predictions.

    Both columns are indexed with the label list fitted on ``gender``; the
    evaluation operators then run unchanged on (label, prediction).
    """
    p = clean.select_profile(profiles(spark, sf_dir)).where(
        F.col("gender").isin(*clean.LABELS) & F.col("gender_gold").isin(*clean.LABELS))
    model = StringIndexer(inputCol="gender", outputCol="gender_indexed").fit(p)
    gold = model.copy()
    gold.setInputCol("gender_gold").setOutputCol("pred_gold").setHandleInvalid("keep")
    scored = gold.transform(model.transform(p))
    conf = joint_confusion(scored, ["gold"], by=())
    return conf, list(model.labels)


def q_confusion_matrix(spark, sf_dir):
    conf, labels = _gold_vs_crowd(spark, sf_dir)
    return positioned(confusion_matrix(conf, labels, by=()), "gender", "predicted_gender")


def q_eval_metrics(spark, sf_dir):
    conf, _ = _gold_vs_crowd(spark, sf_dir)
    return metrics(conf, label="gender_indexed", by=())


def _sweep(spark, sf_dir, algorithm):
    fs = jobs.build_features(jobs.cleaned_profiles(spark, sf_dir, "sweep"))
    return sweep(fs.features, algorithm)


def q_sweep_decision_tree(spark, sf_dir):
    return _sweep(spark, sf_dir, "tree")


def q_sweep_random_forest(spark, sf_dir):
    return _sweep(spark, sf_dir, "forest")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_scan_permissive": q_csv_scan_permissive,
    "csv_infer_schema": q_csv_infer_schema,
    "csv_by_name": q_csv_by_name,
    "csv_scan_dropmalformed": q_csv_scan_dropmalformed,
    "malformed_report": q_malformed_report,
    "malformed_reasons": q_malformed_reasons,
    "describe_csv_modes": q_describe_csv_modes,
    "describe_profile": q_describe_profile,
    "describe_strings": q_describe_strings,
    "stage_counts": q_stage_counts,
    "observed_stage_counts": q_observed_stage_counts,
    "preview_top10": q_preview_top10,
    "preview_steps": q_preview_steps,
    "project_cast_alias": q_project_cast_alias,
    "filter_label_train": q_filter_label_train,
    "filter_label_sweep": q_filter_label_sweep,
    "filter_sql_text": q_filter_sql_text,
    "drop_columns": q_drop_columns,
    "hex_to_int": q_hex_to_int,
    "call_by_name": q_call_by_name,
    "hex_to_int_part": q_hex_to_int_part,
    "normalize_text": q_normalize_text,
    "tokenize": q_tokenize,
    "remove_stop_words": q_remove_stop_words,
    "term_frequency": q_term_frequency,
    "hashing_tf": q_hashing_tf,
    "idf": q_idf,
    "tfidf": q_tfidf,
    "assemble_features": q_assemble_features,
    "standard_scale": q_standard_scale,
    "l2_normalize": q_l2_normalize,
    "string_indexer": q_string_indexer,
    "index_to_string": q_index_to_string,
    "label_ranks": q_label_ranks,
    "label_round_trip": q_label_round_trip,
    "hash_split": q_hash_split,
    "feature_pipeline": q_feature_pipeline,
    "feature_pipeline_values": q_feature_pipeline_values,
    "dropped_rows": q_dropped_rows,
    "decision_tree": q_decision_tree,
    "random_forest": q_random_forest,
    "model_node_checks": q_model_node_checks,
    "train_evaluate": q_train_evaluate,
    "compare_models": q_compare_models,
    "confusion_matrix": q_confusion_matrix,
    "eval_metrics": q_eval_metrics,
    "sweep_decision_tree": q_sweep_decision_tree,
    "sweep_random_forest": q_sweep_random_forest,
    **rules.QUERIES,
    **staircase.QUERIES,
}
