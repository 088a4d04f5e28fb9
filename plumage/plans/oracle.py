"""DuckDB SQL for each query key that plain SQL can express.

Keys whose result depends on a model trained on profiles (decision_tree,
random_forest, train_evaluate, compare_models, the sweeps) have no entry: their
rows are checked on counts and invariants. The same jobs on labels made by a
rule (:mod:`plumage.plans.rules`, :mod:`plumage.plans.staircase`) have one.
"""

from __future__ import annotations

from plumage.functions.hex import hex_to_int_sql
from plumage.functions.split import split_label_sql
from plumage.functions.text import ENGLISH_STOP_WORDS, sql_string_list
from plumage.plans.rules import ORACLE as RULE_ORACLE
from plumage.plans.staircase import ORACLE as STAIR_ORACLE
from plumage.sources.tables import PROFILES_DUCKDB_SQL

LABELS = "('male','female','brand')"
TRAIN = (f"((gender in {LABELS} and gender_confidence = 1.0) or gender_gold in {LABELS})"
         " and description is not null")
SWEEP = (f"gender in {LABELS} and (gender_gold in {LABELS} or gender_confidence = 1.0)"
         " and text is not null and description is not null")

USABLE = "gender is not null and tweet_count is not null"


def norm(expr: str) -> str:
    return rf"lower(regexp_replace({expr}, '[\W]', ' ', 'g'))"


PROFILES = f"p as ({PROFILES_DUCKDB_SQL})"
SEL = PROFILES + """,
sel as (select doc_id, gender, description, link_color, sidebar_color, text,
        try_cast(tweet_count as double) as tweet_count, gender_gold,
        try_cast("gender:confidence" as double) as gender_confidence from p)"""


def cleaned(form: str) -> str:
    pred = TRAIN if form == "train" else SWEEP
    return SEL + f""",
cleaned as (select doc_id, gender, {norm('description')} as description,
        {hex_to_int_sql('link_color')} as link_color_indexed,
        {hex_to_int_sql('sidebar_color')} as sidebar_color_indexed,
        {norm('text')} as text, tweet_count from sel where {pred})"""


TOKENS = f"""n as (select doc_id, {norm('text')} as t from documents),
k as (select doc_id, case when t = '' then ['']
                          when rtrim(t, ' ') = '' then []::varchar[]
                          else string_split(rtrim(t, ' '), ' ') end as toks from n),
r as (select doc_id, list_filter(toks, lambda x: not list_contains([{sql_string_list(ENGLISH_STOP_WORDS)}], x)) as toks from k),
tf as (select doc_id, term, count(*)::bigint as tf
       from (select doc_id, unnest(toks) as term from r) group by doc_id, term),
nd as (select count(*) as n_docs from documents),
idf as (select term, count(*)::bigint as df,
               ln(((select n_docs from nd) + 1.0) / (count(*) + 1.0)) as idf
        from tf group by term)"""


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def describe_profile() -> str:
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _union([
        f"select '{c}' as column_name, count({c})::bigint as n, round(avg({c}::double), 6) as mean, "
        f"round(stddev_samp({c}::double), 6) as stddev, round(min({c}::double), 6) as min_value, "
        f"round(max({c}::double), 6) as max_value from lineitem" for c in cols])


def describe_strings() -> str:
    cols = ["gender", "gender_gold", "gender:confidence", "tweet_count", "link_color",
            "sidebar_color", "description", "text"]
    return f"with {PROFILES}\n" + _union([
        f"""select '{c}' as column_name, count("{c}")::bigint as n, round(avg(try_cast("{c}" as double)), 6) as mean, """
        f"""round(stddev_samp(try_cast("{c}" as double)), 6) as stddev, min("{c}") as min_value, """
        f"""max("{c}") as max_value from p""" for c in cols])


def stage_counts() -> str:
    split = split_label_sql("doc_id")
    return f"with {SEL}\n" + _union([
        "select 'read' as stage, count(*)::bigint as n from sel",
        f"select 'filtered_train_form', count(*)::bigint from sel where {TRAIN}",
        f"select 'filtered_sweep_form', count(*)::bigint from sel where {SWEEP}",
        f"select 'dropped_null_label', count(*)::bigint from sel where {TRAIN} and gender is null",
        f"select 'dropped_null_count', count(*)::bigint from sel where {TRAIN} and gender is not null and tweet_count is null",
        f"select 'train', count(*)::bigint from sel where {TRAIN} and {USABLE} and {split} = 'train'",
        f"select 'test', count(*)::bigint from sel where {TRAIN} and {USABLE} and {split} = 'test'",
    ])


# of every 20 ids, 0 is cut to two cells, 5 has a cell too many, 10 quotes that are not doubled
GOOD_LINE = "kind not in (0, 5, 10) and tweet_count is not null"
LINE_COLUMNS = ["doc_id", "gender", "gender_gold", "gender:confidence", "tweet_count", "link_color", "sidebar_color",
                "description", "text"]
_LATER = "case when kind <> 0 then {} end"
LINES = f"""{PROFILES},
perm as (select doc_id, kind, nullif(gender, '') as gender, {_LATER.format("nullif(gender_gold, '')")} as gender_gold,
    {_LATER.format('try_cast("gender:confidence" as double)')} as "gender:confidence",
    {_LATER.format("try_cast(tweet_count as double)")} as tweet_count,
    {_LATER.format("nullif(link_color, '')")} as link_color, {_LATER.format("nullif(sidebar_color, '')")} as sidebar_color,
    case kind when 0 then null when 10 then '"so "called' else nullif(description, '') end as description,
    case kind when 0 then null when 10 then ' quoted" words"' else nullif(text, '') end as text
  from (select *, doc_id % 20 as kind from p))"""


def describe_csv_modes() -> str:
    parts = []
    for mode, where in (("permissive", ""), ("dropmalformed", f" where {GOOD_LINE}")):
        for c in LINE_COLUMNS:
            number = c in ("doc_id", "gender:confidence", "tweet_count")
            x = f'"{c}"::double' if number else f'try_cast("{c}" as double)'
            ends = [f"round({f}({x}), 3)" if number else "null::double" for f in ("min", "max")]
            ends += ["null::varchar" if number else f'{f}("{c}")' for f in ("min", "max")]
            parts.append(
                f"""select '{mode}' as mode, '{c}' as column_name, count("{c}")::bigint as n, round(avg({x}), 3) as mean, """
                f"round(stddev_samp({x}), 3) as stddev, {ends[0]} as min_number, {ends[1]} as max_number, "
                f"{ends[2]} as min_text, {ends[3]} as max_text from perm{where}")
    return f"with {LINES}\n" + _union(parts)


def preview_steps() -> str:
    link, side = hex_to_int_sql("link_color"), hex_to_int_sql("sidebar_color")
    steps = [
        ("1_filtered", "description", "text", "link_color", "sidebar_color"),
        ("2_colours", "description", "text", f"cast({link} as varchar)", f"cast({side} as varchar)"),
        ("3_text", norm("description"), norm("text"), f"cast({link} as varchar)", f"cast({side} as varchar)"),
        ("4_final", norm("description"), norm("text"), f"cast({link} as varchar)", f"cast({side} as varchar)"),
    ]
    parts = [f"""select * from (select '{st}' as step, doc_id, gender, {d} as description, {t} as text,
        tweet_count, {lc} as link_color, {sc} as sidebar_color
        from sel where {TRAIN} order by doc_id limit 10)""" for st, d, t, lc, sc in steps]
    return f"with {SEL}\n" + _union(parts)


GOLD = SEL + f""",
s as (select gender, gender_gold from sel where gender in {LABELS} and gender_gold in {LABELS}),
c as (select gender as l, gender_gold as p, count(*) as n from s group by 1, 2)"""


def eval_metrics() -> str:
    return "with " + GOLD + """,
a as (select l, sum(n) as actual from c group by l),
pr as (select p, sum(n) as predicted from c group by p),
t as (select sum(n) as total from c),
d as (select c.n, a.actual, pr.predicted, (select total from t) as total
      from c join a on c.l = a.l join pr on c.p = pr.p where c.l = c.p),
m as (select sum(n) / max(total) as accuracy,
             sum(actual / total * (n / predicted)) as weighted_precision,
             sum(actual / total * (n / actual)) as weighted_recall,
             sum(actual / total * 2 * (n / predicted) * (n / actual)
                 / ((n / predicted) + (n / actual))) as f1 from d)
select round(accuracy, 6) as accuracy, round(weighted_precision, 6) as weighted_precision,
       round(weighted_recall, 6) as weighted_recall, round(f1, 6) as f1, floor(accuracy * 100 + 0.5)::bigint as accuracy_pct,
       floor(weighted_precision * 100 + 0.5)::bigint as weighted_precision_pct,
       floor(weighted_recall * 100 + 0.5)::bigint as weighted_recall_pct,
       floor(f1 * 100 + 0.5)::bigint as f1_pct from m"""


def _lineitem_scaled(normalize: bool) -> str:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    sds = ", ".join(f"stddev_samp({c}) as sd_{i}" for i, c in enumerate(cols))
    scaled = ", ".join(f"case when (select sd_{i} from sd) <> 0 then {c} / (select sd_{i} from sd)"
                       f" else 0.0 end as s_{i}" for i, c in enumerate(cols))
    base = (f"with sd as (select {sds} from lineitem),\n"
            f"sc as (select l_orderkey, l_linenumber, {scaled} from lineitem)")
    if not normalize:
        outs = ", ".join(f"round(s_{i}, 6) as {c}_out" for i, c in enumerate(cols))
        return f"{base}\nselect l_orderkey, l_linenumber, {outs} from sc"
    nrm = "sqrt(" + " + ".join(f"s_{i} * s_{i}" for i in range(len(cols))) + ")"
    outs = ", ".join(f"round(case when nrm <> 0 then s_{i} / nrm else s_{i} end, 6) as {c}_out"
                     for i, c in enumerate(cols))
    return f"{base},\nnn as (select *, {nrm} as nrm from sc)\nselect l_orderkey, l_linenumber, {outs} from nn"


RANKED = """ranked as (select lang as label, count(*)::bigint as n,
                  (row_number() over (order by count(*) desc, lang) - 1)::double as label_index
           from documents group by lang)"""


CUSTOMERS = """o as (select o_orderkey, 'customer ' || o_custkey as label from orders),
labels as (select label, count(*)::bigint as n, (row_number() over (order by count(*) desc, label) - 1)::double as label_index
           from o group by label)"""


# --- Spark's HashingTF bucket in SQL -----------------------------------------
# HashingTF maps a term to nonNegativeMod(murmur3_x86_32(utf8(term), seed=42),
# numFeatures). After normalisation every term is ASCII, so its bytes are the
# character codes. The hash is built from 32-bit modular steps in HUGEINT.

_M = "4294967296"  # 2^32


def _mod32(x: str) -> str:
    return f"(({x}) % {_M})"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) * {2 ** r}) % {_M} + (({x}) // {2 ** (32 - r)}))"


def _scramble(k: str) -> str:
    # MurmurHash3 x86_32 constants c1, c2.
    return _mod32(f"({_rotl(_mod32(f'({k})::HUGEINT * 3432918353'), 15)}) * 461845907")


def _mix(h: str, k: str) -> str:
    return _mod32(f"({_rotl(f'xor(({h})::HUGEINT, ({_scramble(k)})::HUGEINT)', 13)}) * 5 + 3864292196")


def _byte(t: str, pos: str) -> str:
    return f"ascii(substr({t}, ({pos}) + 1, 1))::HUGEINT"


def _let(value: str, body: str) -> str:
    """Bind ``value`` to ``a`` once (a one-element list transform)."""
    return f"list_transform([{value}], lambda a: {body})[1]"


def hashing_tf_bucket_sql(t: str, num_features: int = 1000, seed: int = 42) -> str:
    blocks = (f"list_transform(range(0, length({t}) // 4), lambda j: "
              f"{_byte(t, '4 * j')} + {_byte(t, '4 * j + 1')} * 256 + "
              f"{_byte(t, '4 * j + 2')} * 65536 + {_byte(t, '4 * j + 3')} * 16777216)")
    h = f"list_reduce({blocks}, lambda h, k: {_mix('h', 'k')}, {seed}::HUGEINT)"
    start = f"(length({t}) // 4) * 4"
    tail = (f"(case when length({t}) % 4 >= 1 then {_byte(t, start)} else 0 end"
            f" + case when length({t}) % 4 >= 2 then {_byte(t, start + ' + 1')} * 256 else 0 end"
            f" + case when length({t}) % 4 >= 3 then {_byte(t, start + ' + 2')} * 65536 else 0 end)")
    h = (f"(case when length({t}) % 4 > 0 then xor(({h})::HUGEINT, ({_scramble(tail)})::HUGEINT)"
         f" else ({h})::HUGEINT end)")
    h = f"xor({h}, length({t})::HUGEINT)"
    # MurmurHash3 finaliser constants.
    for body in ("xor(a, a // 65536)", f"(a * 2246822507) % {_M}", "xor(a, a // 8192)",
                 f"(a * 3266489909) % {_M}", "xor(a, a // 65536)"):
        h = _let(h, body)
    signed = _let(h, "case when a >= 2147483648 then a - 4294967296 else a end")
    return f"(((({signed}) % {num_features}) + {num_features}) % {num_features})::INTEGER"


def feature_pipeline_values() -> str:
    """The 2,003-wide vectors rebuilt: counts per bucket, IDF, sample deviation, norm."""
    tokens = _union([f"""select doc_id, {base} as base, case when t = '' then ['']
            when rtrim(t, ' ') = '' then []::varchar[] else string_split(rtrim(t, ' '), ' ') end as toks
            from (select doc_id, coalesce({col}, '') as t from u)""" for base, col in ((3, "text"), (1003, "description"))])
    return f"""with {cleaned('train')},
u as (select * from cleaned where {USABLE}),
nd as (select count(*)::double as n from u),
k as ({tokens}),
e as (select doc_id, base, unnest(list_filter(toks, lambda x: not list_contains([{sql_string_list(ENGLISH_STOP_WORDS)}], x))) as term from k),
b as (select term, {hashing_tf_bucket_sql('term')} as bucket from (select distinct term from e)),
tf as (select doc_id, base + bucket as pos, count(*)::double as tf from e join b using (term) group by all),
idf as (select pos, ln(((select n from nd) + 1) / (count(*) + 1)) as idf from tf group by pos),
x as (select doc_id, pos, tf * idf as x from tf join idf using (pos)
      union all select doc_id, 0, link_color_indexed::double from u
      union all select doc_id, 1, tweet_count from u
      union all select doc_id, 2, sidebar_color_indexed::double from u),
m as (select pos, sum(x) / (select n from nd) as mean from x group by pos),
sd as (select pos, sqrt((sum((x - mean) ** 2) + ((select n from nd) - count(*)) * any_value(mean) ** 2)
                        / ((select n from nd) - 1)) as sd from x join m using (pos) group by pos),
s as (select doc_id, pos, x / sd as s from x join sd using (pos) where sd > 0 and x <> 0),
l as (select doc_id, sqrt(sum(s * s)) as norm from s group by doc_id)
select doc_id, pos::integer as pos, round(s / norm, 6) as value from s join l using (doc_id)"""


ORACLE: dict[str, str] = {
    # Spark's CSV reader maps an empty cell, quoted or not, to NULL (default
    # nullValue ""), so an empty string does not survive the round trip.
    "csv_scan_permissive": f"""with {PROFILES}
select doc_id, gender, gender_gold, "gender:confidence" as gender_confidence, tweet_count,
       nullif(link_color, '') as link_color, sidebar_color, nullif(description, '') as description,
       nullif(text, '') as text from p""",
    "csv_by_name": f"""with {PROFILES}
select doc_id, gender, gender_gold, "gender:confidence" as gender_confidence, tweet_count,
       nullif(link_color, '') as link_color, sidebar_color, nullif(description, '') as description,
       nullif(text, '') as text from p""",
    "csv_infer_schema": f"""with {PROFILES}
select doc_id, gender, gender_gold, try_cast("gender:confidence" as double) as gender_confidence,
       tweet_count, nullif(link_color, '') as link_color, sidebar_color, nullif(description, '') as description,
       nullif(text, '') as text from p""",
    "csv_scan_dropmalformed": f"""with {LINES}
select * exclude (kind, "gender:confidence"), "gender:confidence" as gender_confidence from perm where {GOOD_LINE}""",
    "malformed_report": f"""with {LINES}
select count(*)::bigint as rows_read,
       sum(case when {GOOD_LINE} then 1 else 0 end)::bigint as rows_good,
       sum(case when {GOOD_LINE} then 0 else 1 end)::bigint as rows_malformed from perm""",
    "malformed_reasons": f"""with {LINES},
r as (select case kind when 0 then 'too_short' when 5 then 'too_long' when 10 then 'broken_quote' else 'bad_cell' end as reason
      from perm where not ({GOOD_LINE}))
select reason, case when reason = 'bad_cell' then 'tweet_count' end as column, count(*)::bigint as n from r group by all""",
    "describe_csv_modes": describe_csv_modes(),
    "describe_profile": describe_profile(),
    "describe_strings": describe_strings(),
    "stage_counts": stage_counts(),
    "observed_stage_counts": stage_counts(),
    "preview_top10": f"with {cleaned('train')}\nselect * from cleaned order by doc_id limit 10",
    "preview_steps": preview_steps(),
    "project_cast_alias": f"with {SEL}\nselect * from sel",
    "filter_label_train": f"with {SEL}\nselect * from sel where {TRAIN}",
    "filter_sql_text": f"with {SEL}\nselect * from sel where {TRAIN}",
    "filter_label_sweep": f"with {SEL}\nselect * from sel where {SWEEP}",
    "drop_columns": f"""with {SEL}
select doc_id, gender, description, link_color, sidebar_color, text, tweet_count from sel where {TRAIN}""",
    "hex_to_int": f"""with {PROFILES}
select doc_id, link_color, {hex_to_int_sql('link_color')} as link_color_indexed,
       sidebar_color, {hex_to_int_sql('sidebar_color')} as sidebar_color_indexed from p""",
    "call_by_name": f"""with {PROFILES}
select doc_id, link_color, {hex_to_int_sql('link_color')} as link_color_indexed,
       sidebar_color, {hex_to_int_sql('sidebar_color')} as sidebar_color_indexed from p""",
    "hex_to_int_part": f"""with h as (
  select p_partkey, (case p_partkey % 3 when 0 then '-' when 1 then '+' else '' end)
         || substr(md5(cast(p_partkey as varchar)), 1, 1 + cast(p_partkey % 12 as integer)) as hex
  from part)
select p_partkey, hex, {hex_to_int_sql('hex')} as value from h""",
    "normalize_text": f"select doc_id, {norm('text')} as text_clean from documents",
    "tokenize": f"""with {TOKENS}
select doc_id, unnest(generate_series(0, len(toks) - 1))::integer as pos, unnest(toks) as token from k""",
    "remove_stop_words": f"""with {TOKENS}
select doc_id, unnest(generate_series(0, len(toks) - 1))::integer as pos, unnest(toks) as token from r""",
    "term_frequency": f"with {TOKENS}\nselect doc_id, term, tf from tf",
    "hashing_tf": f"""with {TOKENS},
b as (select doc_id, {hashing_tf_bucket_sql('term')} as bucket
      from (select doc_id, unnest(toks) as term from r))
select doc_id, bucket, count(*)::double as tf from b group by doc_id, bucket""",
    "idf": f"with {TOKENS}\nselect term, df, round(idf, 6) as idf from idf",
    "tfidf": f"""with {TOKENS}
select tf.doc_id, tf.term, tf.tf, round(idf.idf, 6) as idf, round(tf.tf * idf.idf, 6) as tfidf
from tf join idf on tf.term = idf.term""",
    "assemble_features": f"""with {cleaned('sweep')}
select doc_id, unnest([0, 1, 2])::integer as pos,
       unnest([link_color_indexed::double, tweet_count, sidebar_color_indexed::double]) as value
from cleaned where tweet_count is not null""",
    "standard_scale": _lineitem_scaled(False),
    "l2_normalize": _lineitem_scaled(True),
    "string_indexer": f"with {RANKED}\nselect label, label_index, n from ranked",
    "index_to_string": f"""with {RANKED}
select d.doc_id, d.lang, r.label_index as lang_index, r.label as lang_roundtrip
from documents d join ranked r on d.lang = r.label""",
    "label_ranks": f"with {CUSTOMERS}\nselect label, n, label_index from labels",
    "label_round_trip": f"""with {CUSTOMERS}
select o_orderkey, o.label, label_index, o.label as label_again from o join labels l on o.label = l.label""",
    "hash_split": f"select doc_id, {split_label_sql('doc_id')} as split from documents",
    # train-form rows without those of dropped_rows; labels ranked by frequency then name; 3 + 1,000 + 1,000 wide; unit norm
    "feature_pipeline": f"""with {cleaned('train')},
ranked as (select gender, (row_number() over (order by count(*) desc, gender) - 1)::double as gender_indexed
           from cleaned where gender is not null group by gender)
select c.doc_id, {split_label_sql('c.doc_id')} as split, c.gender, r.gender_indexed,
       2003 as width, 1.0::double as l2_norm
from cleaned c join ranked r on c.gender = r.gender where c.tweet_count is not null""",
    "feature_pipeline_values": feature_pipeline_values(),
    "dropped_rows": f"""with {SEL}
select doc_id, {split_label_sql('doc_id')} as split,
       case when gender is null then 'null_label' else 'null_count' end as reason
from sel where {TRAIN} and not ({USABLE})""",
    **RULE_ORACLE,
    **STAIR_ORACLE,
    # no node may contradict its counts: one tree, 20 trees of the forest
    "model_node_checks": """select 'decision_tree' as model, 0 as tree, 0::bigint as bad_counts, 0::bigint as bad_gain,
       0::bigint as bad_prediction, 0::bigint as bad_recount, 0::bigint as bad_cells
union all select 'random_forest', range::int, 0, 0, 0, -1, -1 from range(20)""",
    "train_evaluate_rows": f"""with {SEL}
select model, {split_label_sql('doc_id')} as split, gender, count(*)::bigint as n
from sel, (values ('decision_tree'), ('random_forest')) as m(model) where {TRAIN} and {USABLE} group by all""",
    "confusion_matrix": f"""with {GOLD}
select l as gender, p as predicted_gender, n::bigint as n, row_number() over (order by l, p) as position from c""",
    "eval_metrics": eval_metrics(),
}
