"""The thin queries over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumage.llm import (
    decontaminate,
    exactdup,
    importance,
    lines,
    neardup,
    packing,
    pii,
    quality,
    sentencepieces,
    sharding,
    spelling,
    suffix,
    toxicity,
)
from plumage.llm.common import land
from plumage.llm.sql_crc import crc_ctes
from plumage.sources.tables import load_table

SHARDS = 16
TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
TOXIC = 0.5


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_longest_first(_documents(spark, sf_dir), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sensitive_spans(_documents(spark, sf_dir))
    listed = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("spans", lambda s: s["kind"] != pii.TERM)
    base_list = F.concat_ws(",", F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(base_list, 256).alias("base_sha256"), listed.alias("spans"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), packing.SEQUENCE)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = load_table(spark, sf_dir, "labels")
    return quality.score_quality(_documents(spark, sf_dir), labels.where("quality = 1").select("doc_id"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_documents(spark, sf_dir), load_table(spark, sf_dir, "benchmark"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_documents(spark, sf_dir), 85)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(_documents(spark, sf_dir), 100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(_documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = load_table(spark, sf_dir, "labels").withColumn("low_quality", 1 - F.col("quality"))
    categories = ("low_quality", "toxic")
    sample = land(toxicity.labelled_sample(docs, labels, categories), "toxicity-sample")
    scored = toxicity.score_chain(docs, toxicity.fit_chain(sample, categories))
    return scored.withColumn("is_toxic", F.col("p_toxic") >= TOXIC)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(_documents(spark, sf_dir), load_table(spark, sf_dir, "benchmark"), 5)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_documents(spark, sf_dir), noise=spelling.NOISE)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepieces.encode_and_decode(_documents(spark, sf_dir), public_tokenizers.path(PIECES))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        sentencepieces.ids_digest(F.col("ids")).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_line_dedup": op2_line_dedup,
    "op3_pii": op3_pii,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_minhash": op7_minhash,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_importance": op11_importance,
    "op12_spelling": op12_spelling,
    "op13_sentencepiece": op13_sentencepiece,
}

_LINES_SQL = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents),
keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
  from lines),
common as (
  select line_key, max(doc_id) as top from keyed where length(line_key) >= 20
  group by line_key having count(distinct doc_id) >= 3),
marked as (
  select k.*, c.top is not null and k.doc_id <> c.top as dropped
  from keyed k left join common c on k.line_key = c.line_key)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where dropped))::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""

_EXACT_SQL = """
with g as (
  select coalesce(text, '') as t, max(doc_id) as keep_id, count(*)::bigint as group_size
  from documents group by 1)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept,
       sha256(coalesce(d.text, '')) as text_sha256
from documents d join g on coalesce(d.text, '') = g.t
"""

_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MINHASH_SQL = f"""
with recursive split as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWERED}'), '[^\\x20\\x09-\\x0D]+') as words
  from documents),
shingled as (
  select distinct doc_id, unnest(case when len(words) = 0 then []::varchar[] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as g from split),
sizes as (select doc_id, count(*)::bigint as n from shingled group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from shingled a join shingled b on a.g = b.g and a.doc_id < b.doc_id
  group by all),
links as (
  select x, y from shared join sizes sx on sx.doc_id = x join sizes sy on sy.doc_id = y where 100 * c >= 85 * (sx.n + sy.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach(here, there) as (
  select doc_id, doc_id from documents union select r.here, b.y from reach r join both_ways b on r.there = b.x),
least as (select here, min(there) as component_id from reach group by here)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join least on here = d.doc_id left join sizes s on s.doc_id = d.doc_id
"""

_SUFFIX_SQL = """
with coded as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, ''))::bigint as n from documents),
blocks as (select doc_id, n, h, unnest(range(0, n - 99, 100)) as lo from coded where n >= 100),
stretches as (select doc_id, n, lo, substr(h, 2 * lo + 1, 398) as part from blocks),
starts as (select doc_id, n, lo, part, unnest(range(100)) as i from stretches),
ordered as (
  select doc_id, lo + i as s, row_number() over (partition by md5(substr(part, 2 * i + 1, 200)) order by doc_id, lo + i) as nth
  from starts where lo + i <= n - 100),
covered as (
  select doc_id, s, coalesce(s > lag(s) over w + 100, true) as opens from ordered where nth > 1
  window w as (partition by doc_id order by s)),
numbered as (select doc_id, s, sum(opens::int) over (partition by doc_id order by s) as run from covered),
runs as (select doc_id, run, min(s) as a, max(s) + 100 as z from numbered group by all),
gaps as (
  select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) as after from runs),
cut as (
  select g.doc_id, sum(z - a)::bigint as n_removed, count(*)::bigint as n_spans, max(z) as last,
         string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' order by a) as head
  from gaps g join coded c on g.doc_id = c.doc_id group by g.doc_id)
select c.doc_id, c.n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) as kept_sha256
from coded c left join cut t on c.doc_id = t.doc_id
"""

_IMPORTANCE_SQL = f"""
with recursive texts as (
  select 'd' as side, doc_id, text from documents
  union all
  select 'b', row_number() over (), text from benchmark),
split as (
  select side, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWERED}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from texts),
placed as (
  select side, doc_id, unnest(words) as w, unnest(range(len(words))) as i from split),
joined as (
  select side, doc_id, w, lead(w) over t as w2, lead(w, 2) over t as w3
  from placed window t as (partition by side, doc_id order by i)),
features as (
  select side, doc_id, w as s from joined
  union all select side, doc_id, w || ' ' || w2 from joined where w2 is not null
  union all select side, doc_id, w || ' ' || w2 || ' ' || w3 from joined where w3 is not null),
{crc_ctes("features")},
bucketed as (
  select f.side, f.doc_id, c.h % 10000 as bucket from features f join crc c on f.s = c.s),
counts as (
  select bucket, count(*) filter (where side = 'd') as s, count(*) filter (where side = 'b') as t
  from bucketed group by bucket),
totals as (select coalesce(sum(s), 0)::double as s_all, coalesce(sum(t), 0)::double as t_all from counts),
gain as (
  select bucket, floor(1000 * ln(((t + 1)::double * (s_all + 10000)) / ((s + 1)::double * (t_all + 10000))))::bigint as g
  from counts, totals),
weighed as (
  select doc_id, count(*)::bigint as n_features, sum(g)::bigint as weight
  from bucketed join gain using (bucket) where side = 'd' group by doc_id),
scored as (
  select d.doc_id, len(d.words) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::bigint + 0.5)
                                                    ::double / 4294967296)))::bigint as score
  from split d left join weighed w on d.doc_id = w.doc_id where d.side = 'd'),
able as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n
  from scored where n_words >= 20)
select s.doc_id, n_features, weight, score, rank::bigint as rank
from scored s left join able a on s.doc_id = a.doc_id and a.rank <= a.n * 5 // 100
"""

_SPELLING_SQL = f"""
with recursive runs as (
  select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')),
                           '{_UPPER}', '{_LOWERED}') as run from documents),
noted as (select run, doc_id || ':' || run as s, count(*) as n from runs group by all),
{crc_ctes("noted")},
spoiled as (
  select case when h % {spelling.NOISE} = 0
              then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
  from noted join crc on noted.s = crc.s),
words as (
  select word, sum(n)::bigint as n from spoiled where length(word) >= {spelling.MIN_LENGTH}
  group by word having sum(n) >= {spelling.MIN_COUNT}),
places as (select word, n, unnest(range(length(word)))::int as i from words),
holes as (select word, n, i, substr(word, 1, i) as a, substr(word, i + 2) as b from places),
near as (
  select a.word, b.word as other, b.n from holes a join holes b on a.i = b.i and a.a = b.a and a.b = b.b and a.word <> b.word
  union select h.word, w.word, w.n from holes h join words w on h.a || h.b = w.word
  union select w.word, h.word, h.n from holes h join words w on h.a || h.b = w.word),
best as (
  select word, count(*)::bigint as n_near, arg_min(other, (-n, other)) as best, max(n) as best_n from near group by word),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when best_n >= 2 * w.n then best end as form,
         case when best_n >= 2 * w.n then best_n end as form_n
  from words w left join best b on w.word = b.word),
way(word, here) as (
  select word, word from formed
  union all
  select way.word, f.form from way join formed f on way.here = f.word where f.form is not null)
select f.word, f.form, way.here as root, f.n, f.n_near, f.form_n
from formed f join way on f.word = way.word join formed e on way.here = e.word where e.form is null
"""

ORACLE: dict[str, str] = {
    "op2_line_dedup": _LINES_SQL,
    "op7_minhash": _MINHASH_SQL,
    "op8_suffix_dedup": _SUFFIX_SQL,
    "op9_exact_dedup": _EXACT_SQL,
    "op11_importance": _IMPORTANCE_SQL,
    "op12_spelling": _SPELLING_SQL,
}
