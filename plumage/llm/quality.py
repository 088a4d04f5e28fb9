"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model is a byte n-gram model of trusted text: no vocabulary, the same for
every language, and each document's score is its bits per byte. N-grams of all
trusted documents are counted; Spark joins make the model out of the counts
order by order. For scoring, documents are dealt into groups (see
:mod:`plumage.llm.groups`); each group sends its distinct n-grams to the shards
of the count tables and gets their log probabilities back. Documents above their
language's 99 % quantile among held-out trusted documents are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm import groups as G
from plumage.llm.common import flat_bytes, land, text_or_empty

ORDER = 5
#: Trusted documents kept out of training, of this many: they give the quantiles.
HELD_OUT = 4
#: Quantile of the held-out trusted documents' scores above which a text is rejected.
QUANTILE = 0.99
#: A text of this many bytes counts 0.7 of its distance from the median: the
#: rates of shorter texts scatter more.
EVEN_BYTES = 2000
#: Held-out documents for which a language's own quantiles count half, all languages' the rest.
SHRINK = 20
#: A quantile of few held-out documents comes out too low; the distance is wider by this over the root of their number.
MARGIN = 2.5
#: Bytes of text per shard of the n-gram tables.
SHARD_BYTES = 8 << 20
_SCALE = 2048.0  # stored log2 probabilities are rounded to 1/2048


def _gram_keys(offsets: np.ndarray, raw: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """One n-gram per byte, ending there; texts begin after ``order - 1`` newlines."""
    n_docs = len(offsets) - 1
    lead = order - 1
    size = np.diff(offsets)
    starts = offsets[:-1] + lead * np.arange(n_docs)  # of the padded documents
    padded = np.full(len(raw) + lead * n_docs, 10, np.uint8)
    at = np.arange(len(raw)) + np.repeat(lead * np.arange(1, n_docs + 1), size)
    padded[at] = raw
    keys = np.zeros(len(raw), np.uint64)
    for j in range(order):
        keys = (keys << np.uint64(8)) | padded[at - lead + j]
    return keys, starts


def _columns(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       text_or_empty(text_col).alias("text"))


def _trusted_split(table: pa.Table, trusted: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are trusted and which of those train; by the id's hash."""
    ids = table.column("id").to_numpy(zero_copy_only=False)
    known = trusted.column("id").to_numpy()
    held = trusted.column("held").to_numpy(zero_copy_only=False)
    order = np.argsort(known, kind="stable")
    known, held = known[order], held[order].astype(bool)
    if not len(known):
        return np.zeros(len(ids), bool), np.zeros(len(ids), bool)
    plain = np.nan_to_num(ids.astype("float64"), nan=-1).astype("int64") if ids.dtype != np.int64 else ids
    at = np.minimum(np.searchsorted(known, plain), len(known) - 1)
    hit = known[at] == plain
    return hit, hit & ~held[at]


def _group_slices(table: pa.Table, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    offsets, raw = flat_bytes(G.one_array(table.column("text")))
    lo = 0
    while lo < table.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), table.num_rows)
        yield lo, hi, offsets[lo:hi + 1] - offsets[lo], raw[offsets[lo]:offsets[hi]]
        lo = hi


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(keys)).astype(np.int64)


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """By the high bytes' hash; constant within a run of nearby keys is not needed."""
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


def _gather(order: int, shards: int):
    """Per group: its distinct n-grams (queries) and how often trusted text has them (counts)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        g = (left if left.num_rows else right).column("g")[0].as_py()
        out: list[tuple] = []
        if left.num_rows:
            table = G.from_blobs(left.column("docs"))
            _, train = _trusted_split(table, right)
            every, counted = [], []
            for lo, hi, offsets, raw in _group_slices(table):
                keys, _ = _gram_keys(offsets, raw, order)
                every.append(np.unique(keys))
                mine = np.repeat(train[lo:hi], np.diff(offsets))
                counted.append(np.unique(keys[mine], return_counts=True))
            keys = np.unique(np.concatenate(every))
            shard = _shard_of(keys, shards)
            for s in np.unique(shard):
                out.append((g, int(s), G.pack_keys(keys[shard == s]), None))
            keys, counts = _merge(counted)
            shard = _shard_of(keys, shards)
            for s in np.unique(shard):
                mine = shard == s
                out.append((g, int(s), G.pack_keys(keys[mine]), G.pack_array(counts[mine].astype("<i8"))))
        cols = list(zip(*out)) if out else [(), (), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                         pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                        ["g", "shard", "keys", "counts"])
    return run


def _sum_shard(table: pa.Table) -> pa.Table:
    """A shard's distinct n-grams with their trusted counts (0: only asked for)."""
    parts = []
    for keys, counts in zip(table.column("keys"), table.column("counts")):
        k = G.unpack_keys(keys.as_py())
        parts.append((k, G.unpack_array(counts.as_py(), "<i8") if counts.is_valid else np.zeros(len(k), np.int64)))
    keys, counts = _merge(parts)
    shard = table.column("shard")[0].as_py()
    return pa.table([pa.array(np.full(len(keys), shard)), pa.array(keys.view(np.int64)), pa.array(counts)],
                    ["shard", "gram", "n"])


def _suffix(gram: str, order: int):
    return F.col(gram).bitwiseAND(F.lit((1 << (8 * order)) - 1))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> dict[int, tuple[DataFrame, DataFrame]]:
    """The model's tables: per order k, (gram, p) of seen k-grams and (ctx, back) of their contexts.

    ``counts`` has (gram, n), n over 0. The highest order uses counts, lower
    ones the number of distinct preceding bytes. Each order's three discounts
    come from its counts of counts; p is interpolated with the next lower
    order, the lowest with the uniform distribution over bytes.
    """
    tables = {order: counts.select("gram", "n")}
    for k in range(order - 1, 0, -1):
        tables[k] = land(tables[k + 1].groupBy(_suffix("gram", k).alias("gram"))
                                .agg(F.count(F.lit(1)).alias("n")), f"kn-continuations-{k}")
    model: dict[int, tuple[DataFrame, DataFrame]] = {}
    for k in range(1, order + 1):
        few = dict.fromkeys((1, 2, 3, 4), 0)
        few.update({r["n"]: r["m"] for r in tables[k].where("n <= 4").groupBy("n").agg(F.count("*").alias("m")).collect()})
        d = discounts(few)
        off = (F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2]))
        seen = tables[k].withColumn("ctx", F.shiftright("gram", 8)).withColumn("off", off)
        contexts = seen.groupBy("ctx").agg(F.sum("n").alias("total"), F.sum("off").alias("mass"))
        contexts = land(contexts.select("ctx", "total", (F.col("mass") / F.col("total")).alias("back")),
                               f"kn-contexts-{k}")
        seen = seen.join(contexts, "ctx")
        if k == 1:
            lower = seen.withColumn("low", F.lit(1 / 256))
        else:
            lower = seen.withColumn("suffix", _suffix("gram", k - 1)).join(
                model[k - 1][0].select(F.col("gram").alias("suffix"), F.col("p").alias("low")), "suffix")
        p = F.greatest(F.col("n") - F.col("off"), F.lit(0.0)) / F.col("total") + F.col("back") * F.col("low")
        model[k] = (land(lower.select("gram", p.alias("p")), f"kn-model-{k}"), contexts.select("ctx", "back"))
    return model


def discounts(few: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; kept within (0, count) where those are too few."""
    n = {i: max(few.get(i, 0), 1) for i in (1, 2, 3, 4)}
    y = n[1] / (n[1] + 2 * n[2])
    raw = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3])
    return tuple(min(max(x, 0.1), i + 0.9) for i, x in enumerate(raw))  # type: ignore[return-value]


def probabilities(grams: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]], order: int = ORDER) -> DataFrame:
    """(shard, gram, bits): -log2 p of every asked n-gram, by joins with each order's tables."""
    asked = grams.select("shard", "gram")
    p, weight = F.lit(None).cast("double"), F.lit(1.0)
    for k in range(order, 0, -1):
        seen, contexts = model[k]
        asked = (asked.withColumn("_key", _suffix("gram", k)).join(
            seen.select(F.col("gram").alias("_key"), F.col("p").alias(f"p{k}")), "_key", "left").drop("_key")
            .withColumn("_ctx", F.shiftright(_suffix("gram", k), 8)).join(
            contexts.select(F.col("ctx").alias("_ctx"), F.col("back").alias(f"b{k}")), "_ctx", "left").drop("_ctx"))
        p = F.coalesce(p, weight * F.col(f"p{k}"))
        weight = weight * F.coalesce(F.col(f"b{k}"), F.lit(1.0))
    p = F.coalesce(p, weight / 256)
    return asked.select("shard", "gram", (-F.log2(p)).alias("bits"))


def _answer(left: pa.Table, right: pa.Table) -> pa.Table:
    """A shard's answers: for each group's n-grams their bits, in the group's order."""
    grams = right.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams, bits = grams[order], right.column("bits").to_numpy()[order]
    rounded = np.minimum(np.rint(bits * _SCALE), 65535).astype("<u2")
    blobs = [G.pack_array(rounded[np.searchsorted(grams, G.unpack_keys(k.as_py()))]) for k in left.column("keys")]
    return pa.table([left.column("g"), left.column("keys"), pa.array(blobs, pa.binary())], ["g", "keys", "bits"])


def _score(order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "lang", "n_bytes", "bits"]
        if not left.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.string()), pa.array([], pa.int64()),
                             pa.array([], pa.float64())], names)
        table = G.from_blobs(left.column("docs"))
        keys = np.concatenate([G.unpack_keys(k.as_py()) for k in right.column("keys")] or [np.zeros(0, np.uint64)])
        bits = np.concatenate([G.unpack_array(b.as_py(), "<u2") for b in right.column("bits")] or [np.zeros(0, "<u2")])
        at = np.argsort(keys)
        keys, bits = keys[at], bits[at].astype(np.float64) / _SCALE
        size, total = [], []
        for _, _, offsets, raw in _group_slices(table):
            found, _ = _gram_keys(offsets, raw, order)
            sums = np.concatenate([[0.0], np.cumsum(bits[np.searchsorted(keys, found)])]) if len(found) else np.zeros(1)
            size.append(np.diff(offsets))
            total.append(np.diff(sums[offsets]))
        return pa.table([table.column("id"), table.column("lang").cast(pa.string()),
                         pa.array(np.concatenate(size)), pa.array(np.concatenate(total))], names)
    return run


def score_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", order: int = ORDER) -> DataFrame:
    """(id, lang, n_bytes, perplexity, threshold, keep) for every row of ``docs``.

    ``trusted`` has the ids of trusted documents in its first column (repeats
    and NULLs are ignored). Perplexity is per byte, of the whole text.
    A document is kept unless its perplexity is above ``threshold``: its
    language's median and a distance that the held-out documents' quantile sets,
    wider for short texts (see EVEN_BYTES). A NULL language is a language of its
    own; the fewer held-out documents a language has, the more the quantiles of
    all count (see SHRINK). NULL and empty texts have perplexity NULL and are kept, so
    is everything while there is no trusted text at all. Repeated rows score
    alike. An empty table gives an empty result; other columns are ignored.
    """
    columns = _columns(docs, id_col, text_col, lang_col)
    total = G.text_bytes(docs, text_col)
    n_groups, shards = G.group_count(total), G.group_count(total, SHARD_BYTES)
    key = F.col("id")
    known = (trusted.select(F.col(trusted.columns[0]).cast("long").alias("id")).dropna().distinct()
             .withColumn("held", (F.pmod(F.xxhash64(key, F.lit(1)), F.lit(HELD_OUT)) == 0).cast("int"))
             .withColumn("g", F.pmod(F.xxhash64("id"), F.lit(n_groups))))
    packed = G.packed_groups(columns, n_groups)
    gathered = land(packed.groupBy("g").cogroup(known.groupBy("g")).applyInArrow(
        _gather(order, shards), "g long, shard long, keys binary, counts binary"), "quality-grams")
    grams = land(gathered.groupBy("shard").applyInArrow(_sum_shard, "shard long, gram long, n long"),
                        "quality-counts")
    model = kneser_ney(grams.where("n > 0"), order)
    bits = land(probabilities(grams, model, order), "quality-bits")
    asked = gathered.where("counts is null").select("g", "shard", "keys")
    answers = asked.groupBy("shard").cogroup(bits.groupBy("shard")).applyInArrow(
        _answer, "g long, keys binary, bits binary")
    scored = land(packed.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(
        _score(order), "id long, lang string, n_bytes long, bits double"), "quality-scores")
    return _decide(scored, known).withColumnRenamed("id", id_col)


def _decide(scored: DataFrame, known: DataFrame) -> DataFrame:
    rate = F.when(F.col("n_bytes") > 0, F.col("bits") / F.col("n_bytes"))
    held = (scored.where("n_bytes > 0").join(known.where("held = 1").select("id"), "id", "left_semi")
            .select("lang", "n_bytes", rate.alias("rate")))
    def quantiles(column: str, q: float) -> tuple[DataFrame, float | None]:
        """A column's quantile per language, drawn towards that of all, and that of all."""
        one = F.percentile_approx(column, q, 100_000)
        pooled = held.agg(one).first()[0]
        every, n = F.lit(pooled).cast("double"), F.count(column)
        own = every + (one - every) * (n / (n + SHRINK))
        return held.groupBy(F.col("lang").alias("_lang")).agg(own.alias("own")), pooled

    def with_quantiles(df: DataFrame, table: tuple[DataFrame, float | None], name: str) -> DataFrame:
        by_lang, pooled = table
        return (df.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
                .withColumn(name, F.coalesce("own", F.lit(pooled).cast("double"))).drop("_lang", "own"))
    # how much a distance from the median counts
    weight = F.sqrt(F.col("n_bytes") / (F.col("n_bytes") + EVEN_BYTES))
    mid = quantiles("rate", 0.5)
    held = with_quantiles(held, mid, "mid").withColumn("off", (F.col("rate") - F.col("mid")) * weight)
    wider = 1 + MARGIN / max(held.count(), 1) ** 0.5
    out = with_quantiles(with_quantiles(scored, mid, "mid"), quantiles("off", QUANTILE), "off").withColumn(
        "off", F.col("off") * wider)
    some = F.col("n_bytes") > 0
    limit = F.col("mid") + F.when(some, F.col("off") / weight)
    return out.select("id", "lang", "n_bytes",
                      F.when(some, F.pow(F.lit(2.0), rate)).alias("perplexity"),
                      F.pow(F.lit(2.0), limit).alias("threshold"),
                      F.coalesce((F.col("n_bytes") == 0) | ((rate - F.col("mid")) * weight <= F.col("off")),
                                 F.lit(True)).alias("keep"))
