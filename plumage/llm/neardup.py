"""MinHash near-dedup with tensored banding.

A table key is a pair of half keys, one from each of two small collections: with
HALVES half keys a side there are HALVES**2 tables, but only 2 * HALVES * WIDTH
minhashes to compute. Documents with equal shingle sets are one class from the
start. A class takes part only with half keys that some other class has too.

Classes that share a bucket are candidates; the star from a bucket's smallest
class to the others (never all pairs) joins them into candidate clusters. Inside
a cluster full shingle sets are compared, block against block: each class's set
is sent once per block of its cluster, no pair is ever a row, and what a task
returns is a spanning forest of its links. So no candidate goes unchecked, no
cluster has to fit into one task, and a pair costs a few multiplications. The
number of block pairs of one cluster grows with the square of its different
texts (exact copies do not count).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm import groups as G
from plumage.llm.common import flat_bytes, land, shingles, slices, text_or_empty, words
from plumage.llm.components import components

SHINGLE = 5
#: Half keys in each of the two collections, and minhashes in a half key. At a
#: similarity of 0.85 a pair shares a table with probability 1 - 1.5e-4.
HALVES = 10
WIDTH = 3
#: Classes, and bytes of shingle hashes, in a block of a candidate cluster.
BLOCK = 512
BLOCK_BYTES = 8 << 20
_COLUMNS = 4096

_SEED = 20240229


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    n = 2 * HALVES * WIDTH
    return (rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1),
            rng.integers(0, 1 << 64, n, dtype=np.uint64))


def _sets(offsets: np.ndarray, raw: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles per document, sorted within it, and their bounds."""
    hashes, _, bounds = words(offsets, raw)
    found, ends = shingles(hashes, bounds, size)
    parts = [np.unique(found[lo:hi]) for lo, hi in zip(ends[:-1], ends[1:])]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else found), bounds


def _half_keys(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Half keys (documents x 2 * HALVES) of non-empty sets."""
    multiply, add = _permutations()
    docs = len(bounds) - 1
    least = np.empty((docs, len(multiply)), np.uint64)
    for j, (a, b) in enumerate(zip(multiply, add)):
        least[:, j] = np.minimum.reduceat(flat * a + b, bounds[:-1])
    keys = np.zeros((docs, 2 * HALVES), np.uint64)
    for j in range(WIDTH):
        keys = (keys ^ least[:, j::WIDTH]) * np.uint64(0xC2B2AE3D27D4EB4F)
        keys ^= keys >> np.uint64(29)
    return keys


def _scan(size: int):
    names = ["id", "n_shingles", "set_a", "set_b", "halves"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat, bounds = _sets(*flat_bytes(batch.column("text")), size)
            n = np.diff(bounds)
            some = np.flatnonzero(n)
            digest = np.zeros((batch.num_rows, 2), np.int64)
            for d in some:
                digest[d] = np.frombuffer(xxhash.xxh3_128_digest(flat[bounds[d]:bounds[d + 1]].tobytes()), "<i8")
            keys = _half_keys(flat, np.concatenate([bounds[:-1][some], [len(flat)]])) if len(some) else \
                np.zeros((0, 2 * HALVES), np.uint64)
            counts = np.zeros(batch.num_rows + 1, np.int32)
            counts[1:][some] = 2 * HALVES
            halves = pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)),
                                              pa.array(keys.ravel().view(np.int64)))
            yield pa.record_batch([batch.column(0), pa.array(n), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                                   halves], names)
    return run


def _group_sets(size: int):
    """Shingle sets of a group's wanted documents."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "shingles"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary())], names)
        table = G.from_blobs(left.column("docs"))
        table = table.filter(pc.is_in(table.column("id"), value_set=right.column("id").combine_chunks()))
        ids, blobs = [], []
        for batch in slices(iter(table.to_batches())):
            flat, bounds = _sets(*flat_bytes(batch.column("text")), size)
            ids.extend(batch.column("id").to_pylist())
            blobs.extend(flat[lo:hi].tobytes() for lo, hi in zip(bounds[:-1], bounds[1:]))
        return pa.table([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], names)
    return run


def _similar(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Matrix of which sets are similar (``right`` None: all of ``left`` with each other)."""
    sets = left + (right or [])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, at, counts = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1  # a shingle of one set is in no intersection
    common = counts[at] > 1
    owner, at = owner[common], column[at[common]]
    by = np.argsort(at, kind="stable")
    owner, at = owner[by], at[by]
    split = len(left) if right is not None else 0
    shared = np.zeros((len(left), len(sets) - split), np.float32)
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, _COLUMNS):
        part = slice(*np.searchsorted(at, [lo, lo + _COLUMNS]))
        inside = np.zeros((len(sets), _COLUMNS), np.float32)
        inside[owner[part], at[part] - lo] = 1
        shared += inside[:len(left)] @ inside[split:].T
    size = np.array([len(x) for x in sets])
    shared = shared.astype(np.int64)
    return 100 * shared >= percent * (size[:len(left), None] + size[None, split:] - shared)


def _forest(similar: np.ndarray, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it is connected with), for connected nodes other than that."""
    if across:
        rows, cols = similar.shape
        both = np.zeros((rows + cols, rows + cols), bool)
        both[:rows, rows:] = similar
        both[rows:, :rows] = similar.T
        similar = both
    label = np.arange(len(similar))
    near = similar | np.eye(len(similar), dtype=bool)
    while True:
        least = np.where(near, label[None, :], len(label)).min(axis=1)
        least = least[least]
        if (least == label).all():
            node = np.flatnonzero(label != np.arange(len(label)))
            return node, label[node]
        label = least


def _compare(percent: int):
    """Links between the classes of each cluster's block or pair of blocks."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("rep", "ascending")])
        rep, cluster, block, other = (table.column(c).to_numpy() for c in ("rep", "cluster", "block", "other"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        a, b = [], []
        cuts = np.flatnonzero(np.diff(cluster)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(cluster)]):
            first, second = min(block[lo:hi].min(), other[lo:hi].min()), max(block[lo:hi].max(), other[lo:hi].max())
            mine = np.arange(lo, hi)
            if first == second:
                similar = _similar([sets[i] for i in mine], None, percent)
            else:
                near, far = mine[block[mine] == first], mine[block[mine] == second]
                mine = np.concatenate([near, far])
                if not len(near) or not len(far):
                    continue
                similar = _similar([sets[i] for i in near], [sets[i] for i in far], percent)
            node, root = _forest(similar, first != second)
            a.append(rep[mine[root]])
            b.append(rep[mine[node]])
        none = np.zeros(0, np.int64)
        return pa.table([pa.array(np.concatenate(a or [none])), pa.array(np.concatenate(b or [none]))], ["a", "b"])
    return run


def cluster_links(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect just the classes that are similar, directly or over others.

    ``sets`` has (id, shingles) and ``clusters`` (node, component). A cluster
    of n blocks gives n * (n + 1) / 2 tasks of two blocks; small clusters share
    tasks.
    """
    members = sets.join(clusters, sets["id"] == clusters["node"]).select(
        F.col("id").alias("rep"), F.col("component").alias("cluster"), "shingles")
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("shingles")).alias("bytes"))
    size = land(size.where("n > 1").select("cluster", "bytes", F.greatest(
        F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")), "minhash-sizes")
    bins = G.group_count(size.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0], BLOCK_BYTES)
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = members.join(size, "cluster").withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    work = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(
        F.xxhash64("cluster", low, high))
    return (dealt.select("cluster", "rep", "block", "other", "shingles", (F.col("blocks") == 1).alias("small"),
                         work.alias("work")).groupBy("small", "work").applyInArrow(_compare(percent), "a long, b long"))


def table_rows(classes: DataFrame) -> DataFrame:
    """(key, rep): table keys of the classes, from half keys that at least two classes have."""
    halves = classes.select("rep", F.posexplode("halves").alias("slot", "h"))
    shared = halves.groupBy("slot", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    mine = F.collect_list(F.struct("slot", "h"))
    per_class = halves.join(shared, ["slot", "h"]).groupBy("rep").agg(mine.alias("own"))
    side_a = F.filter("own", lambda x: x["slot"] < HALVES)
    side_b = F.filter("own", lambda x: x["slot"] >= HALVES)
    tensored = (per_class.select("rep", F.explode(side_a).alias("a"), side_b.alias("bs"))
                .select("rep", "a", F.explode("bs").alias("b")))
    return tensored.select(F.xxhash64("a.slot", "b.slot", "a.h", "b.h").alias("key"), "rep")


def candidate_clusters(rows: DataFrame) -> DataFrame:
    """(node, component) of the classes that share buckets, over each bucket's smallest class."""
    leaders = rows.groupBy("key").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = rows.join(leaders, "key").where("rep <> lead").select("lead", "rep").distinct()
    return components(stars, "lead", "rep")


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    A document's set holds its distinct ``size``-word shingles (fewer words: the
    whole sequence as one; no words or NULL text: none, and it is linked with
    nothing). Documents whose sets have ``100 * shared >= percent * union`` are
    linked; component_id is the smallest id reachable. Repeated rows are alike;
    rows that share an id are one document; a NULL id is linked with nothing and
    kept. An empty table gives an empty result; other columns are ignored.
    """
    columns = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    scan = land(columns.mapInArrow(
        _scan(size), "id long, n_shingles long, set_a long, set_b long, halves array<bigint>"), "minhash-scan")
    some = scan.where("n_shingles > 0 and id is not null")
    classes = land(some.groupBy("set_a", "set_b").agg(
        F.min("id").alias("rep"), F.first("halves").alias("halves")), "minhash-classes")
    clusters = land(candidate_clusters(land(table_rows(classes), "minhash-tables")), "minhash-clusters")

    groups = G.group_count(G.text_bytes(docs, text_col))
    wanted = clusters.select(F.col("node").alias("id")).withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)))
    sets = land(G.packed_groups(columns, groups).groupBy("g").cogroup(wanted.groupBy("g")).applyInArrow(
        _group_sets(size), "id long, shingles binary"), "minhash-sets")
    joined = components(land(cluster_links(sets, clusters, percent), "minhash-links"), "a", "b")
    member = classes.select("set_a", "set_b", "rep").join(joined, F.col("rep") == F.col("node"), "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("component"))
    out = scan.select("id", "n_shingles", "set_a", "set_b").join(member, ["set_a", "set_b"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component")),
                                                           F.col("id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
