"""Repeated passages by two-stage suffix sorting.

The corpus cannot be sorted as one text, so it is cut where equal passages are
sure to meet. Every window of ``length`` bytes has a key: the smallest hash of
the short grams inside it. Equal windows have equal keys, and neighbouring
windows mostly share theirs, so keys come in runs of a few dozen windows. Only
runs whose key occurs again can hold a repeat.

1. Each group of documents sends its distinct keys, compressed, to the shards of
   the key table and hears which of them other groups have too, and which are
   very frequent.
2. Each group sorts the suffixes of its own recurring runs and settles what is
   repeated inside the group. What is the first of its kind there, and has a key
   that other groups have, goes on to the bucket of its key. Windows of very
   frequent keys go on one by one, dealt by their content, so that the many
   different surroundings of one frequent passage do not meet in one task.
3. Each bucket sorts the suffixes of what it got.

Both sorts are the same two-stage sort over the bytes: suffixes smaller than
their successors are sorted directly, the others are induced from these by one
scan over the buckets of first bytes; common prefixes of neighbours then give
the classes of equal windows, and all but the earliest window of a class are
repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm import groups as G
from plumage.llm.common import flat_bytes, gram_hashes, land, mix, text_or_empty

LENGTH = 100
GRAM = 32
#: Bytes of corpus text per bucket of the key table and of the second sort.
BUCKET_BYTES = 4 << 20
#: Runs of one key in the corpus from which its windows travel one by one.
FREQUENT = 500
_SLICE = 512 << 10
_NO_ID = (1 << 63) - 1  # stands for a NULL id: after every other document


# --- sorting the suffixes of one piece of text ------------------------------

def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the text's end counts as large)."""
    step = text[1:].astype(np.int16) - text[:-1]
    change = np.flatnonzero(step)
    out = np.ones(len(text), bool)
    if len(change):
        out[:change[-1] + 1] = np.repeat(step[change] > 0, np.diff(change, prepend=-1))
    return out


def _same(text: np.ndarray, p: np.ndarray, q: np.ndarray, length: int, block: int = 1 << 15) -> np.ndarray:
    rows = np.lib.stride_tricks.sliding_window_view(text, length)
    return np.concatenate([(rows[p[i:i + block]] == rows[q[i:i + block]]).all(axis=1)
                           for i in range(0, len(p), block)] or [np.zeros(0, bool)])


def common_prefixes(text: np.ndarray, order: np.ndarray, length: int, block: int = 1 << 15) -> np.ndarray:
    """Common prefix, up to ``length``, of each suffix in ``order`` with the one before it (the first: 0)."""
    rows = np.lib.stride_tricks.sliding_window_view(text, length)
    out = np.zeros(len(order), np.int64)
    for i in range(1, len(order), block):
        equal = rows[order[i - 1:i - 1 + block][:len(order) - i]] == rows[order[i:i + block]]
        full = equal.all(axis=1)
        out[i:i + block] = np.where(full, length, equal.argmin(axis=1))
    return out


def sort_directly(text: np.ndarray, pos: np.ndarray, length: int) -> np.ndarray:
    """``pos`` by the first ``length`` bytes there: 8 bytes at a time, only among ties so far."""
    words = np.lib.stride_tricks.sliding_window_view(text, 8)

    def load(at: np.ndarray) -> np.ndarray:
        return words[at].view(">u8").ravel().astype(np.uint64)

    key = load(pos)
    by = np.argsort(key)
    order, key = pos[by], key[by]
    slot = np.arange(len(pos))
    head = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), slot, 0)) if len(pos) else slot
    tied = _tied(slot, head)
    for k in range(8, length, 8):
        if not len(tied):
            break
        if k == 24:  # most ties left are equal throughout: no need to go on with those
            equal = _same(text, order[tied], order[head[tied]], length)
            first = np.flatnonzero(head[tied] == tied)
            done = np.logical_and.reduceat(equal, first)
            tied = tied[~np.repeat(done, np.diff(np.append(first, len(tied))))]
            if not len(tied):
                break
        key = load(order[tied] + k)
        by = np.lexsort((key, head[tied]))
        order[tied] = order[tied][by]
        key, group = key[by], head[tied]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        head[tied] = np.maximum.accumulate(np.where(fresh, tied, 0))
        tied = _tied(tied, head)
    return order


def _tied(slots: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Slots that are not alone in their group."""
    if not len(slots):
        return slots
    first = head[slots] == slots
    alone = first & np.append(first[1:], True)
    return slots[~alone]


def suffix_order(text: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """Positions marked in ``wanted``, in the order of their suffixes (to at least ``length`` bytes)."""
    small = smaller_than_next(text)
    need = wanted.copy()
    ahead = np.flatnonzero(need & ~small) + 1  # a larger suffix is induced from its successor
    while len(ahead := ahead[~need[ahead]]):
        need[ahead] = True
        ahead = ahead[~small[ahead]] + 1
    direct = sort_directly(text, np.flatnonzero(need & small), length)
    induced = need & ~small
    ends = np.cumsum(np.bincount(text[direct], minlength=256))
    pushed: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        bucket = []
        wave = np.concatenate(pushed[c]) if pushed[c] else np.zeros(0, np.int64)
        while len(wave):  # within a bucket, runs of its own byte grow by one
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[induced[before] & (text[before] == c)]
        bucket.append(direct[ends[c - 1] if c else 0:ends[c]])
        full = np.concatenate(bucket)
        out.append(full)
        before = full[full > 0] - 1
        before = before[induced[before] & (text[before] > c)]
        byte = text[before]
        by = np.argsort(byte, kind="stable")
        before, byte = before[by], byte[by]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        for part in np.split(before, cuts):
            if len(part):
                pushed[text[part[0]]].append(part)
    order = np.concatenate(out)
    return order[wanted[order]]


def repeats(text: np.ndarray, pos: np.ndarray, length: int) -> np.ndarray:
    """Which windows of ``length`` bytes at ``pos`` (ascending: earlier first) equal an earlier one."""
    if not len(pos):
        return np.zeros(0, bool)
    padded = np.concatenate([text, np.zeros(length + 16, np.uint8)])
    wanted = np.zeros(len(padded), bool)
    wanted[pos] = True
    order = suffix_order(padded, wanted, length)
    first = np.flatnonzero(common_prefixes(padded, order, length) < length)
    earliest = np.minimum.reduceat(order, first)
    late = np.zeros(len(padded), bool)
    late[order] = order != np.repeat(earliest, np.diff(np.append(first, len(order))))
    return late[pos]


# --- keys of windows ---------------------------------------------------------

def window_runs(offsets: np.ndarray, raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one key: (key, start, windows), never across documents.

    Last comes the key of every place that gives a window its key: a key that is
    there twice may be in two windows, even of one run (in periodic text).
    """
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    parts = []
    lo = 0
    while lo < len(offsets) - 1:
        hi = int(np.searchsorted(offsets, offsets[lo] + _SLICE, "right")) - 1
        hi = min(max(hi, lo + 1), len(offsets) - 1)
        base = offsets[lo]
        found = _slice_runs(offsets[lo:hi + 1] - base, raw[base:offsets[hi]], length, gram)
        if found is not None:
            parts.append((found[0], found[1] + base, *found[2:]))
        lo = hi
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else none


def _sliding(pick: np.ufunc, values: np.ndarray, span: int) -> np.ndarray:
    """Minimum or maximum over every ``span`` neighbouring values, by doubling."""
    n, width = len(values) - span + 1, 1
    while 2 * width <= span:
        values = pick(values[:-width], values[width:])
        width *= 2
    return pick(values[:n], values[span - width:span - width + n])


def _slice_runs(offsets: np.ndarray, raw: np.ndarray, length: int, gram: int):
    n = len(raw) - length + 1
    if n <= 0:
        return None
    grams, span = gram_hashes(raw, gram), length - gram + 1
    least = _sliding(np.minimum, grams, span)
    inside = np.ones(n, bool)
    for begin, end in zip(offsets[:-1], offsets[1:]):
        inside[max(begin, end - length + 1):end] = False
    first, last = inside.copy(), inside.copy()
    differs = least[1:] != least[:-1]
    first[1:] &= ~inside[:-1] | differs
    last[:-1] &= ~inside[1:] | differs
    start = np.flatnonzero(first)
    edge = np.zeros(span - 1, np.uint64)
    most = _sliding(np.maximum, np.concatenate([edge, np.where(inside, least, np.uint64(0)), edge]), span)
    return least[start], start, np.flatnonzero(last) + 1 - start, grams[most == grams]


def _expand(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ..., start + n - 1 of every run."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _runs_of(marks: np.ndarray, pos: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked windows as (owner, start, windows); a run stays within its owner."""
    pos, owner = pos[marks], owner[marks]
    if not len(pos):
        return owner, pos, pos
    first = np.concatenate([[True], (pos[1:] != pos[:-1] + 1) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(first)
    return owner[at], pos[at], np.diff(np.append(at, len(pos)))


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(33)).astype(np.int64) % buckets


# --- the Spark stages --------------------------------------------------------

_DOC_ORDER = [("id", "ascending"), ("row", "ascending")]


def _group_text(blobs: pa.ChunkedArray) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    table = G.from_blobs(blobs, _DOC_ORDER)
    return table, *flat_bytes(G.one_array(table.column("text")))


def _send_keys(length: int, gram: int, buckets: int):
    def run(left: pa.Table) -> pa.Table:
        _, offsets, raw = _group_text(left.column("docs"))
        keys, counts = np.unique(window_runs(offsets, raw, length, gram)[3], return_counts=True)
        bucket = _bucket_of(keys, buckets)
        rows = [(int(b), G.pack_keys(keys[bucket == b]), G.pack_array(counts[bucket == b].astype("<u4")))
                for b in np.unique(bucket)]
        cols = list(zip(*rows)) or [(), (), ()]
        g = left.column("g")[0].as_py()
        return pa.table([pa.array([g] * len(rows), pa.int64()), pa.array(cols[0], pa.int64()),
                         pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                        ["g", "bucket", "keys", "counts"])
    return run


def _answer_keys(frequent: int):
    def run(table: pa.Table) -> pa.Table:
        keys = [G.unpack_keys(k.as_py()) for k in table.column("keys")]
        counts = np.concatenate([G.unpack_array(c.as_py(), "<u4") for c in table.column("counts")])
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        shared = np.bincount(at, minlength=len(known)) > 1
        hot = np.bincount(at, weights=counts, minlength=len(known)) >= frequent
        out, lo = [], 0
        for g, own in zip(table.column("g"), keys):
            mine = at[lo:lo + len(own)]
            lo += len(own)
            keep = shared[mine]
            if keep.any():
                out.append((g.as_py(), G.pack_keys(own[keep]), G.pack_array(hot[mine][keep].astype("u1"))))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()),
                         pa.array(cols[2], pa.binary())], ["g", "keys", "hot"])
    return run


def _sort_group(length: int, gram: int, buckets: int):
    """Repeats inside a group (bucket NULL), and windows that other groups may repeat (by bucket)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, out = ["g", "bucket", "piece"], []
        if left.num_rows:
            g = left.column("g")[0].as_py()
            table, offsets, raw = _group_text(left.column("docs"))
            key, start, n, places = window_runs(offsets, raw, length, gram)
            known, counts = np.unique(places, return_counts=True)
            again = counts[np.searchsorted(known, key)] > 1
            shared = np.concatenate([G.unpack_keys(k.as_py()) for k in right.column("keys")] or [np.zeros(0, np.uint64)])
            hot = np.concatenate([G.unpack_array(h.as_py(), "u1") for h in right.column("hot")] or [np.zeros(0, "u1")])
            by = np.argsort(shared)
            shared, hot = shared[by], hot[by].astype(bool)
            seat = np.minimum(np.searchsorted(shared, key), max(len(shared) - 1, 0))
            abroad = (shared[seat] == key) if len(shared) else np.zeros(len(key), bool)
            late = np.zeros(len(raw), bool)
            own = _expand(start[again], n[again])
            late[own] = repeats(raw, own, length)
            doc_of = np.searchsorted(offsets, start, "right") - 1
            d, s, m = _runs_of(late[own], own, np.repeat(doc_of[again], n[again]))
            if len(d):
                out.append((g, None, G.to_blob(_ranges(d, s - offsets[d], m))))
            # first of their kind here, but other groups know the key
            run_at = np.repeat(np.flatnonzero(abroad), n[abroad])
            pos = _expand(start[abroad], n[abroad])
            r, s, m = _runs_of(~late[pos], pos, run_at)
            single = hot[seat[r]] if len(hot) else np.zeros(len(r), bool)
            where = _bucket_of(key[r], buckets)
            each = _expand(s[single], m[single])
            if len(each):
                r = np.concatenate([r[~single], np.repeat(r[single], m[single])])
                s = np.concatenate([s[~single], each])
                where = np.concatenate([where[~single], _content_bucket(raw, each, length, buckets)])
                m = np.concatenate([m[~single], np.ones(len(each), np.int64)])
            ids, rows = (table.column(c).to_numpy() for c in ("id", "row"))
            order = np.argsort(where, kind="stable")
            cuts = np.flatnonzero(np.diff(where[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                d = doc_of[r[part]]
                piece = pa.table([pa.array(ids[d]), pa.array(rows[d]), pa.array(d), pa.array(s[part] - offsets[d]),
                                  pa.array(m[part]), _byte_column(raw, s[part], m[part] + length - 1)],
                                 ["id", "row", "doc", "start", "n", "bytes"])
                out.append((g, int(where[part[0]]), G.to_blob(piece)))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                         pa.array(cols[2], pa.binary())], names)
    return run


def _content_bucket(raw: np.ndarray, pos: np.ndarray, length: int, buckets: int, block: int = 1 << 15) -> np.ndarray:
    """Bucket of single windows by the hash of all their bytes."""
    rows = np.lib.stride_tricks.sliding_window_view(raw, length)
    factor = np.multiply.accumulate(np.full(length, 0x9E3779B97F4A7C15, np.uint64))
    hashes = [((rows[pos[i:i + block]].astype(np.uint64) + np.uint64(1)) * factor).sum(axis=1, dtype=np.uint64)
              for i in range(0, len(pos), block)]
    return _bucket_of(mix(np.concatenate(hashes)), buckets)


def _byte_column(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = raw[_expand(start, size)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start),
                                            [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def _ranges(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table([pa.array(doc), pa.array(start), pa.array(n)], ["doc", "start", "n"])


def _sort_bucket(length: int):
    """Repeats among the windows of a bucket, as ranges for each group."""
    def run(table: pa.Table) -> pa.Table:
        parts = []
        for g, piece in zip(table.column("g"), table.column("piece")):
            part = pa.ipc.open_stream(piece.as_buffer()).read_all()
            parts.append(part.append_column("g", pa.array(np.full(part.num_rows, g.as_py()))))
        rows = pa.concat_tables(parts).sort_by([(c, "ascending") for c in ("id", "row", "doc", "start")])
        offsets, raw = flat_bytes(rows.column("bytes").combine_chunks())
        n = rows.column("n").to_numpy()
        pos = _expand(offsets[:-1], n)
        at, s, m = _runs_of(repeats(raw, pos, length), pos, np.repeat(np.arange(len(n)), n))
        start = rows.column("start").to_numpy()[at] + s - offsets[at]
        g, doc = (rows.column(c).to_numpy()[at] for c in ("g", "doc"))
        by = np.argsort(g, kind="stable")
        cuts = np.flatnonzero(np.diff(g[by])) + 1
        split = np.split(by, cuts) if len(by) else []
        return pa.table([pa.array([int(g[p[0]]) for p in split], pa.int64()),
                         pa.array([G.to_blob(_ranges(doc[p], start[p], m[p])) for p in split], pa.binary())],
                        ["g", "piece"])
    return run


def _remove(length: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "n_bytes", "spans", "kept"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), span, pa.binary())], names)
        table, offsets, raw = _group_text(left.column("docs"))
        cover = np.zeros(len(raw) + 1, np.int32)
        for piece in right.column("piece"):
            part = pa.ipc.open_stream(piece.as_buffer()).read_all()
            doc, start, n = (part.column(c).to_numpy() for c in ("doc", "start", "n"))
            np.add.at(cover, offsets[doc] + start, 1)
            np.add.at(cover, offsets[doc] + start + n - 1 + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        spans, kept = [], []
        for lo, hi in zip(offsets[:-1], offsets[1:]):
            mine = gone[lo:hi]
            if mine.any():
                edge = np.flatnonzero(np.diff(mine.view(np.int8), prepend=0, append=0))
                spans.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                kept.append(raw[lo:hi][~mine].tobytes())
            else:
                spans.append([])
                kept.append(raw[lo:hi].tobytes())
        ids = table.column("id").to_numpy()
        return pa.table([pa.array(ids, mask=ids == _NO_ID), pa.array(np.diff(offsets)), pa.array(spans, span),
                         pa.array(kept, pa.binary())], names)
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   gram: int = GRAM, frequent: int = FREQUENT) -> DataFrame:
    """(id, n_bytes, spans, kept): every document without the bytes that repeat earlier ones.

    A byte goes if it is covered by a string of ``length`` bytes that also
    starts earlier: in a document of smaller id, or in the same document before.
    Overlaps count, and strings are judged on the input. ``spans`` are the
    maximal removed runs [start, end), ``kept`` the bytes left. NULL texts are
    empty; texts shorter than ``length`` stay whole; repeated rows of one id are
    ordered by a hash of their text, so of equal ones the first stays; a NULL id
    comes after all others. An empty table gives an empty result; other columns
    are ignored. ``length`` must be larger than ``gram``.
    """
    text = text_or_empty(text_col)
    total = G.text_bytes(docs, text_col)
    groups, buckets = G.group_count(total), G.group_count(total, BUCKET_BYTES)
    columns = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
                          F.xxhash64(text).alias("row"), text.alias("text"))
    packed = G.packed_groups(columns, groups).groupBy("g")
    keys = packed.applyInArrow(_send_keys(length, gram, buckets), "g long, bucket long, keys binary, counts binary")
    answers = keys.groupBy("bucket").applyInArrow(_answer_keys(frequent), "g long, keys binary, hot binary")
    pieces = land(packed.cogroup(answers.groupBy("g")).applyInArrow(
        _sort_group(length, gram, buckets), "g long, bucket long, piece binary"), "suffix-pieces")
    across = pieces.where("bucket is not null").groupBy("bucket").applyInArrow(
        _sort_bucket(length), "g long, piece binary")
    ranges = land(pieces.where("bucket is null").select("g", "piece").unionByName(across), "suffix-ranges")
    return packed.cogroup(ranges.groupBy("g")).applyInArrow(
        _remove(length), "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    ).withColumnRenamed("id", id_col)
