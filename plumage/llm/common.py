"""Helpers shared by the operators: Arrow batches as flat bytes, word hashes.

Work inside tasks is done on numpy arrays over the concatenated UTF-8 bytes of
a slice of documents; no text is turned into Python strings unless an operator
needs it. Slices are bounded in bytes (one document is never cut), so memory
does not depend on how many rows Spark packs into a batch.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumage.llm.runs import runs
from plumage.session import cut_lineage

#: Text of a slice. Workers keep what they once needed, so this bounds what every stage holds beside the JVM.
SLICE_BYTES = 512 << 10

# The separators of the word and line rules, [\x20\x09-\x0D].
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SEPARATORS)] = False
#: Bytes of letter and digit runs: ASCII letters, digits and everything above ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[48:58] = LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_MODULUS = 1 << 64
_KEPT_POWERS = 4096


@functools.lru_cache(maxsize=1)
def _kept_powers() -> np.ndarray:
    return _multiplied(_KEPT_POWERS)


def _multiplied(n: int) -> np.ndarray:
    powers = np.full(n, _R, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def powers(n: int) -> np.ndarray:
    """Powers 0..n-1 of the hash base, modulo 2**64; only short tables are kept."""
    return _kept_powers()[:n] if n <= _KEPT_POWERS else _multiplied(n)


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at every place, by doubling: a gram's sum is that of its two parts."""
    have, width = raw.astype(np.uint64) + np.uint64(1), 1
    total, done, shift = None, 0, 1
    scale = int(_R)  # the base to the power of ``width``
    while True:
        if size & width:
            if total is None:
                total, done, shift = have.copy(), width, scale
            else:
                n = min(len(total), len(have) - done)
                total = total[:n] + have[done:done + n] * np.uint64(shift)
                done, shift = done + width, shift * scale % _MODULUS
        if 2 * width > size:
            return mix(total[:len(raw) - size + 1])
        have = have[:-width] + have[width:] * np.uint64(scale)
        width, scale = 2 * width, scale * scale % _MODULUS


@functools.lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def release() -> None:
    """Give memory that is free back to the system: a worker lives on after its task, beside other workers and the JVM."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (xor-shift-multiply finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``max_bytes`` per slice.

    A single document over the bound is a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, _ = flat_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
    release()


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and the concatenated bytes of a text column."""
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) else b"")
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def words(offsets: np.ndarray, raw: np.ndarray, inside: np.ndarray = _IS_WORD,
          prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Word hashes of a slice, and where its words lie.

    Words are maximal runs of the bytes marked by ``inside`` (by default
    ``[^\\x20\\x09-\\x0D]+``) after A-Z is lower-cased. Returns the 64-bit hash
    of every word, its start byte, and ``bounds`` (n + 1): document d has the
    words ``bounds[d]:bounds[d + 1]``; then for each length in ``prefixes`` the
    hashes of the words' first bytes (of whole shorter words: 0).
    """
    at = inside[raw]
    start, end, bounds = runs(at, offsets)
    if not len(start):
        return (np.zeros(0, np.uint64), start, bounds, *[np.zeros(0, np.uint64)] * len(prefixes))
    length = end - start
    base = np.cumsum(length) - length
    place = np.arange(base[-1] + length[-1]) - np.repeat(base, length)  # of each byte in its word
    share = (_LOWER[raw[at]].astype(np.uint64) + np.uint64(1)) * powers(int(length.max()))[place]
    heads = [np.where(length > k, mix(np.add.reduceat(np.where(place < k, share, np.uint64(0)), base) + np.uint64(k)),
                      np.uint64(0)) for k in prefixes]
    return (mix(np.add.reduceat(share, base)), start, bounds, *heads)


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles per document, in text order.

    A document with 1 to n - 1 words has its whole sequence as one shingle, one
    without words has none. Returns the hashes and their bounds (documents + 1).
    """
    count = np.diff(bounds)
    per_doc = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out_bounds = np.concatenate([[0], np.cumsum(per_doc)])
    doc = np.repeat(np.arange(len(count)), per_doc)
    at = bounds[:-1][doc] + np.arange(out_bounds[-1]) - out_bounds[:-1][doc]
    length = np.minimum(count, n)[doc]
    total = length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    factor = np.uint64(1)
    for j in range(n):
        factor = np.uint64((int(factor) * 0xA24BAED4963EE407) & (2**64 - 1))
        term = padded[at + j] * factor
        total += np.where(length > j, term, np.uint64(0))
    return mix(total), out_bounds


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back (see ``cut_lineage``).

    Nothing reads the shuffle files behind a landed table again, so Spark is
    told to delete them once the table is written.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        return cut_lineage(df, name)
    finally:
        conf.set(_CLEANUP, before)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def tasks(df: DataFrame) -> int:
    """The session's shuffle width, for explicit repartitioning."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
