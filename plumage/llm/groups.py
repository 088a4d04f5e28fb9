"""Documents in hash groups, and sorted key lists as small blobs.

Some operators look up every n-gram of every document in a corpus-wide table.
One row per n-gram would shuffle many times the corpus. Instead documents are
dealt into groups by the hash of their id, about GROUP_BYTES of text each; a
group sends its distinct keys, sorted and compressed, to the shards of the
table, and gets answers back in the same order. A document's group depends on
its id alone, so a lost task gives the same groups again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm.common import release

GROUP_BYTES = 8 << 20
#: Text that a task gathers before it sends packed rows.
PACK_BYTES = 8 << 20


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]


def group_count(total_bytes: int, group_bytes: int = GROUP_BYTES) -> int:
    """Groups of about ``group_bytes``; at any size in proportion to the input."""
    return max(1, -(-total_bytes // group_bytes))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).sort_by("g")
        g = table.column("g").to_numpy()
        cuts = np.flatnonzero(np.diff(g, prepend=g[0] - 1))
        rows = table.drop(["g"])
        return pa.record_batch(
            [pa.array(g[cuts]), pa.array([to_blob(rows.slice(lo, hi - lo))
                                          for lo, hi in zip(cuts, [*cuts[1:], len(g)])], pa.binary())],
            ["g", "docs"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= PACK_BYTES:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()
    release()


def to_blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def from_blobs(blobs: pa.ChunkedArray, sort_by: list[tuple[str, str]] | None = None) -> pa.Table:
    release()  # what the group before left
    table = pa.concat_tables([pa.ipc.open_stream(b.as_buffer()).read_all() for b in blobs])
    return table.sort_by(sort_by) if sort_by else table


def one_array(column: pa.ChunkedArray) -> pa.Array:
    return pc.cast(column, pa.large_string()).combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def packed_groups(docs: DataFrame, groups: int) -> DataFrame:
    """(g, docs): the rows of ``docs`` (with its first column as the key) as blobs per group."""
    key = docs.columns[0]
    dealt = docs.withColumn("g", F.pmod(F.xxhash64(key), F.lit(groups)))
    return dealt.mapInArrow(_pack, "g long, docs binary")


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_keys(blob: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    steps = np.ascontiguousarray(flat.reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def pack_array(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack_array(blob: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)
