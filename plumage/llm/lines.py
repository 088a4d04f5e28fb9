"""Line dedup over sorted line hashes.

Every long line becomes a 128-bit hash with its document and position. The
hashes are range-partitioned together with document and position, so that a
line found in a third of all documents is spread over many ranges, and each
range is sorted and streamed once: the first document of a run (the largest id)
keeps the line, the others lose it once enough documents are seen. A run that
touches the edge of its range may go on in the next one; its members are passed
on undecided and settled by a small table of edge hashes, at most two per
range. What comes back per document is a compressed keep bitmap, no text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm.common import land, tasks, text_or_empty

# What is stripped from a line.
STRIP = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3

_LINE_SCHEMA = "h binary, id long, row long, pos int"
_RUN_SCHEMA = _LINE_SCHEMA + ", open boolean"
#: Position of a marker row: it names a document of a run, it is no line.
MARK = -1


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = {"h": pa.binary(), "id": pa.int64(), "row": pa.int64(), "pos": pa.int32(), "open": pa.bool_()}
    return pa.record_batch([pa.array(c, kinds[n]) for n, c in zip(names, zip(*rows))], list(names))


def _hash_lines(min_chars: int):
    names = ("h", "id", "row", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for i, row, text in zip(*(batch.column(k) for k in range(3))):
                i, row = i.as_py(), row.as_py()
                for p, line in enumerate(text.as_py().split("\n")):
                    if len(line) >= min_chars:
                        key = line.strip(STRIP)
                        if len(key) >= min_chars:  # lower() of bytes changes A-Z alone
                            found.append((xxhash.xxh3_128_digest(key.encode().lower()), i, row, p))
                if len(found) >= 50_000:
                    yield _rows(found, names)
                    found = []
        if found:
            yield _rows(found, names)
    return run


def _stream_runs(min_docs: int):
    """One sorted range (h, id descending, pos) -> lines to drop, and open lines.

    A run's lines wait only until ``min_docs`` documents of it are seen; from
    then on all but those of its first document stream out as dropped. The
    range's first run may have begun in an earlier range, so all its lines go
    out open. Its last run may go on: what still waits goes out open, and its
    first documents are named by marker rows.
    """
    names = ("h", "id", "row", "pos", "open")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, is_first = None, True
        ids: list[int] = []   # the run's first min_docs documents
        wait: list[tuple] | None = []
        out: list[tuple] = []
        for batch in batches:
            for h, i, row, p in zip(*(c.to_pylist() for c in batch.columns)):
                if h != current:
                    is_first = current is None
                    current, ids, wait = h, [], []
                if is_first:
                    out.append((h, i, row, p, True))
                    continue
                if len(ids) < min_docs and (not ids or ids[-1] != i):
                    ids.append(i)
                    if len(ids) == min_docs:
                        out.extend((*w, False) for w in wait if w[1] != ids[0])
                        wait = None
                if wait is not None:
                    wait.append((h, i, row, p))
                elif i != ids[0]:
                    out.append((h, i, row, p, False))
            if out:
                yield _rows(out, names)
                out = []
        if current is not None and not is_first:
            out.extend((*w, True) for w in wait or ())
            out.extend((current, i, 0, MARK, True) for i in ids)
        if out:
            yield _rows(out, names)
    return run


def _pack_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = []
        for dropped in batch.column(2):
            at = np.asarray(dropped.values)
            keep = np.ones((at.max() // 8 + 1) * 8, bool)  # whole bytes, so that no padding reads as dropped
            keep[at] = False
            bits.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(bits, pa.binary())],
                              ["id", "row", "keep_bits"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Compressed keep bitmaps of the documents that lose a line.

    Lines are split at \n. A line's key is the line stripped of
    ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased. A key of at least
    ``min_chars`` code points in at least ``min_docs`` documents keeps its lines
    only in the largest document id. Returns (id, row, keep_bits): ``row`` is
    xxhash64 of the text, so repeated ids with different texts stay apart (they
    count as one document); keep_bits is zlib over packed bits, 1 for kept, up
    to the last dropped line. NULL texts are empty; rows with a NULL id neither
    count nor lose lines; other columns are ignored.
    """
    lines = (_keyed(docs, id_col, text_col).where(F.col("id").isNotNull())
             .mapInArrow(_hash_lines(min_chars), _LINE_SCHEMA))
    order = [F.col("h"), F.col("id").desc(), F.col("row"), F.col("pos")]
    runs = land(lines.repartitionByRange(tasks(docs), *order).sortWithinPartitions(*order)
                       .mapInArrow(_stream_runs(min_docs), _RUN_SCHEMA), "line-runs")
    still = runs.where("open")
    # one row per open hash: at most two open hashes per range
    settled = (still.groupBy("h", "id").agg(F.lit(1).alias("_one")).groupBy("h")
               .agg(F.count("_one").alias("_docs"), F.max("id").alias("_top")).where(F.col("_docs") >= min_docs))
    late = (still.where(F.col("pos") != MARK).join(settled, "h").where(F.col("id") != F.col("_top"))
            .select("id", "row", "pos"))
    drops = runs.where("not open").select("id", "row", "pos").unionByName(late)
    return (drops.groupBy("id", "row").agg(F.collect_set("pos").alias("pos"))
            .mapInArrow(_pack_bits, "id long, row long, keep_bits binary"))


def kept_lines(text: str, keep_bits: bytes | None) -> tuple[list[str], int]:
    """The lines that stay, and how many there were."""
    lines = text.split("\n")
    if keep_bits is None:
        return lines, len(lines)
    keep = np.unpackbits(np.frombuffer(zlib.decompress(keep_bits), np.uint8)).astype(bool)
    return [x for k, x in enumerate(lines) if k >= len(keep) or keep[k]], len(lines)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, dropped, texts = [], [], []
        for text, bits in zip(batch.column(1), batch.column(2)):
            kept, n = kept_lines(text.as_py(), bits.as_py())
            total.append(n)
            dropped.append(n - len(kept))
            texts.append("\n".join(kept))
        yield pa.record_batch([batch.column(0), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()),
                               pa.array(texts, pa.string())], ["id", "n_lines", "n_dropped", "kept_text"])


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Texts without repeated lines: (id, n_lines, n_dropped, kept_text), one row per row.

    See :func:`keep_bitmaps` for the rule and for NULL, empty and repeated rows.
    """
    bits = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    return (_keyed(docs, id_col, text_col).join(bits, ["id", "row"], "left").select("id", "text", "keep_bits")
            .mapInArrow(_apply, "id long, n_lines long, n_dropped long, kept_text string")
            .withColumnRenamed("id", id_col))
