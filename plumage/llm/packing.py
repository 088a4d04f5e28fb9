"""Packing by concatenate and cut.

Every document becomes its token ids and an end id. A task gives its documents
running token offsets; the tokenized table is written once, the tasks' totals
(one number per task) are summed to global offsets, and a second pass cuts the
stream into fixed windows. A document that crosses a window's edge leaves one
boundary record per piece. No token is shuffled and nothing is sorted.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumage.llm.common import land, release

SEQUENCE = 2048
END_ID = 1
#: Words whose ids a Python worker remembers in each of two generations (bounds its memory).
REMEMBERED = 3 << 17

_TOKEN_SCHEMA = "id long, task int, task_start long, doc_tokens long, ids binary"
PIECES = "{id} long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# Fixed value: the split rule of the tokenizer that WordIds knows.
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _has_these_rules(spec: dict) -> bool:
    """Whether a tokenizer file normalises, splits and merges as :class:`WordIds` does."""
    normal = (spec.get("normalizer") or {}).get("normalizers", [])
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return ([n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"]
            and normal[1]["pattern"] == {"Regex": r"\s+"} and normal[1]["content"] == " "
            and [t["type"] for t in split] == ["Split", "ByteLevel"]
            and split[0]["pattern"] == {"Regex": SPLIT_RULE} and split[0]["behavior"] == "Removed" and split[0]["invert"]
            and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
            and spec["model"]["type"] == "BPE" and not any(t["normalized"] for t in spec["added_tokens"]))


class WordIds(dict):
    """Ids of blank-separated words, as bytes; words not yet seen are encoded.

    The tokenizer lower-cases, splits a word into letter runs, single digits
    and other runs, and encodes each by itself, so a text's ids are its words'
    ids in a row. That holds for characters below U+0250 whose lower case is
    below U+0250 as well (there every string is in normal form C, and case maps
    one to one); texts with others go through the whole tokenizer, as do special
    tokens' strings, and all texts if the file has other rules than these.
    """

    _old: dict[str, bytes]  # the generation before: what is still in use moves to the new one

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        small = [chr(c) for c in range(0x250)]
        letters = re.escape("".join(c for c in small if unicodedata.category(c)[0] == "L"))
        numbers = re.escape("".join(c for c in small if unicodedata.category(c)[0] == "N"))
        # The tokenizer's split rule and its white space below U+0250
        blank = "\t-\r \x85\xa0"
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{blank}{letters}{numbers}]+")
        spec = json.loads(self.whole.to_str())
        special = [t["content"] for t in spec["added_tokens"]]
        leave = "".join(c for c in small if len(c.lower()) > 1 or c.lower() not in small)
        self.other = re.compile(f"[^\x00-ɏ]|[{leave}]|" + "|".join(map(re.escape, special)))
        if not _has_these_rules(spec):
            self.other = re.compile("")
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        # byte-level alphabet: printable bytes stand for themselves, the others follow U+0100
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self._old = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _encoded(self, piece: str) -> bytes:
        mapped = "".join(map(self.alphabet.__getitem__, piece.encode()))
        return self._bytes([t.id for t in self.model.tokenize(mapped)])

    def __missing__(self, word: str) -> bytes:
        found = self._old.pop(word, None)
        if found is None:
            pieces = self.split.findall(word)
            # a piece is a word of one piece: one table for both
            found = self._encoded(word) if pieces == [word] else b"".join(map(self.__getitem__, pieces))
        if len(self) >= REMEMBERED:
            self._old = dict(self)
            self.clear()
        self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if self.other.search(text):
            return self._bytes(self.whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.lower().replace("\n", " ").split(" ")))


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One table per worker and tokenizer file, kept while the worker lives."""
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_ids(path)
        end = np.array([end_id], table.dtype).tobytes()
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ids = [table.encode(t.as_py() or "") + end for t in part.column(1)]
                n = np.array([len(x) // table.dtype.itemsize for x in ids], np.int64)
                starts = at + np.concatenate([[0], np.cumsum(n)[:-1]])
                at += int(n.sum())
                yield pa.record_batch(
                    [part.column(0), pa.array(np.full(len(n), task, np.int32)), pa.array(starts), pa.array(n),
                     pa.array(ids, pa.binary())], ["id", "task", "task_start", "doc_tokens", "ids"])
        release()
    return run


def _cut(sequence: int, itemsize: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0].format(id="id") for c in PIECES.split(", ")]
        kinds = [pa.int64()] * len(names)
        for batch in batches:
            out: list[tuple] = []
            for i, begin, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                wide = np.frombuffer(ids, f"<u{itemsize}").astype("<u4")
                at = 0
                while at < n:
                    number, offset = divmod(begin + at, sequence)
                    length = min(n - at, sequence - offset)
                    crc = zlib.crc32(wide[at:at + length].tobytes())
                    out.append((i, at, length, crc, n, number, offset))
                    at += length
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    return run


def tokenized(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID) -> DataFrame:
    """Written once: (id, task, task_start, doc_tokens, ids) with running starts per task."""
    columns = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return land(columns.mapInArrow(_tokenize(tokenizer, end_id), _TOKEN_SCHEMA), "packing-tokens")


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, id_col: str = "doc_id",
         text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents in sequences of exactly ``sequence`` tokens (the last may be shorter).

    Returns (id, start, length, ids_crc32, doc_tokens, sequence_id, offset). A
    NULL or empty text is its end id alone; repeated rows are packed each; a
    document longer than a sequence fills as many as it needs; an empty table
    gives an empty result; other columns are ignored. Which document comes
    after which follows the table's files and is not part of the contract.
    """
    tokens = tokenized(docs, tokenizer, id_col, text_col, end_id)
    itemsize = word_ids(tokenizer).dtype.itemsize
    totals = tokens.groupBy("task").agg(F.max(F.col("task_start") + F.col("doc_tokens")).alias("_n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task of the first pass: bounded by its number of file splits
    base = totals.select("task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    placed = tokens.join(F.broadcast(base), "task").select(
        "id", (F.col("_base") + F.col("task_start")).alias("begin"), "doc_tokens", "ids")
    return placed.mapInArrow(_cut(sequence, itemsize), PIECES.format(id="id")).withColumnRenamed("id", id_col)
