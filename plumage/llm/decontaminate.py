"""Benchmark decontamination by rare seeds and local alignment.

Word n-grams of the test items are counted over all documents; the rare ones of
each item are its seeds. A document that holds a seed has the passage around
its seeds aligned with the item's words (Smith-Waterman), which scores copies
that were edited or paraphrased in places. An item's n-grams are ranked among
themselves, so an item that leaked into a third of the corpus keeps its seeds.

Test items are a stated query set and go against all documents in blocks of
bounded size, which travel with the tasks; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm.common import LETTERS, flat_bytes, shingles, slices, words

NGRAM = 3
#: Share of an item's n-grams that are always seeds: its rarest.
RAREST = 0.5
#: Further n-grams are seeds up to this many times the documents of the rarest share.
WITHIN = 2.0
#: An item leaked if the alignment reaches this share of its best possible score.
MIN_SCORE = 0.5
#: So did a part of it with this many words' score at least, if that is also MIN_SCORE of its own passage's best.
LONG = 13
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of test items sent out at once.
BLOCK_WORDS = 1 << 18


@dataclass(frozen=True)
class Block:
    """Test items as word hashes, with their n-grams sorted for lookup."""

    ids: list[int]
    items: list[np.ndarray]
    grams: np.ndarray       # sorted distinct n-gram hashes
    entry_gram: np.ndarray  # index into grams ...
    entry_item: np.ndarray  # ... of each (n-gram, item, first position in item)
    entry_pos: np.ndarray


def blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = NGRAM,
           block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """Test items in blocks of about ``block_words`` words; items without words are left out."""
    ids, held, size = [], [], 0
    columns = items.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    for i, text in columns.where(F.col(columns.columns[0]).isNotNull()).toLocalIterator():
        hashes = _words_of([text])[0]
        if len(hashes):
            ids.append(i)
            held.append(hashes)
            size += len(hashes)
        if size >= block_words:
            yield _block(ids, held, n)
            ids, held, size = [], [], 0
    if ids:
        yield _block(ids, held, n)


def _words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, bounds = words(*flat_bytes(pa.array(texts, pa.string())), LETTERS)
    return hashes, bounds


def _block(ids: list[int], items: list[np.ndarray], n: int) -> Block:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in items])])
    grams, gram_bounds = shingles(np.concatenate(items), bounds, n)
    item = np.repeat(np.arange(len(items)), np.diff(gram_bounds))
    pos = np.arange(len(grams)) - gram_bounds[:-1][item]
    known, at = np.unique(grams, return_inverse=True)
    order = np.lexsort((pos, item, at))
    return Block(ids, items, known, at[order], item[order], pos[order])


def _hits(batch: pa.RecordBatch, grams: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Of a slice: word hashes, word bounds, and where known n-grams lie (document, word, n-gram)."""
    offsets, raw = flat_bytes(batch.column("text"))
    hashes, _, bounds = words(offsets, raw, LETTERS)
    found, gram_bounds = shingles(hashes, bounds, n)
    at = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
    hit = np.flatnonzero(grams[at] == found)
    doc = np.searchsorted(gram_bounds, hit, "right") - 1
    return hashes, bounds, doc, hit - gram_bounds[doc], at[hit]


def _count(grams: np.ndarray, n: int):
    """Documents that hold each n-gram, per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(grams), np.int64)
        for batch in slices(batches):
            _, _, doc, _, at = _hits(batch, grams, n)
            total += np.bincount(np.unique(doc * len(grams) + at) % len(grams), minlength=len(grams))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["gram", "docs"])
    return run


def seeds(block: Block, docs_per_gram: np.ndarray) -> np.ndarray:
    """Which (n-gram, item) entries are seeds: the item's rare n-grams."""
    freq = docs_per_gram[block.entry_gram]
    keep = np.zeros(len(freq), bool)
    order = np.argsort(block.entry_item, kind="stable")
    ends = np.searchsorted(block.entry_item[order], np.arange(len(block.items) + 1))
    for lo, hi in zip(ends[:-1], ends[1:]):
        mine = order[lo:hi]
        limit = np.quantile(freq[mine], RAREST, method="higher")
        keep[mine] = freq[mine] <= WITHIN * limit
    return keep


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: (score, passage start, passage end).

    Row by row over the item; gaps within a row are a running maximum.
    """
    m = len(passage)
    step = np.arange(m + 1) * GAP
    score, begin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = score[1:] + GAP
        start = np.where(diagonal >= above, begin[:-1], begin[1:])
        cell = np.maximum(diagonal, above)
        start = np.where(cell > 0, start, np.arange(1, m + 1))
        cell = np.maximum(cell, 0)
        # H[j] = max over k <= j of cell[k] + GAP * (j - k)
        lifted = cell - step[1:]
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == run, np.arange(m), 0))
        row = run + step[1:]
        score = np.concatenate([[0], np.maximum(row, 0)])
        begin = np.concatenate([[0], np.where(row > 0, start[source], np.arange(1, m + 1))])
        j = int(np.argmax(score))
        if score[j] > best[0]:
            best = (int(score[j]), int(begin[j]), j)
    return best


def _search(block: Block, seed: np.ndarray, n: int, min_score: float):
    """Leaks of a slice: passages around seeds, aligned with their items."""
    use = np.unique(block.entry_gram[seed])
    grams = block.grams[use]
    gram, item, pos = (x[seed] for x in (block.entry_gram, block.entry_item, block.entry_pos))
    first = np.searchsorted(gram, use)
    last = np.searchsorted(gram, use, "right")
    names = ["id", "item", "score", "word_start", "word_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, bounds, doc, word, at = _hits(batch, grams, n)
            n_entries = (last - first)[at]
            which = np.repeat(np.arange(len(at)), n_entries)
            entry = first[at][which] + np.arange(len(which)) - np.repeat(np.cumsum(n_entries) - n_entries, n_entries)
            d, it = doc[which], item[entry]
            # where the item would begin in the document, if the seed is in place
            origin = word[which] - pos[entry]
            order = np.lexsort((origin, it, d))
            d, it, origin = d[order], it[order], origin[order]
            size = np.array([len(x) for x in block.items])[it]
            apart = np.ones(len(d), bool)
            apart[1:] = (d[1:] != d[:-1]) | (it[1:] != it[:-1]) | (origin[1:] - origin[:-1] > size[1:])
            begins = np.flatnonzero(apart)
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            for lo, hi in zip(begins, [*begins[1:], len(d)]):
                words_in = hashes[bounds[d[lo]]:bounds[d[lo] + 1]]
                slack = int(size[lo]) // 2 + n
                left = max(0, int(origin[lo]) - slack)
                right = min(len(words_in), int(origin[hi - 1]) + int(size[lo]) + slack)
                target = block.items[it[lo]]
                score, s, e = align(target, words_in[left:right])
                share = score / (MATCH * len(target))
                key = (int(d[lo]), int(it[lo]))
                part = score >= MATCH * LONG and score >= min_score * MATCH * (e - s)
                if (share >= min_score or part) and share > best.get(key, (0.0,))[0]:
                    best[key] = (share, left + s, left + e)
            if best:
                ids = batch.column("id")
                rows = [(ids[i].as_py(), block.ids[k], *v) for (i, k), v in best.items()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))], names)
    return run


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", n: int = NGRAM,
               min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, item_id, score, word_start, word_end) of every document and test item that match.

    A match reaches ``min_score`` of the item's best score, or is a passage of
    LONG words' score at least that reaches ``min_score`` of its own best.
    ``score`` is the alignment's share of the item's best possible score, the
    words are those of the document's aligned passage (runs of letters and
    digits; ASCII case does not count). Documents or items that are NULL, empty
    or without words match nothing; items of fewer than ``n`` words are matched
    as one n-gram, so only where a document is that short; repeated rows are
    reported each; no items or no documents give an empty result; other columns
    are ignored. Every document is read over its whole text, twice.
    """
    columns = docs.select(F.col(id_col).cast("long").alias("id"),
                          F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = f"id long, {item_id} long, score double, word_start long, word_end long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(items, item_id, item_text, n, block_words):
        counted = (columns.mapInArrow(_count(block.grams, n), "gram long, docs long")
                   .groupBy("gram").agg(F.sum("docs").alias("docs")))
        per_gram = np.zeros(len(block.grams), np.int64)
        for gram, count in counted.collect():  # at most one row per n-gram of the block
            per_gram[gram] = count
        found = columns.mapInArrow(_search(block, seeds(block, per_gram), n, min_score),
                                   schema.replace(item_id, "item"))
        out = out.unionByName(found.withColumnRenamed("item", item_id))
    return out.withColumnRenamed("id", id_col)
