"""Grouping of spelling variants by FM-index search schemes.

Two words are near if one inserted, deleted or replaced character turns one
into the other. Cut a word in two halves: an error lies in one of them, so a
near word holds the other half exactly, at its beginning or at its end. The
search scheme matches one half exactly and extends across the other, allowing
one error, in the index of that direction: the half at the end in an FM-index
of the delimited vocabulary, the half at the beginning in one of the reversed
words. A pair that both directions find counts where the first half is exact.

An index holds the words of one block, its symbols 0 (the delimiter, one per
word) and the characters' codes. Suffixes end at their word's delimiter and
delimiters are ordered by word, so the suffixes that begin a word stand in the
order of the words: the rank that a last step with the delimiter gives is the
word itself. Intervals of suffix ranks are kept for all searches of a block in
flat arrays.

Blocks come from what must be equal: words are dealt by the two characters
they begin with and by the three they end with (every exact half is at least
that long, words have MIN_LENGTH characters or more). Keys of more than
SPLIT words are cut into parts, and every part of the index meets every part of
the searching words in a block of its own, so no block grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumage.llm import crc
from plumage.llm.common import flat_bytes, land, slices, tasks, text_or_empty
from plumage.llm.runs import runs

MIN_LENGTH = 5
MIN_COUNT = 3
#: Characters that a near word shares with a word whose first or last half it holds.
BEGIN, FINISH = 2, 3
#: Words of one key in a block; a block of several keys has about as many.
SPLIT = 1 << 15
#: Searches extended together: bounds the arrays of a step.
TOGETHER = 2048
SLICE = 1 << 20
#: One code point in so many occurrences loses a character (the contract's noise).
NOISE = 97

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LEAD = 0xC3  # UTF-8: U+00C0 to U+00FF is this byte and one more


# --- the vocabulary -------------------------------------------------------------

def _count_words(noise: int, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE):
            offsets, raw = flat_bytes(batch.column("text"))
            lead = raw == _LEAD
            inside = _LETTER[raw] | lead
            inside[1:] |= lead[:-1]
            start, end, bounds = runs(inside, offsets)
            if not len(start):
                continue
            low = np.where(inside, _LOWER[raw], raw)
            characters = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
            length = characters[end] - characters[start]
            keep = inside
            if noise:
                prefix = [f"{'' if i is None else i}:".encode() for i in batch.column("id").to_pylist()]
                flat = np.frombuffer(b"".join(prefix), np.uint8)
                ends = np.cumsum([len(p) for p in prefix])
                of_id = crc.crc_of_runs(flat, ends - [len(p) for p in prefix], ends)
                h = crc.append(np.repeat(of_id, np.diff(bounds)), crc.crc_of_runs(low, start, end), end - start)
                hit = np.flatnonzero(h % np.uint32(noise) == 0)
                gone = characters[start[hit]] + h[hit].astype(np.int64) % length[hit]
                keep = inside.copy()
                keep[np.isin(characters[1:] - 1, gone)] = False
                length[hit] -= 1
            kept_at = np.concatenate([[0], np.cumsum(keep)])
            bounds = np.append(kept_at[start], kept_at[-1])
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [
                None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(low[keep])])
            counted = pc.value_counts(words.filter(pa.array(length >= min_length)))
            yield pa.record_batch([counted.field("values").cast(pa.large_string()).cast(pa.string()),
                                   counted.field("counts")], ["word", "n"])
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, noise: int = 0) -> DataFrame:
    """(word, n): words of the texts that occur ``min_count`` times or more.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least
    ``min_length`` characters. With ``noise``, every occurrence whose checksum
    (of id, colon and word) it divides loses one character first. A NULL text
    has no words, a NULL id counts as empty. Counted per slice, then per word.
    """
    columns = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    counted = columns.mapInArrow(_count_words(noise, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- the index -------------------------------------------------------------------

class Index:
    """FM-index over sorted words (Latin-1 bytes, none of them 0), each ended by the delimiter 0."""

    def __init__(self, words: list[bytes]):
        text = np.frombuffer(b"\0".join([*words, b""]), np.uint8).astype(np.int64)
        self.size, self.words = len(text), len(words)
        delimiter = text == 0
        rank = text + len(words)
        rank[delimiter] = np.arange(len(words))
        self.order = order = _suffix_order(rank)
        before = np.where(order > 0, text[order - 1], 0)
        # (symbol, row) in order: a row's place among them is where its suffix goes with the symbol put before it
        self.steps = np.sort(before * (self.size + 1) + np.arange(self.size))
        self.alphabet = np.unique(before[before > 0])

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """First row at or after which the suffixes of ``row`` on lie once ``symbol`` is put before them."""
        return np.searchsorted(self.steps, symbol * (self.size + 1) + row)


def _suffix_order(rank: np.ndarray) -> np.ndarray:
    """Suffixes in order; every word's delimiter has a rank of its own, so no suffix is compared beyond it."""
    n, width = len(rank), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if new.max() == n - 1 or width >= n:
            return order
        rank, width = new, 2 * width


def search(index: Index, flat: np.ndarray, start: np.ndarray, length: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(search, word) with exactly one error among the first ``free`` characters of each searching word.

    Word i is ``flat[start[i]:start[i] + length[i]]``; its last characters are
    matched from the right, then the free ones are extended leftwards.
    """
    low = np.zeros(len(start), np.int64)
    high = np.full(len(start), index.words, np.int64)
    who = np.arange(len(start))
    left = length.copy()  # characters not matched yet
    done: list[tuple[np.ndarray, ...]] = []
    while len(who):
        ready = left == free[who]
        if ready.any():
            done.append((who[ready], low[ready], high[ready]))
            who, left, low, high = who[~ready], left[~ready], low[~ready], high[~ready]
            continue
        symbol = flat[start[who] + left - 1]
        low, high = index.step(symbol, low), index.step(symbol, high)
        some = low < high
        who, left, low, high = who[some], left[some] - 1, low[some], high[some]
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    who, low, high = (np.concatenate(x) for x in zip(*done))
    found = [_extend(index, flat, start, free, who[i:i + TOGETHER], low[i:i + TOGETHER], high[i:i + TOGETHER])
             for i in range(0, len(who), TOGETHER)]
    pairs = np.unique(np.concatenate([a * np.int64(index.words) + b for a, b in found]))
    return pairs // index.words, pairs % index.words


def _extend(index: Index, flat: np.ndarray, start: np.ndarray, free: np.ndarray, who: np.ndarray, low: np.ndarray,
            high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Extend exact halves over the free characters with one error."""
    left = free[who]
    none = np.zeros(0, np.int64)
    wrong = [none, none, none, none]  # searches that have had their error: who, left, low, high
    hits = []
    while len(who) or len(wrong[0]):
        # the error comes here: any symbol beside (inserted), instead of (replaced) or nothing for (deleted) the next one
        size = len(index.alphabet)
        owner = np.repeat(np.arange(len(who)), size)
        symbol = np.tile(index.alphabet, len(who))
        lo, hi = index.step(symbol, low[owner]), index.step(symbol, high[owner])
        some = lo < hi
        owner, symbol, lo, hi = owner[some], symbol[some], lo[some], hi[some]
        more = left > 0
        following = np.where(more, flat[start[who] + np.maximum(left - 1, 0)], -1)
        exact = symbol == following[owner]
        other = ~exact & more[owner]
        after = [np.concatenate(x) for x in zip(
            wrong,
            (who[owner], left[owner], lo, hi),
            (who[owner[other]], left[owner[other]] - 1, lo[other], hi[other]),
            (who[more], left[more] - 1, low[more], high[more]))]
        who, left, low, high = who[owner[exact]], left[owner[exact]] - 1, lo[exact], hi[exact]
        # one exact step for those with the error behind them; at the word's beginning the delimiter names the word
        ends = after[1] == 0
        first, last = (index.step(np.zeros(ends.sum(), np.int64), x[ends]) for x in after[2:])
        count = last - first
        hits.append((np.repeat(after[0][ends], count),
                     np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)))
        w, l, a, b = (x[~ends] for x in after)
        symbol = flat[start[w] + l - 1]
        a, b = index.step(symbol, a), index.step(symbol, b)
        some = a < b
        wrong = [w[some], l[some] - 1, a[some], b[some]]
    return tuple(np.concatenate(x) for x in zip(*hits))


# --- blocks ----------------------------------------------------------------------

def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.array([len(w) for w in words], np.int64)
    return np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.cumsum(length) - length, length


def _search_block(table: pa.Table) -> pa.Table:
    """One row per searching word of a block: how many near words, and the most frequent one."""
    by_end = bool(table.column("by_end")[0].as_py())
    spelled = np.array([w.encode("latin-1") for w in table.column("word").to_pylist()], object)
    count = table.column("n").to_numpy()
    held, seeks = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("held", "seeks"))
    asked = [(w, n) for w, n in zip(spelled[seeks], count[seeks])]
    near, best_n, best_word = [0] * len(asked), [None] * len(asked), [None] * len(asked)
    if held.any() and asked:
        turn = (lambda w: w) if by_end else (lambda w: w[::-1])
        entries = sorted(zip((turn(w) for w in spelled[held]), count[held]))
        words, often = [w for w, _ in entries], [int(n) for _, n in entries]
        flat, start, length = _flat([turn(w) for w, _ in asked])
        half = length // 2
        index = Index(words)
        for i, j in zip(*(x.tolist() for x in search(index, flat, start, length, half if by_end else length - half))):
            mine, other = asked[i][0], turn(words[j])
            if by_end and other[:half[i]] == mine[:half[i]]:
                continue  # found by its first half as well, and counted there
            near[i] += 1
            if best_n[i] is None or (-often[j], other) < (-best_n[i], best_word[i]):
                best_n[i], best_word[i] = often[j], other
    return pa.table({
        "word": pa.array([w.decode("latin-1") for w, _ in asked], pa.string()),
        "n": pa.array([int(n) for _, n in asked], pa.int64()), "n_near": pa.array(near, pa.int64()),
        "best_n": pa.array(best_n, pa.int64()),
        "best": pa.array([None if w is None else w.decode("latin-1") for w in best_word], pa.string())})


def near_words(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """(word, n, n_near, best, best_n): near words of each word and the most frequent, ties to the smallest.

    ``words`` is a landed table of distinct (word, n) of MIN_LENGTH characters or
    more, in characters up to U+00FF. Every word searches all others; a word
    without near words has n_near 0 and NULLs.
    """
    sides = F.explode(F.array(
        F.struct(F.lit(False).alias("by_end"), F.substring("word", 1, BEGIN).alias("key")),
        F.struct(F.lit(True).alias("by_end"), F.substring("word", -FINISH, FINISH).alias("key"))))
    keyed = words.select("word", "n", sides.alias("side")).select("word", "n", "side.*")
    sizes = keyed.groupBy("by_end", "key").agg(F.count(F.lit(1)).alias("size"))
    large = land(sizes.where(F.col("size") > split).select(
        "by_end", "key", F.ceil(F.col("size") / split).cast("int").alias("parts")), "spelling-large-keys")
    total = words.count()
    bins = max(tasks(words), -(-total // split))
    parts = F.coalesce("parts", F.lit(1))
    dealt = keyed.join(large, ["by_end", "key"], "left").withColumn("parts", parts).withColumn(
        "own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    # a part holds its words in a row of blocks and searches in a column of them; one part is one block
    meets = F.sequence(F.lit(0), F.col("parts") - 1)
    cells = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.array_distinct(F.concat(F.transform(meets, lambda x: F.struct(F.col("own").alias("i"), x.alias("j"))),
                                  F.transform(meets, lambda x: F.struct(x.alias("i"), F.col("own").alias("j"))))))
    placed = dealt.withColumn("cell", F.explode(cells))
    block = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("key"), F.lit(bins))).otherwise(
        F.xxhash64("key", "cell.i", "cell.j"))
    rows = placed.select(
        "by_end", "word", "n", (F.col("parts") == 1).alias("small"), block.alias("block"),
        ((F.col("parts") == 1) | (F.col("cell.i") == F.col("own"))).alias("held"),
        ((F.col("parts") == 1) | (F.col("cell.j") == F.col("own"))).alias("seeks"))
    found = rows.groupBy("by_end", "small", "block").applyInArrow(
        _search_block, "word string, n long, n_near long, best_n long, best string")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) with ``root``: the last word on the way over the forms (the word itself without one).

    Each round doubles the way looked ahead, so a chain of length n takes log2(n) + 1
    joins. A form is at least twice as frequent as its word: no chain is a circle.
    """
    at = land(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("over"), F.col("root").alias("next")).where("over <> next")
        moved = land(at.join(ahead, F.col("root") == F.col("over"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.drop("moved")
        if not moved.where("moved").take(1):
            return at


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                   min_count: int = MIN_COUNT, times: int = 2, noise: int = 0, split: int = SPLIT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the texts (see :func:`vocabulary`).

    A word's form is its most frequent near word (ties: the smallest) if that is
    at least ``times`` as frequent, else NULL; its root is the end of the way
    over forms. Repeated rows count as often as they stand. An empty table, or
    texts without such words, give an empty result; other columns are ignored.
    """
    if min_length < BEGIN + FINISH:
        raise ValueError(f"words must have at least {BEGIN + FINISH} characters")
    words = land(vocabulary(docs, id_col, text_col, min_length, min_count, noise), "spelling-words")
    near = near_words(words, split)
    formed = F.col("best_n") >= times * F.col("n")
    formed = land(near.select("word", "n", "n_near", F.when(formed, F.col("best")).alias("form"),
                              F.when(formed, F.col("best_n")).alias("form_n")), "spelling-forms")
    return formed.join(roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n")
