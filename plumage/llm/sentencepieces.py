"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The work on a slice of documents is a few numpy passes:

* a text becomes words, each starting at a run of spaces (no piece of the
  vocabulary has a space after another character, checked on loading), and
  equal words of a slice are encoded once;
* a word is cut where two neighbouring characters never stand together inside a
  piece: no merge can cross there, so a cut changes nothing, and even a text
  without spaces falls into short segments;
* all segments lie in one flat symbol array. A round takes the best pair of
  every segment (segmented minimum of pair ranks), merges all its occurrences
  that do not overlap, leftmost first, and closes the gaps; segments without a
  pair leave the array. Rounds end when no segment is left.

The library merges one pair at a time and looks again after each. A merged
piece may make a pair at least as good as the one just merged; then the later
occurrences in that segment wait for the next round, which keeps the order of
the library. Pieces of spaces share one score, so leftmost-first cuts a run of
spaces left over at the end into the longest pieces from the left.

Characters outside the vocabulary become their UTF-8 bytes' pieces. Nothing is
shuffled: each task works on its own rows.
"""

from __future__ import annotations

import codecs
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumage.llm.common import flat_bytes, slices, text_or_empty

SPACE = "▁"
# Piece types of the model file, and the text that stands for an unknown piece.
_NORMAL, _UNKNOWN, _CONTROL, _UNUSED, _BYTE = 1, 2, 3, 5, 6
_BPE = 2
UNKNOWN_TEXT = " ⁇ "
REPLACEMENT = "\ufffd"
SLICE = 1 << 20
_NONE = np.int32(np.iinfo(np.int32).max)


@dataclass
class Tables:
    """What the rounds look up, from a model file."""

    char_id: np.ndarray      # code point -> piece id, -1 if none
    inner: np.ndarray        # sorted (code point << 21 | next code point) found inside pieces
    pair_key: np.ndarray     # sorted left id * size + right id
    pair_piece: np.ndarray   # the merged piece
    rank: np.ndarray         # piece id -> rank, the best score first, equal scores alike
    byte_id: np.ndarray      # byte -> piece id
    run_id: np.ndarray       # length -> piece of so many spaces (-1: none); empty if runs have no own rule
    run_end: list[list[int]]  # length below the longest -> lengths that such a run of spaces is cut into
    text: np.ndarray         # pieces' bytes for decoding, one after the other
    text_at: np.ndarray      # bounds in ``text`` per piece id
    spaced: np.ndarray       # piece id -> starts with a space
    is_byte: np.ndarray      # piece id -> byte piece

    def merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of each pair of ids (no such piece: _NONE as its rank)."""
        key = left * np.int64(len(self.rank)) + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        piece = self.pair_piece[at]
        found = (self.pair_key[at] == key) & (left >= 0) & (right >= 0)
        return piece, np.where(found, self.rank[piece], _NONE)


@functools.lru_cache(maxsize=4)
def load_tables(model: bytes) -> Tables:
    """Tables of a serialised model; ValueError for models with other rules than implemented here."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(model)
    norm = spec.normalizer_spec
    kinds = np.array([p.type for p in spec.pieces])
    if (spec.trainer_spec.model_type != _BPE or not spec.trainer_spec.byte_fallback or norm.precompiled_charsmap
            or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces
            or spec.trainer_spec.treat_whitespace_as_suffix or spec.denormalizer_spec.precompiled_charsmap
            or not np.isin(kinds, [_NORMAL, _UNKNOWN, _CONTROL, _BYTE]).all()):
        raise ValueError("only BPE models with byte fallback, identity normalisation, a space before the text and "
                         "no user-defined or unused pieces")
    pieces = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == _NORMAL}
    if any(b == SPACE and a != SPACE for piece in pieces for a, b in zip(piece, piece[1:])):
        raise ValueError("a piece has a space after another character")

    size = len(spec.pieces)
    _, rank = np.unique([-p.score for p in spec.pieces], return_inverse=True)
    char_id = np.full(0x110000, -1, np.int32)
    inner, pairs = set(), {}
    for piece, i in pieces.items():
        if len(piece) == 1:
            char_id[ord(piece)] = i
        inner.update(ord(a) << 21 | ord(b) for a, b in zip(piece, piece[1:]))
        for cut in range(1, len(piece)):
            left, right = pieces.get(piece[:cut]), pieces.get(piece[cut:])
            if left is not None and right is not None:
                pairs[left * size + right] = i
    keys = np.array(sorted(pairs), np.int64)

    run_id, run_end = _space_runs(pieces, rank)
    if len(run_id):  # left to the last step
        keys = keys[~np.isin([pairs[k] for k in keys.tolist()], run_id)]

    byte_id = np.full(256, -1, np.int32)
    texts = []
    for i, p in enumerate(spec.pieces):
        if p.type == _BYTE:
            byte_id[int(p.piece[3:5], 16)] = i
            texts.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type == _UNKNOWN:
            texts.append(UNKNOWN_TEXT.encode())
        elif p.type == _CONTROL:
            texts.append(b"")
        else:
            texts.append(p.piece.replace(SPACE, " ").encode())
    return Tables(char_id, np.array(sorted(inner), np.int64), keys,
                  np.array([pairs[k] for k in keys.tolist()], np.int32), rank.astype(np.int32), byte_id, run_id, run_end,
                  np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]),
                  np.array([p.type == _NORMAL and p.piece.startswith(SPACE) for p in spec.pieces]), kinds == _BYTE)


def _space_runs(pieces: dict[str, int], rank: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Pieces of spaces by length and how short runs are cut; empty if they are ordinary pieces.

    They have their own rule if they share one score below all other merges and
    nothing else holds two spaces: then they merge last, leftmost first, and a
    long run loses its longest piece from the left over and over.
    """
    none = np.zeros(0, np.int32), []
    sizes = {len(p): i for p, i in pieces.items() if set(p) == {SPACE}}
    longest = max(sizes, default=1)
    scores = {rank[i] for n, i in sizes.items() if n > 1}
    others = [rank[i] for p, i in pieces.items() if len(p) > 1 and set(p) != {SPACE}]
    if (longest < 2 or 1 not in sizes or len(scores) != 1 or max(others, default=-1) >= min(scores)
            or any(SPACE * 2 in p and set(p) != {SPACE} for p in pieces)):
        return none

    def cut(n: int) -> list[int]:
        parts = [1] * n
        while True:
            at = next((i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in sizes), None)
            if at is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    if any(cut(n) != [longest, *cut(n - longest)] for n in range(longest, 4 * longest)):
        return none
    run_id = np.full(longest + 1, -1, np.int32)
    run_id[list(sizes)] = list(sizes.values())
    return run_id, [cut(n) for n in range(longest)]


def _code_points(raw: np.ndarray) -> np.ndarray:
    return np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)


def _merge_rounds(sym: np.ndarray, start: np.ndarray, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Merge within segments until no pair is left; symbols that went are -1 in the result.

    ``start`` marks the first symbol of each segment. Returns the symbols in
    their first places and a mask of those that remain.
    """
    result, left_over = sym.copy(), np.ones(len(sym), bool)
    at = np.arange(len(sym))  # where each active symbol stands in the result
    head = np.flatnonzero(start)
    seg = np.cumsum(start) - 1
    piece = np.full(len(sym), -1, np.int32)
    rank = np.full(len(sym), _NONE)
    piece[:-1], rank[:-1] = tables.merged(sym[:-1].astype(np.int64), sym[1:].astype(np.int64))
    rank[head[1:] - 1] = _NONE
    while True:
        best = np.minimum.reduceat(rank, head)
        alive = best != _NONE
        if not alive.all():
            stay = alive[seg]
            sym, at, piece, rank, seg = sym[stay], at[stay], piece[stay], rank[stay], seg[stay]
            best = best[alive]
            if not len(sym):
                return result, left_over
            first = np.empty(len(seg), bool)
            first[0], first[1:] = True, seg[1:] != seg[:-1]
            head, seg = np.flatnonzero(first), np.cumsum(first) - 1
        hit = np.flatnonzero(rank == best[seg])
        # in a run of overlapping pairs every other one, from the left
        opens = np.empty(len(hit), bool)
        opens[0], opens[1:] = True, np.diff(hit) > 1
        opens[1:] |= seg[hit[1:]] != seg[hit[:-1]]
        order = np.arange(len(hit))
        hit = hit[(order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0]
        if len(hit) > len(best):
            hit = _in_turn(hit, sym, piece, rank, seg, tables)
        new = piece[hit]
        sym[hit] = new
        result[at[hit]] = new
        left_over[at[hit + 1]] = False
        stay = np.ones(len(sym), bool)
        stay[hit + 1] = False
        sym, at, piece, rank, seg = sym[stay], at[stay], piece[stay], rank[stay], seg[stay]
        changed = hit - np.arange(len(hit))  # each merge before took one symbol away
        first = np.empty(len(seg), bool)
        first[0], first[1:] = True, seg[1:] != seg[:-1]
        head = np.flatnonzero(first)
        look = np.unique(np.concatenate([changed, changed[changed > 0] - 1]))
        inside = look[look + 1 < len(seg)]
        inside = inside[seg[inside] == seg[inside + 1]]
        rank[look] = _NONE
        piece[inside], rank[inside] = tables.merged(sym[inside].astype(np.int64), sym[inside + 1].astype(np.int64))


def _in_turn(hit: np.ndarray, sym: np.ndarray, piece: np.ndarray, rank: np.ndarray, seg: np.ndarray,
             tables: Tables) -> np.ndarray:
    """The merges of ``hit`` up to the first of each segment after which a pair as good would come first."""
    n = len(sym)
    new = piece[hit].astype(np.int64)
    joined = np.zeros(len(hit), bool)
    joined[1:] = (hit[1:] - hit[:-1] == 2) & (seg[hit[1:]] == seg[hit[:-1]])
    before = np.maximum(hit - 1, 0)
    left = np.where(joined, np.concatenate([[0], new[:-1]]), sym[before])
    left = np.where((hit > 0) & (seg[before] == seg[hit]), left, -1)
    after = np.minimum(hit + 2, n - 1)
    right = np.where((hit + 2 < n) & (seg[after] == seg[hit]), sym[after], -1).astype(np.int64)
    good = rank[hit]
    stops = (tables.merged(left, new)[1] <= good) | (tables.merged(new, right)[1] <= good)
    passed = np.cumsum(stops) - stops  # stops before each merge
    of = seg[hit]
    opens = np.empty(len(hit), bool)
    opens[0], opens[1:] = True, of[1:] != of[:-1]
    base = np.maximum.accumulate(np.where(opens, passed, 0))
    return hit[passed == base]


def _encode_words(offsets: np.ndarray, raw: np.ndarray, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words ``offsets`` of ``raw`` (UTF-8, spaces as U+0020), one after the other, and their bounds."""
    if not len(raw):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    starts_char = (raw & 0xC0) != 0x80
    chars = _code_points(raw)
    chars[chars == 0x20] = ord(SPACE)
    char_at = np.concatenate([[0], np.cumsum(starts_char)])
    bounds = char_at[offsets]
    sym = tables.char_id[chars]
    cut = np.ones(len(chars), bool)
    key = chars[:-1] << 21 | chars[1:]
    place = np.minimum(np.searchsorted(tables.inner, key), len(tables.inner) - 1)
    cut[1:] = tables.inner[place] != key
    cut[bounds[:-1]] = True
    ids, left_over = _merge_rounds(sym, cut, tables)
    if len(tables.run_id):
        _merge_spaces(ids, left_over, bounds, tables)
    # characters without a piece give one id per byte
    unknown = left_over & (ids < 0)
    count = left_over.astype(np.int64)
    byte_start = np.flatnonzero(starts_char)
    byte_count = np.diff(np.append(byte_start, len(raw)))
    count[unknown] = byte_count[unknown]
    ends = np.concatenate([[0], np.cumsum(count)])
    out = np.repeat(ids, count)
    if unknown.any():
        which = np.flatnonzero(unknown)
        nth = np.arange(byte_count[which].sum()) - np.repeat(np.cumsum(byte_count[which]) - byte_count[which],
                                                              byte_count[which])
        out[np.repeat(ends[which], byte_count[which]) + nth] = tables.byte_id[
            raw[np.repeat(byte_start[which], byte_count[which]) + nth]]
    return out, ends[bounds]


def _merge_spaces(ids: np.ndarray, left_over: np.ndarray, bounds: np.ndarray, tables: Tables) -> None:
    """Cut the runs of single spaces that the rounds left into the longest pieces, from the left."""
    longest = len(tables.run_id) - 1
    lone = left_over & (ids == tables.run_id[1])
    opens = lone.copy()
    opens[1:] &= ~lone[:-1]
    opens[bounds[:-1][bounds[:-1] < len(ids)]] |= lone[bounds[:-1][bounds[:-1] < len(ids)]]
    begin = np.flatnonzero(opens)
    closes = lone.copy()
    closes[:-1] &= ~lone[1:] | opens[1:]
    length = np.flatnonzero(closes) + 1 - begin
    left_over[lone] = False
    full = length // longest
    run = np.repeat(np.arange(len(begin)), full)
    here = begin[run] + (np.arange(len(run)) - np.repeat(np.cumsum(full) - full, full)) * longest
    left_over[here] = True
    ids[here] = tables.run_id[longest]
    rest, rest_at = length % longest, begin + full * longest
    for n in np.unique(rest):
        place = rest_at[rest == n]
        for part in tables.run_end[n]:
            left_over[place] = True
            ids[place] = tables.run_id[part]
            place = place + part


def _joined(before: str, texts: pa.Array) -> pa.Array:
    kind = pa.large_string()
    return pc.binary_join_element_wise(pa.scalar(before, kind), texts, pa.scalar("", kind))


def encode_flat(texts: pa.Array, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """All ids of ``texts`` one after the other, and bounds (n + 1). NULL counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pc.replace_substring(texts, SPACE, " ")
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", _joined(" ", texts))
    offsets, raw = flat_bytes(texts)
    blank = raw == 0x20
    starts = blank.copy()
    starts[1:] &= ~blank[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[heads] = True
    word_at = np.append(np.flatnonzero(starts), len(raw))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(word_at) - 1,
                                             [None, pa.py_buffer(word_at.astype(np.int64)), pa.py_buffer(raw)])
    coded = words.dictionary_encode()
    ids, bounds = _encode_words(*flat_bytes(coded.dictionary), tables)
    code = coded.indices.to_numpy()
    count = np.diff(bounds)[code]
    ends = np.concatenate([[0], np.cumsum(count)])
    flat = ids[np.repeat(bounds[:-1][code] - ends[:-1], count) + np.arange(ends[-1])]
    return flat, ends[np.searchsorted(word_at[:-1], offsets)]


def decode_flat(ids: np.ndarray, bounds: np.ndarray, tables: Tables) -> pa.Array:
    """The texts of id sequences ``bounds`` of ``ids``; the space before the first piece goes."""
    count = np.diff(tables.text_at)[ids]
    ends = np.concatenate([[0], np.cumsum(count)])
    raw = tables.text[np.repeat(tables.text_at[:-1][ids] - ends[:-1], count) + np.arange(ends[-1])]
    offsets = ends[bounds]
    # control pieces have no text: the first piece with one is the one that may lose its space
    shown = np.flatnonzero(count > 0)
    some = np.flatnonzero(np.diff(bounds))
    if len(shown) and len(some):
        first = shown[np.minimum(np.searchsorted(shown, bounds[:-1][some]), len(shown) - 1)]
        lose = (first < bounds[1:][some]) & (first >= bounds[:-1][some]) & tables.spaced[ids[first]]
        keep = np.ones(len(raw), bool)
        keep[ends[first[lose]]] = False
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        raw = raw[keep]
    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1,
                                           [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
    hard = _hard_rows(ids, bounds, raw, offsets, tables)
    if len(hard):
        texts = out.to_pylist()
        for row in hard:
            texts[row] = _decode_row(ids[bounds[row]:bounds[row + 1]], tables)
        return pa.array(texts, pa.large_binary()).cast(pa.large_string())
    return out.cast(pa.large_string())


def _hard_rows(ids: np.ndarray, bounds: np.ndarray, raw: np.ndarray, offsets: np.ndarray, tables: Tables) -> np.ndarray:
    """Rows with byte pieces whose bytes may not be whole characters."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    with_bytes = np.unique(row[tables.is_byte[ids]])
    return np.array([r for r in with_bytes.tolist() if not _is_utf8(raw[offsets[r]:offsets[r + 1]])
                     or (np.diff(tables.text_at)[ids[bounds[r]:bounds[r + 1]]] == 0).any()], np.int64)


def _is_utf8(raw: np.ndarray) -> bool:
    try:
        raw.tobytes().decode()
    except UnicodeDecodeError:
        return False
    return True


def _decode_row(ids: np.ndarray, tables: Tables) -> bytes:
    """One text piece by piece: in a run of byte pieces each byte outside a character becomes U+FFFD."""
    parts: list[bytes] = []
    lose = True  # the space before the first shown piece
    cuts = np.flatnonzero(np.diff(tables.is_byte[ids])) + 1
    for group in np.split(ids, cuts):
        texts = [tables.text[tables.text_at[i]:tables.text_at[i + 1]].tobytes() for i in group]
        if tables.is_byte[group[0]]:
            parts.append(_readable(b"".join(texts)).encode())
            lose = False
            continue
        for i, text in zip(group, texts):
            if text:
                parts.append(text[1:] if lose and tables.spaced[i] else text)
                lose = False
    return b"".join(parts)


codecs.register_error("sentencepiece", lambda error: (REPLACEMENT, error.start + 1))


def _readable(data: bytes) -> str:
    return data.decode("utf-8", "sentencepiece")


def _lists(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32))).cast(pa.list_(pa.int32()))


def _encoder(model: bytes, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = load_tables(model)
        for batch in slices(batches, max_bytes=SLICE):
            ids, bounds = encode_flat(batch.column("text"), tables)
            columns = [batch.column("id"), _lists(ids, bounds)]
            if decoded:
                columns.append(decode_flat(ids, bounds, tables).cast(pa.string()))
            yield pa.record_batch(columns, ["id", "ids", "decoded"][:len(columns)])
    return run


def _decoder(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = load_tables(model)
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), pa.scalar([], batch.column("ids").type))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
            yield pa.record_batch([batch.column("id"), decode_flat(flat, bounds, tables).cast(pa.string())],
                                  ["id", "decoded"])
    return run


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _columns(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    picked = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return picked, picked.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row of ``docs``, as the sentencepiece library encodes it.

    No begin or end ids. A NULL or empty text has no ids; repeated rows and NULL
    ids are kept as they are; an empty table gives an empty one; other columns
    are ignored. The model file (some 0.5 MB) is read on the driver and travels
    with the tasks.
    """
    picked, kind = _columns(docs, id_col, text_col)
    return picked.mapInArrow(_encoder(read_model(model_path), False), f"id {kind}, ids array<int>").withColumnRenamed(
        "id", id_col)


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`encode`, and in the same pass ``decoded``: the text that the ids give back (see :func:`decode`)."""
    picked, kind = _columns(docs, id_col, text_col)
    return picked.mapInArrow(_encoder(read_model(model_path), True),
                             f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) for rows of piece ids, as the sentencepiece library decodes them.

    The space that encoding puts before a text goes, control pieces have no
    text, bytes that form no character become U+FFFD. NULL or no ids give ''.
    """
    picked = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(_decoder(read_model(model_path)), f"id {kind}, decoded string").withColumnRenamed(
        "id", id_col)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
