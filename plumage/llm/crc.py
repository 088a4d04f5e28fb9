"""CRC-32 of many short byte strings at once.

The checksum is linear over GF(2): a byte's share depends on its value and on
how many bytes follow it, and appending n bytes maps the checksum so far by a
fixed 32 x 32 bit matrix. So the checksums of all words of a slice are one
exclusive-or per word, and those of joined words come from their parts.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np

# Fixed value: the reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320
#: Words over this many bytes are summed by zlib one by one.
TABLE_BYTES = 64


@functools.lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), table >> np.uint32(1))
    return table


@functools.lru_cache(maxsize=1)
def _shares() -> np.ndarray:
    """[followers, byte]: share of a byte that has so many bytes after it."""
    table = _byte_table()
    out = np.empty((TABLE_BYTES, 256), np.uint32)
    out[0] = table
    for d in range(1, TABLE_BYTES):
        out[d] = table[out[d - 1] & np.uint32(255)] ^ (out[d - 1] >> np.uint32(8))
    return out


@functools.lru_cache(maxsize=1)
def _zeros() -> np.ndarray:
    """Checksums of n zero bytes: what a string of n bytes has beside its bytes' shares."""
    return np.array([zlib.crc32(bytes(n)) for n in range(TABLE_BYTES + 1)], np.uint32)


@functools.lru_cache(maxsize=64)
def _shift_table(power: int) -> np.ndarray:
    """[byte place, byte]: a checksum's byte carried over 2**power further bytes."""
    if power:
        half = _shift_table(power - 1)
        return _apply(half, _apply(half, np.arange(256, dtype=np.uint32)[None, :] << (
            np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]))
    value = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    return _byte_table()[value & np.uint32(255)] ^ (value >> np.uint32(8))


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (table[0][crc & np.uint32(255)] ^ table[1][(crc >> np.uint32(8)) & np.uint32(255)]
            ^ table[2][(crc >> np.uint32(16)) & np.uint32(255)] ^ table[3][crc >> np.uint32(24)])


def append(crc: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of strings with checksum ``crc`` followed by ``length`` bytes with checksum ``tail``."""
    out = crc.copy()
    for power in range(int(length.max()).bit_length() if len(length) else 0):
        which = np.flatnonzero(length >> power & 1)
        out[which] = _apply(_shift_table(power), out[which])
    return out ^ tail


def crc_of_runs(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of the non-empty runs ``raw[start:end]`` (ordered, not overlapping)."""
    out = np.zeros(len(start), np.uint32)
    length = end - start
    short = np.flatnonzero(length <= TABLE_BYTES)
    if len(short):
        n = length[short]
        base = np.cumsum(n) - n
        place = np.arange(n.sum()) - np.repeat(base, n)
        followers = np.repeat(n, n) - 1 - place
        share = _shares()[followers, raw[np.repeat(start[short], n) + place]]
        out[short] = np.bitwise_xor.reduceat(share, base) ^ _zeros()[n]
    for i in np.flatnonzero(length > TABLE_BYTES).tolist():
        out[i] = zlib.crc32(raw[start[i]:end[i]].tobytes())
    return out
