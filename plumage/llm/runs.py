"""Runs of marked bytes in the texts of a slice."""

from __future__ import annotations

import numpy as np


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` that do not cross from one text (``offsets``) into the next.

    Returns their starts and ends and ``bounds`` (texts + 1): text d has the runs
    ``bounds[d]:bounds[d + 1]``.
    """
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    tails = heads[1:] - 1
    last[tails] = inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)
