"""Ids of repeated pieces of text: every distinct piece is encoded once and looked up after."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, .. of every span, one span after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class PieceIds:
    """Remembers the ids of pieces, up to ``limit`` pieces; then it starts anew.

    ``encode`` gets distinct new pieces and returns their ids, one after the other, and the
    number of ids of each. The limit bounds memory and never changes a result.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int = 600_000):
        self._encode, self._limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self._codes: dict[bytes, int] = {}
        self._ids = np.zeros(1 << 16, np.int32)
        self._used = 0
        self._starts = np.zeros(1 << 14, np.int64)
        self._sizes = np.zeros(1 << 14, np.int64)

    @staticmethod
    def _room(array: np.ndarray, needed: int) -> np.ndarray:
        if needed <= len(array):
            return array
        grown = np.zeros(max(needed, 2 * len(array)), array.dtype)
        grown[:len(array)] = array
        return grown

    def _add(self, pieces: list[bytes]) -> None:
        ids, sizes = self._encode(pieces)
        known, n = len(self._codes), len(pieces)
        self._ids = self._room(self._ids, self._used + len(ids))
        self._starts = self._room(self._starts, known + n)
        self._sizes = self._room(self._sizes, known + n)
        self._ids[self._used:self._used + len(ids)] = ids
        self._sizes[known:known + n] = sizes
        self._starts[known:known + n] = self._used + np.cumsum(sizes) - sizes
        self._used += len(ids)
        self._codes.update(zip(pieces, range(known, known + n)))

    def look_up(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``pieces``, in order, and the number of ids of each piece."""
        if len(self._codes) > self._limit:
            self._clear()
        codes = np.fromiter(map(self._codes.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new = [pieces[i] for i in missing]
            self._add(list(dict.fromkeys(new)))
            codes[missing] = np.fromiter(map(self._codes.__getitem__, new), np.int64, len(new))
        sizes = self._sizes[codes]
        return self._ids[spans(self._starts[codes], sizes)], sizes
