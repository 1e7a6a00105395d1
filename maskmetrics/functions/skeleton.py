"""Letters and digits of texts without what stands between them, and hashes of their stretches.

The helper that runs inside Python tasks; operators.broken_names joins what it finds.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from maskmetrics.functions.matcher import fold

# What may stand between two pieces of one name: so many characters that are no letter or digit.
LONGEST_GAP = 3
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """1 for letters, 2 for digits and other numbers, 0 for all else, by code point."""
    kinds = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            kinds[code] = 1
        elif c.isnumeric():
            kinds[code] = 2
    return kinds


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass(frozen=True)
class Skeletons:
    """All letters and digits of some texts, one text behind the other, and the pieces that they form.

    ``place`` is where a character stands in its text, ``owner`` the text of a piece, ``starts`` and ``ends`` the
    pieces in characters. A piece holds letters alone or digits alone, without a gap.
    """

    chars: np.ndarray
    kinds: np.ndarray
    place: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    # Whether the piece before lies in the same text, LONGEST_GAP characters away at most.
    joined: np.ndarray


def skeletons(texts: list[str]) -> Skeletons:
    chars, kinds, place, owner = [], [], [], []
    for i, text in enumerate(texts):
        codes = codes_of(fold(text))
        own = _kinds()[codes]
        at = np.flatnonzero(own)
        chars.append(codes[at])
        kinds.append(own[at])
        place.append(at)
        owner.append(np.full(len(at), i))
    c, k, p, o = (np.concatenate([*x, np.zeros(0, t)]) for x, t in ((chars, np.uint32), (kinds, np.uint8), (place, np.int64), (owner, np.int64)))
    begins = np.ones(len(c), np.bool_)
    begins[1:] = (o[1:] != o[:-1]) | (k[1:] != k[:-1]) | (p[1:] != p[:-1] + 1)
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(c))
    joined = np.zeros(len(starts), np.bool_)
    if len(starts) > 1:
        last, first = ends[:-1] - 1, starts[1:]
        joined[1:] = (o[last] == o[first]) & (p[first] - p[last] - 1 <= LONGEST_GAP)
    return Skeletons(c, k, p, o[starts] if len(starts) else np.zeros(0, np.int64), starts, ends, joined)


def stretches(s: Skeletons, pieces: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) in characters of all joined pieces, ``pieces`` at most, whose size is marked in ``sizes``."""
    first = np.arange(len(s.starts))
    found = []
    for n in range(pieces):
        if n:
            first = first[first + n < len(s.starts)]
            first = first[s.joined[first + n]]
        begin, end = s.starts[first], s.ends[first + n]
        size = np.minimum(end - begin, len(sizes) - 1)
        good = sizes[size]
        found.append((s.owner[first[good]], begin[good], end[good]))
        first = first[end - begin < len(sizes)]
    return tuple(np.concatenate(x) for x in zip(*found))


class Hashes:
    """Hashes of stretches of characters, whole or with one letter left out."""

    def __init__(self, chars: np.ndarray):
        n = len(chars) + 1
        self._down = np.concatenate([np.ones(1, np.uint64), np.full(n, _INVERSE, np.uint64)]).cumprod(dtype=np.uint64)
        up = np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE, np.uint64)]).cumprod(dtype=np.uint64)
        self._sums = np.zeros(n, np.uint64)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up[:n - 1], out=self._sums[1:])

    @staticmethod
    def _mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def whole(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._mixed((self._sums[end] - self._sums[start]) * self._down[start])

    def without(self, start: np.ndarray, end: np.ndarray, out: np.ndarray) -> np.ndarray:
        """As ``whole`` of the stretch without its character at ``out``."""
        left, right = self._sums[out] - self._sums[start], self._sums[end] - self._sums[out + 1]
        return self._mixed((left + right * np.uint64(_INVERSE)) * self._down[start])


def neighbourhood(s: Skeletons, start: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, key): the hash of each stretch, and of those of ``least`` characters also without each letter.

    Two stretches that differ by one letter, or by none, share a key. Digits are never left out.
    """
    hashes = Hashes(s.chars)
    rows = np.arange(len(start))
    long = np.flatnonzero(end - start >= least)
    sizes = (end - start)[long]
    which = np.repeat(long, sizes)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + start[which]
    letters = s.kinds[at] == 1
    which, at = which[letters], at[letters]
    return np.concatenate([rows, which]), np.concatenate([hashes.whole(start, end), hashes.without(start[which], end[which], at)])


def halves(s: Skeletons, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the first and of the second half of each stretch: one edit leaves one of them as it is."""
    hashes, middle = Hashes(s.chars), start + (end - start) // 2
    return hashes.whole(start, middle), hashes.whole(middle, end)


def shares_half(s: Skeletons, start: np.ndarray, end: np.ndarray, least: int, held) -> np.ndarray:
    """Whether a stretch may be a name, or one edit away from a name of ``least`` characters at least.

    ``held`` tests hashes: of whole names, and of the halves of those of ``least`` characters.
    """
    hashes = Hashes(s.chars)
    good = held(hashes.whole(start, end))
    for change in (-1, 0, 1):
        size = end - start + change
        at = np.flatnonzero(~good & (size >= least))
        a, b, half = start[at], end[at], size[at] // 2
        good[at] = held(hashes.whole(a, a + half)) | held(hashes.whole(b - (size[at] - half), b))
    return good


def written(s: Skeletons, start: np.ndarray, end: np.ndarray) -> list[str]:
    """The characters of each stretch."""
    return [s.chars[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(start.tolist(), end.tolist())]
