"""Words of texts as arrays: split in bytes, hashed by whole batches."""

from __future__ import annotations

import numpy as np

# A to Z lower-cased; all ASCII characters but digits and letters become blanks.
ALPHANUMERIC = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
# A to Z lower-cased; the six ASCII blanks become spaces.
BLANK_SEPARATED = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else b for b in range(256))

_FACTOR = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64, for a prefix hash."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            # Kept as long as the worker lives: up to the next 2^16, a power of two would be up to twice as much.
            size = -(-n // (1 << 16)) << 16
            inverse = pow(_FACTOR, -1, 1 << 64)
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.full(size - 1, p, np.uint64)]).cumprod(
                dtype=np.uint64) for p in (_FACTOR, inverse))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def hashed_words(texts: list[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, in order, and the number of words per text."""
    parts = [t.translate(table) for t in texts]
    flat = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    inside = (flat != 32) & (flat != 10)
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers.upto(len(flat) + 1)
    prefix = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
    hashes = mix((prefix[ends] - prefix[starts]) * down[starts])
    borders = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    upto = np.searchsorted(starts, borders)
    return hashes, np.diff(upto, prepend=0)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for every ``length`` consecutive words, texts not told apart."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, length, np.uint64)
    for i in range(length):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
    return mix(total)


def whole_runs(counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs that stay inside a text, and the text of each; starts count all words."""
    first = np.cumsum(counts) - counts
    fit = np.maximum(counts - length + 1, 0)
    owner = np.repeat(np.arange(len(counts)), fit)
    place = np.arange(int(fit.sum())) - np.repeat(np.cumsum(fit) - fit, fit)
    return first[owner] + place, owner

