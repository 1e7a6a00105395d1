"""Periodic runs of words: Lyndon arrays by grouping suffixes, roots extended by common extensions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from maskmetrics.llm.common import byte_texts, text_slices
from maskmetrics.llm.words import hashed_words, mix, runs, whole_runs
from maskmetrics.session import ship

# The six ASCII blanks become spaces; letters stay as they are.
_BLANKS = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each place; the end counts as the least symbol.

    The first phase of suffix sorting by grouping: suffixes are grouped by a common opening, at first their
    first symbol. Groups are finished from the greatest down. Each suffix of a group points to the
    nearest suffix before it that lies in a lower group; a suffix that k of them point to has that group's
    opening k times behind its own, so it moves with its like to a new group just above its old one.
    When a group is reached, its opening is the longest Lyndon word at each of its places.
    """
    n = len(symbols)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    order = sorted(by_symbol)
    members = [by_symbol[c] for c in order]
    opening = [1] * len(order)
    below, above = list(range(-1, len(order) - 1)), list(range(1, len(order) + 1))
    rank = {c: g for g, c in enumerate(order)}
    group = [rank[c] for c in symbols]
    # Where to look next for a lower group; whatever lies between is finished.
    before = list(range(-1, n - 1))
    finished = bytearray(n)
    found = [0] * n
    now = len(order) - 1
    while now >= 0:
        length = opening[now]
        own = [i for i in members[now] if group[i] == now]
        for i in own:
            finished[i] = 1
            found[i] = length
        pointed: dict[int, int] = {}
        for i in own:
            at = before[i]
            if at >= 0 and finished[at]:
                path = [i]
                while at >= 0 and finished[at]:
                    path.append(at)
                    at = before[at]
                for p in path:
                    before[p] = at
            if at >= 0:
                pointed[at] = pointed.get(at, 0) + 1
        by_count: dict[int, list[int]] = {}
        for at, k in pointed.items():
            by_count.setdefault(k, []).append(at)
        # The largest count first: each new group goes just above the old one.
        for k in sorted(by_count, reverse=True):
            made: dict[int, int] = {}
            for at in by_count[k]:
                old = group[at]
                new = made.get(old)
                if new is None:
                    new = made[old] = len(members)
                    members.append([])
                    opening.append(opening[old] + k * length)
                    upper = above[old]
                    below.append(old)
                    above.append(upper)
                    above[old] = below[upper] = new
                members[new].append(at)
                group[at] = new
        now = below[now]
    return found


class Extensions:
    """Longest common extensions of places of one sequence, by the ranks of all blocks of 1, 2, 4, .. symbols."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self._n = len(symbols)
        self._ranks = [np.unique(symbols, return_inverse=True)[1].astype(np.int64)]
        size = 1
        while 2 * size <= min(longest, self._n):
            r = self._ranks[-1]
            pairs = r[:-size] * np.int64(len(r) + 1) + r[size:]
            self._ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
            size *= 2

    def _extend(self, a: np.ndarray, b: np.ndarray, ahead: bool) -> np.ndarray:
        got = np.zeros(len(a), np.int64)
        # Twice the largest size: an extension is shorter than the sum of all steps.
        for level in [len(self._ranks) - 1, *range(len(self._ranks) - 1, -1, -1)]:
            size, ranks = 1 << level, self._ranks[level]
            x, y = (a + got, b + got) if ahead else (a - got - size + 1, b - got - size + 1)
            inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < len(ranks))
            same = ranks[np.where(inside, x, 0)] == ranks[np.where(inside, y, 0)]
            got += np.where(inside & same, size, 0)
        return got

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` on equal those from ``b`` on."""
        return self._extend(a, b, True)

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols up to ``a`` equal those up to ``b``, these included."""
        return self._extend(a, b, False)


def all_runs(parts: list[list[int]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(part, start, length, period) of all runs of ``least`` symbols or more, by part, start and period.

    A run is a stretch with smallest period p and a length of 2 p at least that no neighbour extends. Its
    root of p symbols is, under one of the two orders of symbols, the longest Lyndon word somewhere in the
    run. So all roots are tried: each is extended as far as its period holds.
    """
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    if not sizes.sum():
        return (np.zeros(0, np.int64),) * 4
    # A symbol of its own behind each part stops extensions.
    first = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int64)
    for at, part in zip(first, parts):
        symbols[at:at + len(part)] = part
    symbols[first + sizes] = symbols.max() + 1 + np.arange(len(parts))
    common = Extensions(symbols, int(sizes.max()))
    found = []
    for turned in (False, True):
        for i, part in enumerate(parts):
            found.append((i, lyndon_lengths([-c for c in part] if turned else part)))
    owner = np.concatenate([np.full(len(lengths), i) for i, lengths in found])
    place = np.concatenate([first[i] + np.arange(len(lengths)) for i, lengths in found])
    root = np.concatenate([np.asarray(lengths, np.int64) for _, lengths in found])
    left, right = common.behind(place - 1, place + root - 1), common.ahead(place, place + root)
    holds = (left + right >= root) & (left + right + root >= least)
    rows = np.stack([owner, place - left - first[owner], left + root + right, root], axis=1)[holds]
    rows = np.unique(rows[:, [0, 1, 3, 2]], axis=0)
    return rows[:, 0], rows[:, 1], rows[:, 3], rows[:, 2]


def _stretches(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the longest stretches of words in windows that occur twice or more in their text.

    Each run lies in one of them: its windows of at most half its least length come again one period on.
    """
    hashes, counts = hashed_words(texts, _BLANKS)
    starts, owner = whole_runs(counts, window)
    nothing = (np.zeros(0, np.int64),) * 3
    if not len(starts):
        return nothing
    seen = mix(runs(hashes, window)[starts] ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(seen)
    again = np.zeros(len(seen), np.bool_)
    same = seen[order][1:] == seen[order][:-1]
    again[order[1:]] |= same
    again[order[:-1]] |= same
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, starts[again], 1)
    np.add.at(step, starts[again] + window, -1)
    inside = np.cumsum(step)[:-1] > 0
    # Stretches end with their text.
    firsts = np.cumsum(counts) - counts
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0)) == 1
    edge[firsts[counts > 0]] |= inside[firsts[counts > 0]]
    begins = np.flatnonzero(edge & inside)
    owners = np.searchsorted(np.cumsum(counts), begins, side="right")
    limit = np.minimum(np.append(begins[1:], len(hashes)), (firsts + counts)[owners])
    total = np.concatenate([[0], np.cumsum(inside)])
    ends = begins + total[limit] - total[begins]
    return owners, begins - firsts[owners], ends - firsts[owners]


def text_runs(texts: list[bytes], least: int) -> tuple[list[np.ndarray], list[bytes]]:
    """For each text its runs (rows of start, length, period; by start, then period) and its words without repeats."""
    words: dict[int, list[bytes]] = {}
    parts, places, names = [], [], {}
    for text, start, end in zip(*_stretches(texts, max(1, least // 2))):
        if end - start < least:
            continue
        if text not in words:
            words[text] = texts[text].split()
        # Words are told apart by their bytes, not by a hash.
        parts.append([names.setdefault(w, len(names)) for w in words[text][start:end]])
        places.append((text, start))
    part, start, length, period = all_runs(parts, least)
    where = np.array(places, np.int64).reshape(-1, 2)[part] if len(part) else np.zeros((0, 2), np.int64)
    rows = np.stack([where[:, 1] + start, length, period], axis=1) if len(part) else np.zeros((0, 3), np.int64)
    cuts = np.searchsorted(where[:, 0], np.arange(len(texts) + 1))
    found, kept = [], []
    for i, text in enumerate(texts):
        own = rows[cuts[i]:cuts[i + 1]]
        some = words.get(i) or text.split()
        if len(own):
            step = np.zeros(len(some) + 1, np.int64)
            np.add.at(step, own[:, 0] + own[:, 2], 1)
            np.add.at(step, own[:, 0] + own[:, 1], -1)
            some = [some[j] for j in np.flatnonzero(np.cumsum(step)[:-1] == 0).tolist()]
        found.append(own)
        kept.append(b" ".join(some))
    return found, kept


def with_runs(df: DataFrame, text: str = "text", least: int = 12, found: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """Add all periodic runs of words of each whole text, and the text without the repeats.

    Words are runs of characters other than the six ASCII blanks. ``found`` holds (start, length, period) in
    words, by start and period, of all stretches with a smallest period p, of max(``least``, 2 p)
    words or more, that no neighbouring word extends. ``collapsed`` holds the words that no run repeats,
    joined by one space: a run keeps its first p words. A null, empty or blank text has no run and an empty
    ``collapsed``. One row out per row in; other columns are carried along, columns of the two names are
    replaced. A text is worked on as a whole, in time and memory linear in its length but for a logarithm.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    ship(df.sparkSession)
    kept = [c for c in df.columns if c not in (found, collapsed)]
    schema = T.StructType([*df.select(*(f"`{c}`" for c in kept)).schema.fields, T.StructField(found, T.ArrayType(RUN, False), False),
                           T.StructField(collapsed, T.StringType(), False)])
    at = len(kept)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]
        for batch in text_slices(batches, at, 1 << 20):
            rows, short = text_runs(byte_texts(batch.column(at)), least)
            flat = np.concatenate([*rows, np.zeros((0, 3), np.int64)])
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], fields=fields))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], lists, pa.array(short, pa.binary()).cast(pa.string())], names=[*kept, found, collapsed])

    return df.select(*(f"`{c}`" for c in kept), df[text].alias("__text")).mapInArrow(run, schema)
