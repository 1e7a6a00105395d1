"""Byte-level BPE: merging all pieces of a batch at once in padded matrices."""

from __future__ import annotations

import base64
import heapq
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from maskmetrics.llm.common import byte_texts, sent_with_text, text_slices
from maskmetrics.llm.pieces import PieceIds, spans
from maskmetrics.session import ship

NONE = np.int32(np.iinfo(np.int32).max)
# Pieces up to this length are merged in matrices; a longer one in a heap of its own, since the
# leftmost merge of each round would otherwise cost the square of its length.
WIDEST = 256
# Cells of one matrix: its look-ups hold some ten arrays of as many 64-bit values.
CELLS = 1 << 18
# A space beside other white space, or white space beyond ASCII: such a text is split by the
# pattern itself, any other at its spaces first.
IRREGULAR = re.compile(rb" [ \t-\r\x1c-\x1f]|[\t-\r\x1c-\x1f] |\xc2[\x85\xa0]|\xe1\x9a\x80"
                       rb"|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank), by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("the ranks have gaps")
    return [ranks[i] for i in range(len(ranks))]


class PairTable:
    """Open hashing of (left id, right id) to the rank of their joined bytes."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens)}
        left, right, rank = [], [], []
        for i, token in enumerate(tokens):
            for cut in range(1, len(token)):
                a, b = ids.get(token[:cut]), ids.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(i)
        keys = self._key(np.array(left, np.int64), np.array(right, np.int64))
        ranks = np.array(rank, np.int32)
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self._mask = size - 1
        self._keys = np.full(size, -1, np.int64)
        self._ranks = np.full(size, NONE, np.int32)
        slot, left_over = self._slot(keys), np.arange(len(keys))
        while len(left_over):
            free = left_over[self._keys[slot[left_over]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self._keys[slot[won]], self._ranks[slot[won]] = keys[won], ranks[won]
            left_over = left_over[~np.isin(left_over, won)]
            slot[left_over] = (slot[left_over] + 1) & self._mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 31) | right

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(29)) & np.uint64(self._mask)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or NONE; ids below zero are padding."""
        keys = self._key(left, right)
        keys[(left < 0) | (right < 0)] = -2
        out = np.full(len(keys), NONE, np.int32)
        rest = np.flatnonzero(keys >= 0)
        slot = self._slot(keys[rest])
        while len(rest):
            found = self._keys[slot]
            hit = found == keys[rest]
            out[rest[hit]] = self._ranks[slot[hit]]
            on = ~hit & (found >= 0)
            rest, slot = rest[on], (slot[on] + 1) & self._mask
        return out


class Merger:
    """Ids of pieces of bytes: the lowest rank first, the leftmost of equal ranks."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.pairs = PairTable(tokens)
        self.single = np.array([self.whole.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.single < 0).any():
            raise ValueError("every byte needs a token of its own")

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        known = np.fromiter((self.whole.get(p, -1) for p in pieces), np.int64, len(pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        sizes = (known >= 0).astype(np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(known >= 0), known[known >= 0])]
        open_ = (known < 0) & (lengths > 0)
        width, narrow = 4, 0
        while width <= WIDEST:
            rows = np.flatnonzero(open_ & (lengths > narrow) & (lengths <= width))
            for at in range(0, len(rows), max(1, CELLS // width)):
                some = rows[at:at + max(1, CELLS // width)]
                ids, count = self._merge_matrix([pieces[i] for i in some], lengths[some], width)
                sizes[some] = count
                parts.append((np.repeat(some, count), ids))
            width, narrow = 2 * width, width
        for i in np.flatnonzero(open_ & (lengths > WIDEST)):
            ids = self._merge_long(pieces[i])
            sizes[i] = len(ids)
            parts.append((np.full(len(ids), i), ids))
        owner = np.concatenate([p[0] for p in parts])
        ids = np.concatenate([p[1] for p in parts]).astype(np.int32)
        return ids[np.argsort(owner, kind="stable")], sizes

    def _merge_matrix(self, pieces: list[bytes], lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        column = np.arange(width)
        ids = np.where(column < lengths[:, None], self.single[raw], np.int32(-1))
        ranks = self.pairs.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        # One more column of NONE, so that ids and ranks are shifted alike.
        ranks = np.concatenate([ranks, np.full((n, 1), NONE, np.int32)], axis=1)
        done_ids, live = ids.copy(), np.arange(n)
        while len(live):
            at = ranks.argmin(axis=1)
            row = np.arange(len(live))
            best = ranks[row, at]
            stays = best != NONE
            if not stays.all():
                done_ids[live[~stays]] = ids[~stays]
                live, ids, ranks, at, best = live[stays], ids[stays], ranks[stays], at[stays], best[stays]
                if not len(live):
                    break
                row = np.arange(len(live))
            # The merged pair becomes one id, all behind it moves one place to the left.
            source = column + (column > at[:, None])
            source[:, -1] = np.minimum(source[:, -1], width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            ranks = np.take_along_axis(ranks, source, axis=1)
            ids[:, -1], ranks[:, -1] = -1, NONE
            ids[row, at] = best
            behind = np.minimum(at + 1, width - 1)
            ranks[row, at] = self.pairs.ranks(best, np.where(at < width - 1, ids[row, behind], -1))
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.pairs.ranks(ids[before, at[before] - 1], best[before])
        kept = done_ids >= 0
        return done_ids[kept], kept.sum(axis=1)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(rank, i) for i, rank in enumerate(first) if rank != NONE]
        heapq.heapify(heap)
        current = first + [int(NONE)]
        table = self._long_pairs()
        while heap:
            rank, i = heapq.heappop(heap)
            if current[i] != rank or ids[i] < 0:
                continue
            j = after[i]
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a < 0:
                    continue
                current[a] = table.get((ids[a], ids[b]), int(NONE)) if b < n else int(NONE)
                if current[a] != NONE:
                    heapq.heappush(heap, (current[a], a))
        return np.array([i for i in ids if i >= 0], np.int32)

    def _long_pairs(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_plain"):
            used = self.pairs._keys >= 0
            keys, ranks = self.pairs._keys[used], self.pairs._ranks[used]
            self._plain = dict(zip(zip((keys >> 31).tolist(), (keys & 0x7FFFFFFF).tolist()), ranks.tolist()))
        return self._plain


class TextEncoder:
    """Ids of whole texts: each match of the pattern is a piece of its own."""

    def __init__(self, merger: Merger, pattern: str):
        self._merger, self._pattern = merger, regex.compile(pattern)
        # A unit is a run between spaces with the space before it, so no match of the
        # pattern reaches over its edges; `_first` holds those at the start of a text.
        self._spaced = PieceIds(lambda units: self._units(units, " "), limit=150_000)
        self._first = PieceIds(lambda units: self._units(units, ""), limit=50_000)

    def _units(self, units: list[bytes], lead: str) -> tuple[np.ndarray, np.ndarray]:
        pieces: list[bytes] = []
        counts = np.zeros(len(units), np.int64)
        for i, unit in enumerate(units):
            found = self._pattern.findall(lead + unit.decode())
            counts[i] = len(found)
            pieces += [p.encode() for p in found]
        distinct = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        ids, sizes = self._merger.encode(list(distinct))
        starts = np.cumsum(sizes) - sizes
        code = np.fromiter(map(distinct.__getitem__, pieces), np.int64, len(pieces))
        owner = np.repeat(np.arange(len(units)), counts)
        each = np.bincount(owner, weights=sizes[code], minlength=len(units)).astype(np.int64)
        return ids[spans(starts[code], sizes[code])], each

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        heads: list[bytes] = []
        rest: list[bytes] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            # An irregular text is one unit; its matches are found over the whole of it.
            units = [text] if IRREGULAR.search(text) else text.split(b" ")
            heads.append(units[0])
            counts[i] = len(units) - 1
            rest += units[1:]
        head_ids, head_sizes = self._first.look_up(heads)
        ids, sizes = self._spaced.look_up(rest)
        owner = np.repeat(np.arange(len(texts)), counts)
        tail_sizes = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)
        total = head_sizes + tail_sizes
        out = np.empty(int(total.sum()), np.int32)
        starts = np.cumsum(total) - total
        out[spans(starts, head_sizes)] = head_ids
        out[spans(starts + head_sizes, tail_sizes)] = ids
        return out, total


class TextDecoder:
    """The bytes that stand for ids."""

    def __init__(self, tokens: list[bytes]):
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._sizes = np.array([len(t) for t in tokens], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        sizes = self._sizes[ids]
        flat = self._bytes[spans(self._starts[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]


# One encoder per worker process and vocabulary, so that its memory of pieces serves all tasks.
_workers: dict[str, TextEncoder] = {}


def _encoder(name: str, shared, pattern: str) -> TextEncoder:
    if name not in _workers:
        _workers.clear()
        _workers[name] = TextEncoder(Merger(shared.value), pattern)
    return _workers[name]


def encode_texts(df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids",
                 decoded: str | None = None) -> DataFrame:
    """Add ``ids``: the token ids of the whole text as little-endian unsigned 32-bit integers.

    ``ranks`` names the rank file, ``pattern`` what is merged separately. ``decoded`` names a
    column for the bytes that the ids stand for. A null text counts as empty and gives no ids.
    One row out per row in, repeated rows included; all other columns are carried along, and
    columns with the names of the new ones are replaced. An empty table gives an empty result.

    Distinct pieces of a batch are merged together: rows of one length class form a padded
    matrix, each round looks for the leftmost pair of lowest rank in every row, replaces it,
    and closes the gap; rows without a pair leave. No shuffle; a task holds a few megabytes
    of text and a bounded memory of pieces.
    """
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks))
    name = uuid.uuid4().hex
    new = [ids] + ([decoded] if decoded else [])
    kept = [c for c in df.columns if c not in new]
    sent, at = sent_with_text(df, kept, text)
    schema = T.StructType([*df.select(*kept).schema.fields, *(T.StructField(c, T.BinaryType()) for c in new)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(name, shared, pattern), TextDecoder(shared.value)
        for batch in text_slices(batches, at, 1 << 20):
            flat, counts = encoder.encode(byte_texts(batch.column(at)))
            raw = flat.astype("<u4").tobytes()
            ends = np.concatenate([[0], 4 * np.cumsum(counts)]).tolist()
            columns = [pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary())]
            if decoded:
                columns.append(pa.array(decoder.decode(flat, counts), pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *columns], names=[*kept, *new])

    return sent.mapInArrow(run, schema)
