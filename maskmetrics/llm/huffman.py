"""Token files: canonical length-limited Huffman codes, independent blocks, bit-offset checkpoints."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from maskmetrics.session import ship

LONGEST = 16
# Ids of a block, if one row does not need more, and ids between two checkpoints.
BLOCK_IDS = 1 << 16
STEP = 256
# Ids that are decoded together.
DECODE_IDS = 1 << 21


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Best code lengths of at most ``longest`` bits for the ids that occur (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids do not fit into codes of {longest} bits")
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n, level, kept = len(order), weights, []
    # Each level merges pairs of the level below with the single ids; a pair of rank r stands
    # for the first 2 (r + 1) entries below it.
    single = np.ones(n, np.bool_)
    kept.append(single)
    for _ in range(longest - 1):
        packed = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packed])
        by = np.argsort(both, kind="stable")
        level = both[by]
        kept.append(by < n)
    taken, depth = 2 * (n - 1), np.zeros(n, np.int64)
    for single in reversed(kept):
        alone = int(single[:taken].sum())
        depth[:alone] += 1
        taken = 2 * (taken - alone)
    lengths[order] = depth
    return lengths


@dataclass(frozen=True)
class Code:
    """A canonical code: shorter codes first, equal lengths by id; made from lengths alone."""

    lengths: np.ndarray
    codes: np.ndarray
    table: np.ndarray

    @staticmethod
    def of(lengths: np.ndarray) -> "Code":
        longest = LONGEST
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        sizes = lengths[order].astype(np.int64)
        # The code, moved to the left edge of ``longest`` bits, is the sum of the room before it.
        room = np.int64(1) << (longest - sizes)
        left = np.cumsum(room) - room
        codes = np.zeros(len(lengths), np.int64)
        codes[order] = left >> (longest - sizes)
        table = np.zeros(1 << longest, np.int32)
        table[:int(room.sum())] = np.repeat(order, room)
        return Code(lengths.astype(np.int64), codes, table)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, first bit highest, and the bit offset of every ``STEP``-th id."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        at = ends - sizes
        # A code of at most 16 bits lies in two neighbouring words of 16 bits.
        word = at >> 4
        shifted = self.codes[ids] << (32 - (at & 15) - sizes)
        n = (int(ends[-1]) if len(ends) else 0) // 16 + 2
        words = np.bincount(word, weights=shifted >> 16, minlength=n) + np.bincount(
            word + 1, weights=shifted & 0xFFFF, minlength=n)
        return words.astype(">u2").tobytes(), at[::STEP]

    def decode(self, bits: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of runs that start at bit ``offsets`` and hold ``counts`` ids, all runs in step."""
        total = np.cumsum(counts)
        out = np.zeros(int(total[-1]) if len(total) else 0, np.int32)
        order = np.argsort(-counts, kind="stable")
        place, at, left = (total - counts)[order], offsets[order].copy(), counts[order]
        # Three bytes hold the next 16 bits wherever they start.
        padded = np.concatenate([bits, np.zeros(3, np.uint8)]).astype(np.int64)
        wide = (padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]
        for step in range(int(left[0]) if len(left) else 0):
            live = int(np.searchsorted(-left, -step, side="left"))
            now = at[:live]
            found = self.table[(wide[now >> 3] >> (8 - (now & 7))) & 0xFFFF]
            out[place[:live] + step] = found
            now += self.lengths[found]
        return out


def pack(ids: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(ids.astype("<u4" if ids.max(initial=0) > 0xFFFF else "<u2").tobytes())


def unpack(raw: bytes, n: int) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(raw)
    return np.frombuffer(data, "<u4" if len(data) == 4 * n else "<u2").astype(np.int32)


def id_counts(rows: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all rows (columns n, packed); one sum per id reaches the driver."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total += np.bincount(unpack(raw, n), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    sums = rows.select("n", "packed").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocabulary, np.int64)
    counts[sums.column("id").to_numpy()] = sums.column("n").to_numpy()
    return counts


def write_token_file(rows: DataFrame, path: str, vocabulary: int, key: str = "doc_id") -> None:
    """Write rows (``key``, n, packed ids) in ascending key order as blocks of Huffman codes.

    ``path`` gets three tables. `codebook`: the code length of each id, which is the whole
    code. `blocks`: (part, block, first, ids, rows, checkpoints, bits), each block decodable
    alone. `parts`: the ids before each part. Rows are range-partitioned by key, with ties
    spread by content; parts follow each other in key order, a null key first. Rows with equal
    keys are ordered by content, so equal rows are interchangeable.
    """
    spark = rows.sparkSession
    ship(spark)
    lengths = code_lengths(id_counts(rows, vocabulary))
    code = spark.sparkContext.broadcast(lengths)
    spark.createDataFrame(pa.table({"id": np.arange(vocabulary, dtype=np.int32), "length": lengths.astype(np.int32)})) \
        .coalesce(1).write.parquet(f"{path}/codebook")

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first = TaskContext.get().partitionId(), 0, 0
        with_code = Code.of(code.value)
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            nonlocal number, first, held
            ids = np.concatenate([h[2] for h in held])
            bits, marks = with_code.encode(ids)
            row = pa.RecordBatch.from_pylist([{
                "part": part, "block": number, "first": first, "ids": len(ids),
                "keys": [h[0] for h in held], "sizes": [h[1] for h in held],
                "checkpoints": marks.astype("<u8").tobytes(), "bits": bits}], schema=_BLOCK)
            number, first, held = number + 1, first + len(ids), []
            return row

        size = 0
        for batch in batches:
            for name, n, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and size + n > BLOCK_IDS:
                    yield block()
                    size = 0
                held.append((name, n, unpack(raw, n)))
                size += n
        if held:
            yield block()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("packed")
    ordered = (rows.select(F.col(key).cast("long").alias("key"), "n", "packed", tie.alias("tie"))
               .repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie").select("key", "n", "packed"))
    ordered.mapInArrow(blocks, _BLOCK_DDL).write.parquet(f"{path}/blocks")
    sums = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("ids").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per part of the file.
    sums.select("part", "ids", F.coalesce(before, F.lit(0)).alias("before")).coalesce(1).write.parquet(f"{path}/parts")


_BLOCK = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("ids", pa.int64()),
                    ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("checkpoints", pa.binary()),
                    ("bits", pa.binary())])
_BLOCK_DDL = ("part int, block int, first long, ids long, keys array<long>, sizes array<long>, checkpoints binary, "
              "bits binary")


def read_token_file(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(``key``, start, n, ids) of every row of a token file; ids are little-endian unsigned 32-bit.

    ``start`` counts the ids of all rows before it in the file.
    """
    ship(spark)
    book = spark.read.parquet(f"{path}/codebook").toArrow().sort_by("id")
    code = spark.sparkContext.broadcast(book.column("length").to_numpy().astype(np.uint8))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_code = Code.of(code.value)
        for batch in batches:
            sizes, at = batch.column(1).to_pylist(), 0
            while at < batch.num_rows:
                upto, held = at + 1, sizes[at]
                while upto < batch.num_rows and held + sizes[upto] <= DECODE_IDS:
                    held += sizes[upto]
                    upto += 1
                yield _decoded(batch.slice(at, upto - at), with_code)
                at = upto

    blocks = spark.read.parquet(f"{path}/blocks")
    parts = spark.read.parquet(f"{path}/parts").select("part", "before")
    # One row per part: as many as the file has partitions.
    placed = blocks.join(F.broadcast(parts), "part").select(
        (F.col("first") + F.col("before")).alias("start"), "ids", "keys", "sizes", "checkpoints", "bits")
    return placed.mapInArrow(rows, "key long, start long, n long, ids binary").withColumnRenamed("key", key)


def _decoded(batch: pa.RecordBatch, code: Code) -> pa.RecordBatch:
    bits = batch.column(5).to_pylist()
    bases = np.cumsum([0] + [8 * len(b) for b in bits])[:-1]
    offsets, counts = [], []
    for base, marks, n in zip(bases, batch.column(4).to_pylist(), batch.column(1).to_pylist()):
        marks = np.frombuffer(marks, "<u8").astype(np.int64)
        offsets.append(marks + base)
        counts.append(np.minimum(STEP, n - STEP * np.arange(len(marks))))
    ids = code.decode(np.frombuffer(b"".join(bits), np.uint8), np.concatenate(offsets), np.concatenate(counts))
    sizes = batch.column(3).flatten().to_numpy()
    per_block = np.array([len(s) for s in batch.column(3)], np.int64)
    ends = np.cumsum(sizes)
    first = np.concatenate([[0], np.cumsum(batch.column(1).to_numpy())])[:-1]
    starts = ends - sizes - np.repeat(first, per_block) + np.repeat(batch.column(0).to_numpy(), per_block)
    raw = ids.astype("<u4").tobytes()
    cuts = [0, *(4 * ends).tolist()]
    return pa.RecordBatch.from_arrays(
        [batch.column(2).flatten(), pa.array(starts), pa.array(sizes),
         pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())], names=["key", "start", "n", "ids"])
