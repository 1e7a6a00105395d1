"""SimHash fingerprints, links by pigeonhole blocks, and the groups that links make."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from maskmetrics.llm.common import byte_texts, sent_with_text, text_slices
from maskmetrics.operators.lookup import salted_join
from maskmetrics.session import settle, ship

# Blocks with more fingerprints than this are linked by shared neighbours instead of in pairs.
DENSE = 32


def shingle_hashes(text: bytes, width: int = 3, seed: int = 42) -> np.ndarray:
    """The hashes of all runs of ``width`` words; a shorter text is one run, a blank one has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(width, len(words)) - 1:].tolist()
    starts = [0, *(ends[:len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[a:b], seed) for a, b in zip(starts, last)), np.uint64, len(last))


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text: each bit that is set in over half of its shingle hashes."""
    hashes = shingle_hashes(text, width, seed)
    bits = np.zeros(64, np.int64)
    # Bounded pieces: a text of any length needs the same memory for its bits.
    for at in range(0, len(hashes), 1 << 16):
        octets = hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def with_fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", width: int = 3) -> DataFrame:
    """Add ``out``, a signed long with the bits of the fingerprint; other columns are carried along.

    Words are runs of characters other than the six ASCII blanks, A to Z lower-cased. A text
    of fewer than ``width`` words is one shingle; null, empty and blank texts have none and
    fingerprint zero. A column named ``out`` is replaced.
    """
    ship(df.sparkSession)
    kept = [c for c in df.columns if c != out]
    sent, at_text = sent_with_text(df, kept, text)
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(out, T.LongType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, at_text):
            marks = np.array([fingerprint(t, width) for t in byte_texts(batch.column(at_text))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(marks.view(np.int64))], names=[*kept, out])

    return sent.mapInArrow(run, schema)


def _block_masks(distance: int, spare: int) -> list[int]:
    """Masks of the blocks that may be kept: 64 bits in distance + spare blocks, ``spare`` kept."""
    blocks = distance + spare
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(some) for some in combinations(parts, spare)]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def near_links(marks: DataFrame, distance: int = 2, spare: int = 2, dense: int = DENSE) -> DataFrame:
    """Links (a, b) that join all fingerprints at ``distance`` or fewer differing bits.

    ``marks`` holds distinct longs in column ``mark``. 64 bits are cut into distance + spare
    blocks; two close fingerprints differ in at most ``distance`` of them, so they agree in
    ``spare`` whole blocks, and a join on every choice of ``spare`` blocks meets each close
    pair. Each met pair is then verified.

    A block value with more than ``dense`` fingerprints is not paired. For those fingerprints
    the same question has a second exact answer: two of them are within 2 bits if and only if
    some value is within one bit of both. Each names its 65 such values, and all that name a
    value are linked to the smallest of them. So the links of a crowded block grow with its
    size and not with the square; they connect the same fingerprints as the pairs would.
    """
    if distance != 2:
        raise ValueError("crowded blocks are answered exactly for 2 bits")
    masks = _block_masks(distance, spare)
    keyed = marks.select("mark", F.explode(F.array(*(
        F.struct(F.lit(i).alias("block"), F.col("mark").bitwiseAND(F.lit(_signed(m))).alias("value"))
        for i, m in enumerate(masks)))).alias("key")).select("mark", "key.block", "key.value")
    sizes = keyed.groupBy("block", "value").agg(F.count("*").alias("n"))
    crowded = sizes.where(F.col("n") > dense).select("block", "value", F.lit(True).alias("crowded"))
    # A crowded value is hot by definition: its rows are dealt over the copies of its mark.
    keyed = settle(salted_join(keyed, crowded, ["block", "value"], F.col("mark")), "blocks")
    paired = keyed.where("crowded is null").drop("crowded")
    left, right = paired.withColumnRenamed("mark", "a"), paired.withColumnRenamed("mark", "b")
    pairs = left.join(right, ["block", "value"]).where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).select("a", "b")

    flips = F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << i)).cast("long") for i in range(64)))
    around = keyed.where("crowded").select("mark").distinct().select(
        "mark", F.explode(F.transform(flips, lambda f: F.col("mark").bitwiseXOR(f))).alias("point"))
    least = around.groupBy("point").agg(F.min("mark").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = around.join(least, "point").where(F.col("mark") != F.col("a")).select("a", F.col("mark").alias("b"))
    return pairs.unionByName(stars).distinct()


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that can be reached, for every node of ``edges`` (a, b).

    Alternates two star steps: link every larger neighbour to the smallest one of a node, then
    every smaller one. Ends when a round changes no edge; the edges of each round are written
    to the shared folder, so lineage stays short. A hub is shared out by the joins on its
    neighbours; no neighbour list is ever collected.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large(e: DataFrame) -> DataFrame:
        near = both(e)
        least = near.groupBy("a").agg(F.min("b").alias("root")).select("a", F.least("root", "a").alias("root"))
        met = salted_join(near.where("b > a"), least, ["a"], F.col("b"), "inner")
        return (met.select(F.col("root").alias("a"), "b").where("a <> b").distinct())

    def small(e: DataFrame) -> DataFrame:
        down = both(e).where("b < a")
        least = down.groupBy("a").agg(F.min("b").alias("root"))
        met = salted_join(down, least, ["a"], F.col("b"), "inner")
        return (met.select("root", F.col("b").alias("x")).unionByName(met.select("root", F.col("a").alias("x")))
                .where("root <> x").select(F.col("root").alias("a"), F.col("x").alias("b")).distinct())

    def seal(e: DataFrame):
        held = settle(e, "edges")
        sign = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return held, tuple(sign)

    now, sign = seal(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        after, mark = seal(small(large(now)))
        if mark == sign:
            roots = after.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "node")
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        now, sign = after, mark
    raise RuntimeError("the components did not settle")


@dataclass(frozen=True)
class Groups:
    """``rows``: key, digest of the text, fingerprint; ``classes``: fingerprint, root, component."""

    rows: DataFrame
    classes: DataFrame


def _digest(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.length(F.coalesce(F.col(text), F.lit(""))))


def group_rows(df: DataFrame, key: str, text: str, width: int = 3, distance: int = 2) -> Groups:
    """Fingerprints of all rows and the group of each distinct fingerprint."""
    slim = df.select(F.col(key).alias("key"), _digest(text).alias("digest"), F.col(text).alias("text"))
    rows = settle(with_fingerprints(slim, "text", "fingerprint", width).drop("text"), "fingerprints")
    marks = rows.groupBy("fingerprint").agg(F.min("key").alias("least"))
    links = settle(near_links(marks.select(F.col("fingerprint").alias("mark")), distance), "links")
    roots = connected(links).withColumnRenamed("node", "fingerprint")
    named = settle(marks.join(roots, "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "groups")
    whole = named.groupBy("root").agg(F.min("least").alias("component"))
    return Groups(rows, salted_join(named.drop("least"), whole, ["root"], F.col("fingerprint"), "inner"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3,
                    distance: int = 2) -> DataFrame:
    """Each row's key, ``fingerprint`` (long) and ``component``: the smallest key of its group.

    Rows are linked when their fingerprints differ in ``distance`` or fewer bits; a group is
    all rows that links reach. Equal texts have equal fingerprints and meet before any join,
    so thousands of copies cost one row. One row out per row in, repeated rows included; the
    component is null only where no row of the group has a key. An empty table gives an
    empty result.
    """
    groups = group_rows(df, key, text, width, distance)
    found = salted_join(groups.rows, groups.classes, ["fingerprint"], F.struct("key", "digest", "fingerprint"), "inner")
    return found.select(F.col("key").alias(key), "fingerprint", "component")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, distance: int = 2) -> DataFrame:
    """One row of each group: that with the smallest key; one of them where several share it.

    A row without a key stays only where no row of its group has one, and then one of them.
    All columns of ``df`` are kept. Only keys and digests are compared before the one join
    that picks rows.
    """
    return keep_of_groups(df, group_rows(df, key, text, width, distance), key, text)


def keep_of_groups(df: DataFrame, groups: Groups, key: str, text: str) -> DataFrame:
    """The rows of ``df`` that ``keep_one`` promises, of any groups."""
    found = salted_join(groups.rows, groups.classes, ["fingerprint"], F.struct("key", "digest", "fingerprint"), "inner")
    stays = (found.where(F.col("key") == F.col("component")).groupBy("root", "key").agg(F.min("digest").alias("digest"))
             .select(F.col("key").alias("_stay"), F.col("digest").alias("_of")))
    picked = df.join(stays, (df[key] == F.col("_stay")) & (_digest(text) == F.col("_of"))).dropDuplicates(["_stay", "_of"])
    unnamed = found.where("component is null").groupBy("root").agg(F.min("digest").alias("_of")).select("_of")
    nameless = df.where(F.col(key).isNull()).join(unnamed, _digest(text) == F.col("_of")).dropDuplicates(["_of"])
    return picked.select(*df.columns).unionByName(nameless.select(*df.columns))
