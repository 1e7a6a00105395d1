"""Joining rows with a dictionary: broadcast below a checked size, salted join above it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from maskmetrics.session import settle, ship

# What may be copied to every executor: rows and characters of the dictionary.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 16_000_000
LEAST_SALTS = 8
# From how many rows on a key is shared out in ``hot_join``.
HOT_ROWS = 100_000
# Keys whose bit table may stand in a plan, as 20 KB of text; every event and task of the plan holds it again.
MOST_IN_PLAN = 4_096


@dataclass(frozen=True)
class Size:
    rows: int
    chars: int

    @property
    def bounded(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.chars <= BROADCAST_CHARS


def measure(df: DataFrame, *columns: str) -> Size:
    """Rows and characters of a dictionary, counted before it is broadcast."""
    length = sum((F.coalesce(F.char_length(c), F.lit(0)) for c in columns), F.lit(0))
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("c")).first()
    return Size(row["n"], row["c"])


def spread_of(df: DataFrame) -> Column:
    """All hashable columns: what tells one row of a hot key from the next."""
    def hashable(dt: T.DataType) -> bool:
        if isinstance(dt, T.StructType):
            return all(hashable(f.dataType) for f in dt.fields)
        if isinstance(dt, T.ArrayType):
            return hashable(dt.elementType)
        return not isinstance(dt, (T.MapType, T.VariantType))

    return F.struct(F.lit(0), *(f.name for f in df.schema.fields if hashable(f.dataType)))


def salted_join(rows: DataFrame, dictionary: DataFrame, keys: list[str], spread: Column,
                how: str = "left", salts: int | None = None) -> DataFrame:
    """Join on ``keys`` so that one hot key is shared out over ``salts`` tasks.

    ``dictionary`` is copied once per salt; rows pick their salt from ``spread``. There are
    about as many salts as the square root of the shuffle partitions, eight at least: a key
    with all rows then fills that many tasks, and adaptive execution splits those further.
    The copies are never broadcast: the planner sees the size of the files behind them, not how
    many they are, and would build them all on the driver.
    """
    if salts is None:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(LEAST_SALTS, round(partitions ** 0.5))
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = dictionary.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def hot_join(rows: DataFrame, dictionary: DataFrame, keys: list[str], spread: Column,
             how: str = "left", counted: DataFrame | None = None) -> DataFrame:
    """As ``salted_join``, but only keys of more than HOT_ROWS rows are shared out, and only theirs of the dictionary copied.

    The keys are counted in ``counted``, by default ``rows``, which should be cheap to read; hot ones are at most one
    row in HOT_ROWS, so they are broadcast.
    """
    hot = (rows if counted is None else counted).groupBy(*keys).agg(F.count("*").alias("_n")) \
        .where(F.col("_n") > HOT_ROWS).select(*keys, F.lit(True).alias("_hot"))
    salts = max(LEAST_SALTS, round(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    own = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", own).drop("_hot")
    right = dictionary.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def lookup_join(rows: DataFrame, dictionary: DataFrame, keys: list[str], spread: Column,
                size: Size, how: str = "left") -> DataFrame:
    """Equi-join with a dictionary that is unique on ``keys``."""
    if size.bounded:
        return rows.join(F.broadcast(dictionary), keys, how)
    return salted_join(rows, dictionary, keys, spread, how)


def key_filter(keys: DataFrame, column: str, rows: int) -> Callable[[Column], Column]:
    """A test that is true for all values of ``keys`` and false for nearly all others.

    Sixteen bits per key, as an array of longs: what tasks hold is two bytes per key of the
    dictionary, up to 8 MB. Beyond four million keys more foreign values pass, and the
    join behind the filter drops them.
    """
    bits = 1 << min(max((16 * rows).bit_length(), 13), 26)

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits))

    at = place(F.col(column))
    words = keys.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(pmod(xxhash64({column}), 64) AS int)))").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    # A constant: folded into one array when the plan is made.
    held = F.from_json(F.lit("[" + ",".join(map(str, table.tolist())) + "]"), "array<bigint>")

    def test(c: Column) -> Column:
        word = F.get(held, F.shiftright(place(c), 6).cast("int"))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(c), F.lit(64)).cast("int"))
        return word.bitwiseAND(mask) != 0

    return test


def bit_table(keys: DataFrame, column: str, most: int = 26) -> np.ndarray:
    """A bit for each value of ``keys`` (well mixed longs), by its low bits, for tasks that test arrays of keys.

    Sixteen bits per key, 2 ** ``most`` at most, which is 8 MB: beyond four million keys more foreign values pass.
    """
    bits = 1 << min(max((16 * keys.count()).bit_length(), 13), most)
    words = keys.groupBy(F.shiftright(F.col(column).bitwiseAND(F.lit(bits - 1)), 6).alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast({column} & 63 AS int)))").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.view(np.uint64)


def may_be_in(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """True for all values of the keys that ``bit_table`` was made of, and false for nearly all others."""
    low = values & np.uint64(64 * len(table) - 1)
    return (table[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


def passing(values: Column, keys: DataFrame, column: str, rows: int) -> Column:
    """Of an array of strings those that may be among ``keys``, in their order: all that are, and few others.

    Beyond MOST_IN_PLAN keys the bit table is broadcast instead, and tasks test the hashes of the strings: the
    plan, which the driver holds and prints many times, then grows with no dictionary.
    """
    if rows <= MOST_IN_PLAN:
        return F.filter(values, key_filter(keys, column, rows))
    kept = key_keeper(keys.select(F.xxhash64(column).alias("hash")), "hash", "string")
    return kept(values, F.transform(values, lambda v: F.xxhash64(v)))


def key_keeper(hashes: DataFrame, column: str, kind: str) -> Callable[[Column, Column], Column]:
    """For an array of ``kind`` and one of hashes (longs), as long: the elements whose hash may be among ``hashes`` (well mixed).

    Not for use inside a lambda function, where Spark calls no Python.
    """
    ship(hashes.sparkSession)
    shared = hashes.sparkSession.sparkContext.broadcast(bit_table(hashes, column))

    @F.arrow_udf(f"array<{kind}>")
    def kept(values: pa.Array, asked: pa.Array) -> pa.Array:
        import pyarrow.compute as pc
        sizes = pc.fill_null(pc.list_value_length(asked), 0).to_numpy()
        flat = asked.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        good = np.flatnonzero(may_be_in(shared.value, flat.view(np.uint64)))
        owner = np.repeat(np.arange(len(sizes)), sizes)[good]
        ends = np.append(0, np.cumsum(np.bincount(owner, minlength=len(sizes))))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.flatten().take(pa.array(good)))

    # Told so, the planner keeps steps that build on each other apart; it cannot run one call inside another's lambda functions.
    return kept.asNondeterministic()


def _broadcast_values(df: DataFrame, found: DataFrame, wanted: str, out: str) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    table = found.select("key", "value").toArrow()
    shared = spark.sparkContext.broadcast(
        (table.column("key").to_pylist(), table.column("value").to_pylist()))

    @F.arrow_udf("array<string>")
    def look_up(words: pa.Array) -> pa.Array:
        import pyarrow.compute as pc
        arrays = getattr(shared, "_arrays", None)
        if arrays is None:
            arrays = shared._arrays = tuple(pa.array(v, pa.string()) for v in shared.value)
        keys, values = arrays
        at = pc.index_in(words.flatten().cast(pa.string()), value_set=keys)
        hits = values.take(at)
        sizes = pc.fill_null(pc.list_value_length(words), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()),
                                    pc.cumulative_sum(sizes).cast(pa.int32())])
        return pa.ListArray.from_arrays(offsets, hits)

    return df.withColumn(out, look_up(F.col(wanted)))


def _joined_values(df: DataFrame, found: DataFrame, wanted: str, out: str, size: Size) -> DataFrame:
    """Rows without any string that the filter lets pass get nulls and are not shuffled; the others are joined."""
    # Rows with equal strings share one look-up by the hash of these; two that share a hash get the hits of
    # both, and each takes its own. The dictionary is written, so that the join has a plain shuffle on both
    # sides, whose hot partitions adaptive execution splits.
    values = settle(found.select("key", "value"), "values")
    nothing = F.transform(wanted, lambda w: F.lit(None).cast("string"))
    none = F.array().cast("array<string>")
    asked_for = F.coalesce(passing(F.array_distinct(wanted), values, "key", size.rows), none)
    # The strings are looked for once: three branches read them.
    keyed = settle(df.withColumn("_keys", asked_for), "wanted", "zstd")
    plain = keyed.where(F.size("_keys") == 0).withColumn(out, nothing).drop("_keys")
    keyed = keyed.where(F.size("_keys") > 0).withColumn("_words", F.xxhash64("_keys"))
    # Strings and values meet by the hash of the string, so no string is asked for in full.
    # Most rows ask for other strings than the next: telling equal ones first would move all lists once more.
    asked = keyed.select("_words", F.explode(F.transform("_keys", lambda k: F.xxhash64(k))).alias("hash"))
    hits = asked.join(values.withColumn("hash", F.xxhash64("key")).hint("merge"), "hash")
    per_row = hits.groupBy("_words").agg(
        F.map_from_entries(F.collect_set(F.struct("key", "value"))).alias("_hits"))
    # Unique on the right; adaptive execution splits words that fill a partition.
    joined = keyed.drop("_keys").join(per_row, "_words", "left")
    value = F.transform(wanted, lambda w: F.element_at(F.col("_hits"), w))
    return joined.withColumn(out, F.when(F.col("_hits").isNull(), nothing).otherwise(value)) \
        .drop("_words", "_hits").unionByName(plain)


def attach_values(df: DataFrame, wanted: str, out: str, found: DataFrame, spread: Column,
                  size: Size, plan: str | None = None) -> DataFrame:
    """Add ``out``: for every string of the array ``wanted`` its ``value``, or null.

    ``found`` is (key, value), unique on key. ``plan`` is "broadcast" or "join"; by
    default the checked ``size`` decides.
    """
    plan = plan or ("broadcast" if size.bounded else "join")
    if plan == "broadcast":
        return _broadcast_values(df, found, wanted, out)
    return _joined_values(df, found, wanted, out, size)
