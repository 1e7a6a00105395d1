"""Consecutive numbers over data of any size, without pulling it into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from maskmetrics.session import settle


@dataclass(frozen=True)
class Indexed:
    df: DataFrame
    rows: int
    chars: int


def dense_index(df: DataFrame, within: Sequence[str], order: Sequence[str],
                index: str = "idx", position: str = "ordinal",
                measure: str | None = None) -> Indexed:
    """Number rows 0, 1, 2.. by ``order``, restarting for every value of ``within``.

    ``within`` holds a few values (categories), ``order`` makes rows unique. Rows are
    range-partitioned and sorted, written once with their place in the partition, and
    shifted by the sizes of the partitions before theirs. Only those sizes (one per
    partition, plus one per further ``within`` value) reach the driver.
    ``position`` numbers all rows in (within, order) order; ``measure`` names a string
    column whose total length is returned with the row count.
    """
    spark = df.sparkSession
    keys = [*within, *order]
    spread = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    fixed = settle(spread.withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_mid", 33).alias("_part")
    length = F.sum(F.char_length(measure)) if measure else F.lit(0)
    heads = (fixed.groupBy(part, *within)
             .agg(F.count("*").alias("n"), F.min("_mid").alias("first"),
                  F.coalesce(length, F.lit(0)).alias("chars"))
             .orderBy("first").collect())
    total, chars, seen, offsets = 0, 0, {}, []
    for h in heads:
        group = tuple(h[w] for w in within)
        offsets.append((h["first"], h["n"], seen.get(group, 0), total))
        seen[group] = seen.get(group, 0) + h["n"]
        total += h["n"]
        chars += h["chars"]
    schema = T.StructType([T.StructField(c, T.LongType(), False)
                           for c in ("_first", "_n", "_in_group", "_in_all")])
    # Every partition of the range exchange holds a run of ids that starts at `first`;
    # the run is found again by its partition and, where it has several, by `within`.
    small = spark.createDataFrame(offsets, schema)
    small = small.withColumn("_part", F.shiftright("_first", 33))
    numbered = (fixed.withColumn("_part", F.shiftright("_mid", 33))
                .join(F.broadcast(small), "_part")
                .where((F.col("_mid") >= F.col("_first"))
                       & (F.col("_mid") < F.col("_first") + F.col("_n")))
                .withColumn(index, F.col("_mid") - F.col("_first") + F.col("_in_group"))
                .withColumn(position, F.col("_mid") - F.col("_first") + F.col("_in_all")))
    return Indexed(numbered.select(*df.columns, index, position), total, chars)


@dataclass(frozen=True)
class Running:
    """A value that grows along the order: inside one part, and per finished part."""

    inside: Callable[[Window], Column]
    per_part: Column


def running_sum(value: str) -> Running:
    return Running(lambda w: F.sum(value).over(w), F.sum(value))


def running_rank() -> Running:
    return Running(lambda w: F.rank().over(w), F.count("*"))


def running_dense_rank(order: str) -> Running:
    return Running(lambda w: F.dense_rank().over(w), F.count_distinct(order))


def running(df: DataFrame, within: Sequence[str], order: Column, **values: Running) -> DataFrame:
    """Windows from the start of a group to the current value, for groups of any size.

    Rows are range-partitioned by (within, order), so a hot group is spread over many
    tasks and equal values stay together; each part then starts where the part before it
    ended.
    """
    spread = df.repartitionByRange(*within, order)
    fixed = settle(spread.withColumn("_part", F.spark_partition_id()), "runs")
    ends = fixed.groupBy("_part", *within).agg(*(r.per_part.alias(f"_{n}") for n, r in values.items()))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_part", *within, *(
        F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in values))
    inside = Window.partitionBy("_part", *within).orderBy(order)
    return fixed.join(starts, ["_part", *within]).select(
        *df.columns, *((r.inside(inside) + F.col(f"_{n}")).alias(n) for n, r in values.items()))
