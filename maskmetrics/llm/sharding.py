"""Proportional stratified interleaving of rows into shards, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from maskmetrics.session import settle

# Rows that one window partition should hold; the number of partitions follows from it.
ROWS_PER_BUCKET = 50_000
LEAST_BUCKETS = 256


def _buckets(rows: int) -> int:
    """A power of two, so that a bucket's limits are exact in floating point."""
    wanted = max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))
    return 1 << (wanted - 1).bit_length()


def interleave(df: DataFrame, strata: Sequence[str], key: Sequence[str], shards: int = 8,
               seed: int = 7) -> DataFrame:
    """Deal all rows into ``shards`` so that each one holds every stratum in its global share.

    Inside a stratum the rows are put in a seeded random order and the r-th of n gets the
    fractional rank (r + 1/2) / n. The order of all rows by fractional rank is cut into
    ``shards`` runs whose row counts differ by one at most. Returns the columns of ``df``
    with ``shard`` and ``slot`` (gapless from 0 inside a shard); columns of these names are
    replaced.

    A null stratum is a stratum of its own and a null key an ordinary key. Rows with equal
    keys are ordered by all their columns; fully equal rows are interchangeable. An empty
    table gives an empty result.

    No stratum is held by one task: a row's shuffle hash names one of many equal buckets, so
    ranks need a window inside a bucket and the counts of the buckets before it. The second
    order works alike, because fractional ranks are spread evenly by construction. Only
    counts meet in one place: one row per bucket.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    total = df.count()
    buckets = _buckets(total)
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    digest = F.md5(F.concat_ws("\x1f", F.lit(str(seed)), F.to_json(F.struct(*key))))
    rows = df.select(
        F.struct(*kept).alias("row"),
        F.to_json(F.struct(*strata)).alias("stratum"),
        digest.alias("dice"),
        F.xxhash64(F.to_json(F.struct(*kept))).alias("tie"),
    ).withColumn("bucket", F.shiftright(F.conv(F.substring("dice", 1, 8), 16, 10).cast("long") * buckets, 32))

    upto = Window.partitionBy("stratum").orderBy("bucket")
    counts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n")).select(
        "stratum", "bucket",
        (F.sum("n").over(upto) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("stratum")).alias("size"))
    inside = Window.partitionBy("stratum", "bucket").orderBy("dice", "tie")
    ranked = rows.join(counts, ["stratum", "bucket"]).select(
        "row", "dice", "tie", "stratum",
        ((2 * (F.row_number().over(inside) - 1 + F.col("before")) + 1) / (2 * F.col("size"))).alias("fraction"))
    # Written once: the counts below and the rows must come from one and the same ranking.
    ranked = settle(ranked.withColumn("bucket", F.floor(F.col("fraction") * buckets)), "interleaved")

    heads = ranked.groupBy("bucket").agg(F.count("*").alias("n"))
    heads = heads.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("bucket").orderBy("fraction", "dice", "stratum", "tie")
    place = F.row_number().over(inside) - 1 + F.col("before")
    placed = ranked.join(heads, "bucket").select("row", place.alias("place"))
    # Shard k starts at the first place p with p * shards >= k * total.
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    start = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard.cast("int"))
            .select("row.*", "shard", (F.col("place") - start).cast("long").alias("slot")))
