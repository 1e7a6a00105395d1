"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

# The six ASCII characters that separate words: space and 09 to 0D.
BLANKS = " \\t\\n\\x0B\\f\\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_slices(batches: Iterable[pa.RecordBatch], text: int = 1, budget: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``budget`` bytes of text, or one row.

    Batches are counted in rows, texts are not of one length: this bounds what a task holds.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > budget:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def sent_with_text(df: DataFrame, kept: list[str], text: str) -> tuple[DataFrame, int]:
    """The columns ``kept`` with the text, and its place among them; a text that is kept goes to Python once."""
    if text in kept:
        return df.select(*kept), kept.index(text)
    return df.select(*kept, F.col(text).alias("__text")), len(kept)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def key_remainder(key: str, n: int) -> Column:
    """crc32 of the key, as text, modulo ``n``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % n


def labelled_keys(labels: DataFrame, key: str, label: str, held_out: Column | None, most: int) -> DataFrame:
    """(key, label 0 or 1): at most ``most`` keys that have one label, the smallest by hash.

    Null keys and labels, keys with both labels and keys that ``held_out`` takes are left out.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.where(~held_out) if held_out is not None else known
    one = known.groupBy(F.col(key).alias("key")).agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low = high")
    return one.select("key", (F.col("low") > 0).cast("int").alias("label")).orderBy(F.xxhash64("key"), "key").limit(most)
