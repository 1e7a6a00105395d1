"""Benchmark passages in documents: winnowed fingerprints, joined, then extended and verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maskmetrics.llm.common import byte_texts, text_slices
from maskmetrics.llm.words import ALPHANUMERIC, hashed_words, runs, whole_runs
from maskmetrics.operators.lookup import Size, lookup_join, measure
from maskmetrics.session import settle, ship

# Places of the table that keeps most foreign fingerprints inside their task; it drops none
# that the benchmark has, however many it has.
FILTER_BITS = 22
# A place in a row: a struct of three numbers.
PLACE_BYTES = 40


def winnow(hashes: np.ndarray, counts: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (counting all words) and hashes of the grams kept from each text.

    Of every ``window`` consecutive grams of ``gram`` words the smallest hash is kept, the
    leftmost where equal; a text with fewer grams keeps the smallest of all.
    """
    grams = runs(hashes, gram)
    starts, owner = whole_runs(counts, gram)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    values = grams[starts]
    fit = np.bincount(owner, minlength=len(counts))
    windows, _ = whole_runs(fit, window)
    kept = [np.zeros(0, np.int64)]
    if len(windows):
        view = np.lib.stride_tricks.sliding_window_view(values, window)
        # Distinct places: neighbouring windows mostly keep the same gram.
        best = windows + view[windows].argmin(axis=1)
        kept.append(best[np.concatenate([[True], best[1:] != best[:-1]])])
    first = np.cumsum(fit) - fit
    for text in np.flatnonzero((fit > 0) & (fit < window)):
        kept.append(np.array([first[text] + values[first[text]:first[text] + fit[text]].argmin()]))
    places = np.unique(np.concatenate(kept))
    return starts[places], values[places]


def _row_id(key: str, text: str) -> Column:
    """What a row's result depends on: its key and its text; equal for repeated rows only."""
    content = F.coalesce(F.col(text), F.lit(""))
    return F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.xxhash64(content), F.length(content))


def _words(text: bytes) -> list[bytes]:
    return text.translate(ALPHANUMERIC).split()


def _window_digest(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words)).digest()


def benchmark_prints(items: DataFrame, key: str, text: str, size: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """The distinct fingerprints (print) and windows (width, window, item) of all items.

    A window is ``size`` consecutive words. An item with fewer words, but not none, is one
    window; its fingerprint is that of the whole item.
    """
    ship(items.sparkSession)

    def prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            hashes, counts = hashed_words(byte_texts(batch.column(1)), ALPHANUMERIC)
            found = [winnow(hashes, counts, gram, size - gram + 1)[1]]
            short = (counts > 0) & (counts < size)
            first = np.cumsum(counts) - counts
            for width in np.unique(counts[short]):
                found.append(runs(hashes, int(width))[first[short & (counts == width)]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["print"])

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            names, widths, digests = [], [], []
            for name, text_bytes in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                words = _words(text_bytes)
                width = min(size, len(words))
                found = {_window_digest(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()
                names += [name] * len(found)
                widths += [width] * len(found)
                digests += list(found)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(widths, pa.int32()),
                                              pa.array(digests, pa.binary())], names=["item", "width", "window"])

    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    return (settle(rows.mapInArrow(prints, "print long").distinct(), "prints"),
            settle(rows.mapInArrow(windows, "item string, width int, window binary").distinct(), "windows"))


def _asked_size(asked: DataFrame) -> Size:
    """Rows of ``asked`` and the bytes of all their places, counted before a broadcast."""
    row = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("places")), F.lit(0)).alias("places")).first()
    return Size(row["n"], row["places"] * PLACE_BYTES)


def shared_windows(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                   item_text: str = "text", size: int = 10, gram: int = 5) -> DataFrame:
    """All windows of benchmark items in documents: (row, start, width, item), start in words.

    ``row`` is made from key and text by ``_row_id``. Words are runs of digits, letters and
    characters beyond ASCII, A to Z lower-cased. With ``size`` - ``gram`` + 1 grams per
    winnowing window every shared run of ``size`` words holds a fingerprint that both sides
    keep. Fingerprints are joined; each hit is extended to the windows around it, and these
    are joined by the digest of their words. So every shared window is found, and nothing
    else. Null and empty texts have no words; an empty side gives an empty result.
    """
    if not 1 <= gram <= size:
        raise ValueError("a gram must fit into a window")
    spark = df.sparkSession
    ship(spark)
    prints, windows = benchmark_prints(items, item_key, item_text, size, gram)
    short = sorted(r["width"] for r in windows.where(F.col("width") < size).select("width").distinct().collect())
    places = prints.select(F.col("print").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).cast("int").alias("at")).distinct()
    seen = np.zeros(1 << FILTER_BITS, np.bool_)
    seen[places.toArrow().column("at").to_numpy()] = True
    shared = spark.sparkContext.broadcast(np.packbits(seen))

    def hits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(shared.value).view(np.bool_)
        for batch in text_slices(batches, 1):
            hashes, counts = hashed_words(byte_texts(batch.column(1)), ALPHANUMERIC)
            first = np.cumsum(counts) - counts
            # A kept gram lies in windows that start up to size - gram words before it.
            found = [(*winnow(hashes, counts, gram, size - gram + 1), size - gram, size)]
            for width in short:
                starts, _ = whole_runs(counts, width)
                found.append((starts, runs(hashes, width)[starts], 0, width))
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for starts, values, back, width in found:
                keep = known[(values & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)]
                at = starts[keep]
                owner = np.searchsorted(first, at, side="right") - 1
                for column, value in zip(columns, (owner, at - first[owner], values[keep].view(np.int64),
                                                   np.full(len(at), back), np.full(len(at), width))):
                    column.append(value)
            owner, at, value, back, width = (np.concatenate(c) for c in columns)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(at.astype(np.int32)), pa.array(value),
                 pa.array(back.astype(np.int32)), pa.array(width.astype(np.int32))],
                names=["row", "at", "print", "back", "width"])

    slim = df.select(_row_id(key, text).alias("row"), F.col(text).alias("text"))
    sizes = measure(prints)
    found = slim.mapInArrow(hits, "row string, at int, print long, back int, width int")
    found = lookup_join(found, prints, ["print"], F.struct("row", "at"), sizes, "left_semi")
    # The places of one row: never more than its words.
    asked = settle(found.groupBy("row").agg(F.collect_set(F.struct("at", "back", "width")).alias("places")), "hits")

    def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            rows, starts, widths, digests = [], [], [], []
            for row, content, places in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)),
                                            batch.column(2).to_pylist()):
                words = _words(content)
                around = {(start, p["width"]) for p in places for start in range(p["at"] - p["back"], p["at"] + 1)
                          if 0 <= start and start + p["width"] <= len(words)}
                rows += [row] * len(around)
                starts += [s for s, _ in around]
                widths += [w for _, w in around]
                digests += [_window_digest(words[s:s + w]) for s, w in around]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string()), pa.array(starts, pa.int32()),
                                              pa.array(widths, pa.int32()), pa.array(digests, pa.binary())],
                                             names=["row", "start", "width", "window"])

    few = _asked_size(asked)
    known = F.broadcast(asked) if few.bounded else asked
    candidates = slim.join(known, "row").dropDuplicates(["row"]).mapInArrow(
        extend, "row string, start int, width int, window binary")
    return settle(lookup_join(candidates, windows, ["width", "window"], F.struct("row", "start"), measure(windows, "item"),
                              "inner").select("row", "start", "width", "item"), "spans")


def contamination(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", size: int = 10, gram: int = 5) -> DataFrame:
    """Add to each row: n_words, n_hit (words inside shared windows), n_items, items (sorted ids).

    One row out per row in; columns of these names are replaced, all others kept.
    """
    found = shared_windows(df, items, key, text, item_key, item_text, size, gram)
    covered = found.select("row", F.explode(F.sequence("start", F.col("start") + F.col("width") - 1)).alias("word")) \
        .distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    named = found.select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    per_row = settle(covered.join(named, "row"), "contaminated")
    new = ["n_words", "n_hit", "n_items", "items"]
    rows = df.select(F.struct(*(c for c in df.columns if c not in new)).alias("all"), _row_id(key, text).alias("row"),
                     F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0))
                     .cast("long").alias("n_words"))
    joined = lookup_join(rows, per_row, ["row"], F.col("row"), measure(per_row))
    return joined.select("all.*", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                         F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def without_contaminated(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                         item_key: str = "item_id", item_text: str = "text", size: int = 10, gram: int = 5) -> DataFrame:
    """The rows of ``df`` that hold no window of any item, with all their columns."""
    found = shared_windows(df, items, key, text, item_key, item_text, size, gram).select("row").distinct()
    bad = settle(found, "contaminated")
    rows = df.select(F.struct("*").alias("all"), _row_id(key, text).alias("row"))
    return lookup_join(rows, bad, ["row"], F.col("row"), measure(bad), "left_anti").select("all.*")
