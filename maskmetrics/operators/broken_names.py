"""Dictionary names that a layout has broken: wrapped, hyphenated, run together, in addresses, or misspelt by a letter."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maskmetrics.functions.skeleton import Hashes, halves, neighbourhood, shares_half, skeletons, stretches, written
from maskmetrics.operators.lookup import Size, bit_table, lookup_join, may_be_in, measure
from maskmetrics.operators.pii import SPAN, _without_overlaps, splice_spans
from maskmetrics.operators.registry import Registry
from maskmetrics.session import settle, ship, spread_small

# Letters and digits of a name at least, to be found in another layout, and to be found with a wrong letter.
LEAST = 5
LEAST_MISSPELT = 8
# A layout may cut so many further pieces out of a name.
MORE_PIECES = 2
# Texts that a task holds at once, in characters.
SLICE = 1 << 19
# What a find counts for, in characters, where finds may be broadcast.
SPAN_CHARS = 64


def _values(registry: Registry, abbreviated: bool) -> DataFrame:
    """(value, alias, ordinal, form, exact): every form of a name; an abbreviation is never misspelt."""
    rows = registry.df.select("value", "alias", "ordinal", F.col("value").alias("form"), F.lit(False).alias("exact"))
    if not abbreviated:
        return rows
    words = F.regexp_extract_all("value", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    initials = F.array_join(F.transform(F.slice(words, F.lit(1), F.size(words) - 1), lambda w: F.substring(w, 1, 1)), "")
    short = rows.where(F.size(words) > 1).select("value", "alias", "ordinal", F.concat(initials, F.element_at(words, -1)).alias("form"),
                                                 F.lit(True).alias("exact"))
    return rows.unionByName(short)


def deletion_index(registry: Registry, abbreviated: bool = False) -> DataFrame:
    """(key, skeleton, alias, ordinal, exact, pieces): names by the hashes of their letters and digits, whole and without each letter.

    A name of fewer than LEAST letters and digits is not in the index; one of fewer than LEAST_MISSPELT is there
    whole only. Names that have the same letters and digits share the alias of the first in dictionary order.
    """
    ship(registry.df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = skeletons([v or "" for v in batch.column(0).to_pylist()])
            # A value is one stretch, whatever stands between its pieces.
            owner = np.unique(s.owner)
            first, last = np.searchsorted(s.owner, owner), np.searchsorted(s.owner, owner, side="right") - 1
            start, end = s.starts[first], s.ends[last]
            pieces = last - first + 1
            good = end - start >= LEAST
            owner, start, end, pieces = owner[good], start[good], end[good], pieces[good]
            exact = batch.column(3).to_numpy(zero_copy_only=False)[owner]
            which, keys = neighbourhood(s, start, end, LEAST_MISSPELT)
            stays = ~exact[which] | (np.arange(len(which)) < len(start))
            which, keys = which[stays], keys[stays]
            at = pa.array(owner[which])
            names = written(s, start, end)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array([names[i] for i in which], pa.string()), batch.column(1).take(at), batch.column(2).take(at),
                 batch.column(3).take(at), pa.array(pieces[which].astype(np.int32))], names=["key", "skeleton", "alias", "ordinal", "exact", "pieces"])

    forms = _values(registry, abbreviated).select("form", "alias", F.col("ordinal").cast("long").alias("ordinal"), "exact")
    rows = forms.mapInArrow(run, "key long, skeleton string, alias string, ordinal long, exact boolean, pieces int")
    first = F.min(F.struct("exact", "ordinal", "alias")).alias("f")
    return rows.groupBy("key", "skeleton").agg(first, F.max("pieces").alias("pieces")).select("key", "skeleton", "f.alias", "f.ordinal", "f.exact", "pieces")


def half_table(index: DataFrame) -> np.ndarray:
    """A bit table of the hashes of whole names and of the halves of those that may be misspelt, each by two of its parts; 32 MB at most."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = skeletons(batch.column(0).to_pylist())
            last = np.searchsorted(s.owner, np.arange(len(batch)), side="right") - 1
            start, end = s.starts[np.searchsorted(s.owner, np.arange(len(batch)))], s.ends[last]
            whole, long = Hashes(s.chars).whole(start, end), end - start >= LEAST_MISSPELT
            keys = np.concatenate([whole, *halves(s, start[long], end[long])])
            keys = np.unique(np.concatenate([keys, keys >> np.uint64(32)]))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["half"])

    keys = index.select("skeleton").distinct().mapInArrow(run, "half long").distinct()
    return bit_table(settle(keys, "name-halves"), "half", 28)


def _digits(c: Column | str) -> Column:
    return F.regexp_replace(c, r"\P{N}", "")


def _stretches_of(texts: DataFrame, index: DataFrame) -> DataFrame:
    """(text_key, start, end, skeleton, keys): stretches of the texts (text_key, text) with hashes that the index may hold."""
    shape = index.agg(F.max("pieces").alias("p"), F.collect_set(F.char_length("skeleton")).alias("n")).first()
    sizes = np.zeros(max(shape["n"], default=0) + 3, np.bool_)
    for n in shape["n"]:
        sizes[n] = True
        if n >= LEAST_MISSPELT:
            sizes[n - 1:n + 2] = True
    sizes[-1] = False
    pieces = (shape["p"] or 0) + MORE_PIECES
    shared = texts.sparkSession.sparkContext.broadcast((half_table(index), bit_table(index, "key")))

    def slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
        texts_, start, held = batch.column(1).to_pylist(), 0, 0
        for i, text in enumerate(texts_):
            held += len(text)
            if held > SLICE or i + 1 == len(texts_):
                yield batch.column(0).slice(start, i + 1 - start), texts_[start:i + 1]
                start, held = i + 1, 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half, table = shared.value

        def held(hashes: np.ndarray) -> np.ndarray:
            return may_be_in(half, hashes) & may_be_in(half, hashes >> np.uint64(32))

        for batch in batches:
            for keys, some in slices(batch):
                s = skeletons(some)
                owner, start, end = stretches(s, pieces, sizes)
                near = shares_half(s, start, end, LEAST_MISSPELT, held)
                owner, start, end = owner[near], start[near], end[near]
                which, hashes = neighbourhood(s, start, end, LEAST_MISSPELT - 1)
                good = may_be_in(table, hashes)
                which, hashes = which[good], hashes[good]
                order = np.argsort(which, kind="stable")
                kept, counts = np.unique(which, return_counts=True)
                offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                a, b = start[kept], end[kept]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(owner[kept])), pa.array(s.place[a].astype(np.int32)), pa.array((s.place[b - 1] + 1).astype(np.int32)),
                     pa.array(written(s, a, b), pa.string()), pa.ListArray.from_arrays(offsets, pa.array(hashes[order].view(np.int64)))],
                    names=["text_key", "start", "end", "skeleton", "keys"])

    return texts.mapInArrow(run, "text_key binary, start int, end int, skeleton string, keys array<long>")


def find_broken(df: DataFrame, column: str, registry: Registry, out: str = "broken", abbreviated: bool = False) -> DataFrame:
    """Add ``out``: (start, end, alias, text, edits) of every name of the dictionary, whatever its layout, left to right.

    A name is its letters and digits in order, in any case. It is found where consecutive pieces of letters or
    digits give just these, with at most LONGEST_GAP other characters between two pieces: over a line end, with hyphens, dots or
    underscores, run together, in an address or a host name. Names of LEAST_MISSPELT letters and digits are
    also found with one letter wrong, missing or too much (``edits`` 1); digits never differ. A name does
    not begin or end inside a run of letters. Where finds overlap, fewer edits go first, then the longer one, then
    the one further left. ``abbreviated`` also looks for the last word behind the initials of those before it. Null
    and empty texts have no finds.

    Names and text are keyed by a deletion neighbourhood: the hash of the characters, whole and without each
    letter. Two that are one edit apart share a key, so an equi-join meets them, and their edit distance is then
    verified. Each distinct stretch is joined once, however often it stands in texts. Before the join a bit table of the
    halves of names (one edit leaves one half as it is), 32 MB at most, and one of the keys, 8 MB at most, drop
    nearly all of the text.
    """
    spark = df.sparkSession
    none = F.array().cast("array<struct<start:int,end:int,alias:string,text:string,edits:int>>")
    if not registry.enabled or registry.size.rows == 0:
        return df.withColumn(out, none)
    ship(spark)
    index = settle(deletion_index(registry, abbreviated), "deletion-index")
    keyed = spread_small(df).withColumn("_key", F.unhex(F.sha2(F.coalesce(F.col(column), F.lit("")), 256)))
    texts = keyed.where(F.length(column) >= LEAST).select(F.col("_key").alias("text_key"), F.col(column).alias("text"))
    # The search over the texts is made once: two branches read it.
    held = settle(_stretches_of(texts, index), "stretches")
    asked = held.select("skeleton", F.explode("keys").alias("key")).distinct()
    met = asked.join(index.withColumnRenamed("skeleton", "name").hint("merge"), "key")
    edits = F.levenshtein("skeleton", "name", 1)
    good = met.withColumn("edits", edits).where(
        (F.col("edits") == 0) | ((F.col("edits") == 1) & ~F.col("exact") & (F.char_length("name") >= LEAST_MISSPELT) & (_digits("skeleton") == _digits("name"))))
    # Of several names for one stretch the one with fewer edits, then the first of the dictionary.
    one = settle(good.groupBy("skeleton").agg(F.min(F.struct("edits", "ordinal", "alias")).alias("f")), "named-stretches")
    one = lookup_join(held.drop("keys"), one, ["skeleton"], F.struct("text_key", "start", "end"), measure(one, "skeleton", "f.alias"), "inner")
    span = F.struct("start", "end", F.col("f.alias").alias("entity_type"), (-F.col("f.edits")).cast("double").alias("score"), F.lit("").alias("text"))
    # A set: equal texts give the same spans.
    per_text = one.groupBy("text_key").agg(F.collect_set(span).cast(f"array<{SPAN}>").alias("_spans"))
    resolved = per_text.select(F.col("text_key").alias("_key"), F.array_sort(_without_overlaps(F.col("_spans"))).alias("_spans"))
    resolved = settle(resolved, "broken-names")
    row = resolved.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("_spans")), F.lit(0)).alias("c")).first()
    # Few finds go to the texts. Else one row per distinct text on the right: adaptive execution splits a text with
    # very many copies.
    few = Size(row["n"], SPAN_CHARS * row["c"]).bounded
    joined = keyed.join(F.broadcast(resolved) if few else resolved.hint("merge"), "_key", "left")
    found = F.transform("_spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["entity_type"].alias("alias"),
        F.substring(F.col(column), s["start"] + 1, s["end"] - s["start"]).alias("text"), (-s["score"]).cast("int").alias("edits")))
    return joined.select(*df.columns, F.coalesce(found, none).alias(out))


def mask_broken(df: DataFrame, column: str, registry: Registry, abbreviated: bool = False) -> DataFrame:
    """Put the alias for every find of ``find_broken``; meant to follow ``mask_text``, which knows the registered form only."""
    found = find_broken(df, column, registry, "_broken", abbreviated)
    text = F.when(F.size("_broken") > 0, splice_spans(column, "_broken")).otherwise(F.col(column))
    return found.select(*(text.alias(c) if c == column else F.col(c) for c in df.columns))
