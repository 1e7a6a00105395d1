"""Rewriting text, nested data and whole tables with the alias dictionary.

One contract, three plans picked by the size of the dictionary:

* "small": the values become one chain of JVM regex replacements;
* "medium": the dictionary is broadcast and an Arrow UDF walks the strings;
* "large": the words of each text are equi-joined with the dictionary, and a text
  receives only the entries whose words it holds.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from maskmetrics.functions.matcher import Matcher, shared_matcher
from maskmetrics.functions.text import WORD, bind, fold_case, regex_quote, splice, tokens
from maskmetrics.functions.variants import all_strings, put_strings
from maskmetrics.operators.lookup import MOST_IN_PLAN, key_filter, key_keeper
from maskmetrics.operators.registry import Registry, match_order
from maskmetrics.session import settle, ship, spread_small

# One noncharacter per value of the small plan: U+FDD0..U+FDEF never stand in text.
_MARKS = [chr(c) for c in range(0xFDD0, 0xFDF0)]
SMALL_VALUES = len(_MARKS)


def holds_text(dt: T.DataType) -> bool:
    """True for strings and for anything that has a string value inside."""
    if isinstance(dt, T.StructType):
        return any(holds_text(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return holds_text(dt.elementType)
    if isinstance(dt, T.MapType):
        return holds_text(dt.valueType)
    return isinstance(dt, T.StringType)


def holds_variant(dt: T.DataType) -> bool:
    """True for VARIANT and for anything that has such a value inside."""
    if isinstance(dt, T.StructType):
        return any(holds_variant(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return holds_variant(dt.elementType)
    if isinstance(dt, T.MapType):
        return holds_variant(dt.valueType)
    return isinstance(dt, T.VariantType)


# --- small plan -------------------------------------------------------------------

def boundary_guard(value: str) -> str:
    """A regex for ``value`` that must not touch a word at a word-character end."""
    forms = dict.fromkeys([value, unicodedata.normalize("NFC", value),
                           unicodedata.normalize("NFD", value)])
    body = "|".join(map(regex_quote, forms))
    ahead = f"(?<!{WORD})" if _is_word(value[0]) else ""
    behind = f"(?!{WORD})" if _is_word(value[-1]) else ""
    return f"(?iu){ahead}(?:{body}){behind}"


def _is_word(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def _small_rewriter(registry: Registry):
    if registry.size.rows > SMALL_VALUES:
        raise ValueError(f"the small plan holds {SMALL_VALUES} values, not {registry.size.rows}")
    entries = [(r["value"], r["alias"]) for r in match_order(registry).collect()]

    def rewrite(c: Column) -> Column:
        marked, direct = c, c
        for mark, (value, alias) in zip(_MARKS, entries, strict=False):
            pattern = boundary_guard(value)
            marked = F.regexp_replace(marked, pattern, mark)
            direct = F.regexp_replace(direct, pattern, alias)
        for mark, (_, alias) in zip(_MARKS, entries, strict=False):
            marked = F.replace(marked, F.lit(mark), F.lit(alias))
        # A text that already holds such a mark is rewritten without marks.
        return F.when(c.rlike("[﷐-﷯]"), direct).otherwise(marked)

    return rewrite


def _rewrite_column(c: Column, dt: T.DataType, rewrite) -> Column:
    """Apply ``rewrite`` to all string values under ``c``; keys and numbers stay."""
    if not holds_text(dt):
        return c
    if isinstance(dt, T.StructType):
        built = F.struct(*(_rewrite_column(c[f.name], f.dataType, rewrite).alias(f.name)
                           for f in dt.fields))
        return F.when(c.isNotNull(), built)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _rewrite_column(x, dt.elementType, rewrite))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda _, v: _rewrite_column(v, dt.valueType, rewrite))
    return rewrite(c)


# --- medium plan ------------------------------------------------------------------

def _rewrite_array(array: pa.Array, change, owner: np.ndarray) -> pa.Array:
    """Apply ``change`` to the string leaves of an Arrow array of any nesting; ``owner`` is the row that each element is of."""
    kind = array.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return change(array, owner)
    if pa.types.is_struct(kind):
        fields = [_rewrite_array(child, change, owner) for child in array.flatten()]
        done = pa.StructArray.from_arrays(fields, fields=list(kind), mask=array.is_null())
        # A null leaves nulls in parts that are never null (of a VARIANT, say): built anew, such parts are empty.
        bare = any(child.null_count and not field.nullable for child, field in zip(fields, kind))
        return pa.array(done.to_pylist(), kind) if bare else done
    if pa.types.is_list(kind):
        sizes = pc.fill_null(pc.list_value_length(array), 0).to_numpy()
        return pa.ListArray.from_arrays(_offsets(array), _rewrite_array(array.flatten(), change, np.repeat(owner, sizes)),
                                        type=kind)
    if pa.types.is_map(kind):
        offsets = array.offsets.to_numpy()
        start, stop = offsets[0], offsets[-1]
        items = _rewrite_array(array.items.slice(start, stop - start), change, np.repeat(owner, np.diff(offsets)))
        keys = array.keys.slice(start, stop - start)
        return pa.MapArray.from_arrays(_offsets(array), keys, items, type=kind)
    return array


def _offsets(array: pa.Array) -> pa.Array:
    """Offsets from 0 for a list or map array; a null slot stays null."""
    first = array.offsets[0].as_py()
    nulls = array.is_null().to_pylist()
    ends = [o - first for o in array.offsets.to_pylist()]
    return pa.array([None if i < len(nulls) and nulls[i] else o for i, o in enumerate(ends)],
                    pa.int32())


def _broadcast_plan(df: DataFrame, columns: list[str], registry: Registry) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    table = registry.df.select("value", "alias", "ordinal").toArrow()
    shared = spark.sparkContext.broadcast(
        list(zip(*(table.column(c).to_pylist() for c in ("value", "alias", "ordinal")))))
    packed = F.struct(*columns)
    row_type = df.select(packed.alias("r")).schema["r"].dataType

    @F.arrow_udf(row_type)
    def rewrite(rows: pa.Array) -> pa.Array:
        replace = shared_matcher(shared).replace

        def change(strings: pa.Array, _) -> pa.Array:
            coded = strings.dictionary_encode()
            done = pa.array([replace(s) for s in coded.dictionary.to_pylist()], strings.type)
            return done.take(coded.indices)

        return _rewrite_array(rows, change, np.arange(len(rows)))

    done = df.withColumn("_row", rewrite(packed))
    return done.select(*(F.col(f"_row.{c}").alias(c) if c in columns else F.col(c)
                         for c in df.columns))


# --- large plan -------------------------------------------------------------------

def _leaves(c: Column, dt: T.DataType) -> Column:
    """All string values under ``c`` as one array<string>."""
    empty = F.array().cast("array<string>")
    if isinstance(dt, T.StructType):
        parts = [_leaves(c[f.name], f.dataType) for f in dt.fields if holds_text(f.dataType)]
        return F.concat(*parts) if parts else empty
    if isinstance(dt, T.ArrayType):
        return F.coalesce(F.flatten(F.transform(c, lambda x: _leaves(x, dt.elementType))), empty)
    if isinstance(dt, T.MapType):
        return _leaves(F.map_values(c), T.ArrayType(dt.valueType))
    return F.when(c.isNotNull(), F.array(c)).otherwise(empty)


def _word_key(words: Column) -> Column:
    return F.array_join(words, " ")


def _words(text: Column | str) -> Column:
    return tokens(fold_case(text), rf"{WORD}+")


def _word_runs(words: Column, starts: Column, n: int) -> Column:
    """Every run of ``n`` consecutive words from one of the ``starts`` (from 0) as a key."""
    return F.transform(F.filter(starts, lambda i: i <= F.size(words) - n), lambda i: _word_key(F.slice(words, i + 1, F.lit(n))))


def _wordless_runs(text: Column, lengths: list[int]) -> Column:
    """Every piece of one of the ``lengths`` of the runs between words, marked as wordless."""
    gaps = F.filter(F.split(text, rf"{WORD}+"), lambda g: g != "")

    def pieces(gap: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.char_length(gap) - (n - 1))
        return F.when(F.char_length(gap) >= n, F.transform(starts, lambda i: F.concat(F.lit("\0"), F.substring(gap, i, F.lit(n))))) \
            .otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(gaps, lambda g: F.flatten(F.array(*(pieces(g, n) for n in lengths)))))


def _dictionary_keys(registry: Registry) -> DataFrame:
    """One row per spelling: (words, n_words, n_chars, value, alias, ordinal).

    A value without a word is its own key, behind a mark that no word holds.
    """
    nfd = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"),
                    F.col("value"), F.lit(False))
    nfc = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"),
                    F.col("value"), F.lit(False))
    foreign = F.col("value").rlike(r"[^\p{ASCII}]")
    spellings = F.when(foreign, F.array_distinct(F.array(F.col("value"), nfc, nfd))) \
        .otherwise(F.array("value"))
    entry = registry.df.select("value", "alias", "ordinal", F.explode(spellings).alias("spelling"))
    words = _words("spelling")
    key = F.when(F.size(words) > 0, _word_key(words)).otherwise(F.concat(F.lit("\0"), fold_case("spelling")))
    return entry.select(key.alias("words"), F.size(words).alias("n_words"), F.char_length("spelling").alias("n_chars"),
                        "value", "alias", "ordinal").distinct()


def _with_runs(keyed: DataFrame, opening: DataFrame | None, lookup: DataFrame, counts: list[int], lengths: list[int]) -> DataFrame:
    """``keyed`` with ``_runs``: the hashes, sorted, of the runs in ``_leaves`` that may be entries of a dictionary too large for a plan.

    What tasks hold of the dictionary is broadcast: two bytes per entry, and per first word, 8 MB each at most.
    """
    none = F.array().cast("array<string>")
    keyed = keyed.withColumn("_by_leaf", F.transform("_leaves", _words)).withColumn("_words", F.flatten("_by_leaf"))
    starts = F.transform("_words", lambda _, i: i)
    if opening is not None:
        opens = key_keeper(opening.select(F.xxhash64("word").alias("hash")), "hash", "int")
        starts = opens(starts, F.transform("_words", lambda w: F.xxhash64(w)))
    keyed = keyed.withColumn("_starts", starts).withColumn(
        "_leaf", F.flatten(F.transform("_by_leaf", lambda words, i: F.transform(words, lambda _: i))))

    def runs(n: int) -> Column:
        # No run goes on in the next leaf.
        inside = F.filter("_starts", lambda i: F.get("_leaf", i) == F.get("_leaf", i + (n - 1)))
        return F.transform(inside, lambda i: _word_key(F.slice("_words", i + 1, F.lit(n))))

    wordless = F.flatten(F.transform("_leaves", lambda t: _wordless_runs(fold_case(t), lengths))) if lengths else none
    made = F.array_distinct(F.flatten(F.array(none, wordless, *(runs(n) for n in counts))))
    keyed = keyed.withColumn("_made", F.transform(made, lambda r: F.xxhash64(r)))
    held = key_keeper(lookup.select("run"), "run", "long")
    return keyed.withColumn("_runs", F.array_sort(held(F.col("_made"), F.col("_made"))))


def _join_plan(df: DataFrame, columns: list[str], registry: Registry) -> DataFrame:
    """Texts meet only the dictionary entries whose words they hold.

    Rows without any word run that the filter lets pass hold no value: they are neither
    shuffled nor handed to Python. The others are joined with their entries by the hash of
    their word runs, equal lists of runs once.
    """
    spark = df.sparkSession
    ship(spark)
    keys = settle(_dictionary_keys(registry), "mask-keys")
    shapes = keys.groupBy("n_words", F.when(F.col("n_words") == 0, F.col("n_chars")).alias("n")).count().collect()
    counts = sorted({r["n_words"] for r in shapes} - {0})
    lengths = sorted(r["n"] for r in shapes if r["n_words"] == 0)
    packed = F.struct(*columns)
    row_type = df.select(packed.alias("r")).schema["r"].dataType
    none = F.array().cast("array<string>")
    # Runs meet by their hash: an entry too many, of other words with the same hash, changes no text. Written,
    # so that the join below has a plain shuffle on both sides, whose hot partitions adaptive execution splits.
    lookup = settle(keys.groupBy(F.xxhash64("words").alias("run")).agg(
        F.collect_set(F.struct("value", "alias", "ordinal")).alias("_found")), "mask-entries")
    # Nearly all runs are in no dictionary. They go before the shuffle, so that common
    # words do not gather in one task.
    # Of longer runs, only those are put together that open like an entry.
    opening = keys.where("n_words > 0").select(F.substring_index("words", " ", 1).alias("word")).distinct()
    longer = bool(counts) and counts[-1] > 1
    keyed = df.withColumn("_leaves", F.array_distinct(_leaves(packed, row_type)))
    if registry.size.rows > MOST_IN_PLAN:
        keyed = _with_runs(keyed, opening if longer else None, lookup, counts, lengths)
    else:
        may_hold = key_filter(keys.select("words"), "words", registry.size.rows)
        may_open = key_filter(opening, "word", opening.count()) if longer else lambda w: F.lit(True)

        def runs_of(leaf: Column) -> Column:
            def found(words: Column) -> Column:
                starts = F.filter(F.transform(words, lambda w, i: F.when(may_open(w), i)), lambda i: i.isNotNull())
                return bind(starts, lambda at: F.flatten(F.array(none, *(_word_runs(words, at, n) for n in counts))))

            runs = bind(_words(leaf), found)
            if lengths:
                runs = F.concat(runs, _wordless_runs(fold_case(leaf), lengths))
            return F.transform(F.filter(F.array_distinct(runs), may_hold), lambda r: F.xxhash64(r))

        keyed = keyed.withColumn("_runs", F.array_sort(F.array_distinct(F.flatten(F.transform("_leaves", runs_of)))))
    # The runs are made once: three branches read them.
    keyed = settle(keyed.select(*df.columns, "_runs"), "word-runs", "zstd")
    plain = keyed.where(F.size("_runs") == 0).select(*df.columns)
    # Texts with the same runs share one look-up by the hash of these. Two lists of runs that share a hash get the
    # entries of both: of these only those change a text that stand in it.
    keyed = keyed.where(F.size("_runs") > 0).withColumn("_key", F.xxhash64("_runs"))
    # Equal lists are not told first, which would move all lists once more; what they ask for is merged behind the join.
    asked = keyed.select("_key", F.explode("_runs").alias("run"))
    hits = asked.join(lookup.hint("merge"), "run")
    per_text = hits.groupBy("_key").agg(
        F.array_distinct(F.flatten(F.collect_set("_found"))).alias("_entries"))
    # One row per list of runs on the right: adaptive execution splits a list that fills
    # a partition of its own, and copying all texts once per salt would cost more.
    joined = keyed.drop("_runs").join(per_text, "_key", "left")

    @F.arrow_udf(row_type)
    def rewrite(rows: pa.Array, entries: pa.Array) -> pa.Array:
        # Rows with the same entries lie together, so the last matcher mostly serves the next row too.
        owned, last, matcher = [], None, None
        flat = entries.flatten()
        table = list(zip(*(flat.field(c).to_pylist() for c in ("value", "alias", "ordinal"))))
        at = 0
        for size in pc.fill_null(pc.list_value_length(entries), 0).to_pylist():
            own = table[at:at + size]
            at += size
            if own and own != last:
                last, matcher = own, Matcher(own).replace
            owned.append(matcher if own else None)

        def change(strings: pa.Array, owner: np.ndarray) -> pa.Array:
            done = (replace(text) if (replace := owned[i]) else text for text, i in zip(strings.to_pylist(), owner.tolist()))
            return pa.array(list(done), strings.type)

        return _rewrite_array(rows, change, np.arange(len(rows)))

    done = joined.withColumn("_row", rewrite(packed, F.col("_entries")))
    return done.select(*(F.col(f"_row.{c}").alias(c) if c in columns else F.col(c)
                         for c in df.columns)).unionByName(plain)


# --- public -----------------------------------------------------------------------

def mask_plan(registry: Registry) -> str:
    if registry.size.rows <= SMALL_VALUES:
        return "small"
    return "medium" if registry.size.bounded else "large"


def mask_columns(df: DataFrame, columns: list[str], registry: Registry,
                 plan: str | None = None) -> DataFrame:
    """Replace every known value in the given columns, whatever their nesting, also inside VARIANT values."""
    if not registry.enabled or registry.size.rows == 0:
        return df
    variants = [c for c in columns if holds_variant(df.schema[c].dataType)]
    if variants:
        return _mask_variants(df, columns, variants, registry, plan)
    return _mask_text_columns(df, columns, registry, plan)


def _mask_text_columns(df: DataFrame, columns: list[str], registry: Registry, plan: str | None) -> DataFrame:
    columns = [c for c in columns if holds_text(df.schema[c].dataType)]
    if not columns:
        return df
    plan = plan or mask_plan(registry)
    df = spread_small(df)
    if plan == "small":
        rewrite = _small_rewriter(registry)
        return df.select(*(_rewrite_column(F.col(c), df.schema[c].dataType, rewrite).alias(c)
                           if c in columns else F.col(c) for c in df.columns))
    if plan == "medium":
        return _broadcast_plan(df, columns, registry)
    return _join_plan(df, columns, registry)


def _mask_variants(df: DataFrame, columns: list[str], variants: list[str], registry: Registry, plan: str | None) -> DataFrame:
    """The strings of all variants become array columns, which every plan can mask, and then go back to their places."""
    ship(df.sparkSession)
    texts = {c: f"_variant_strings_{i}" for i, c in enumerate(variants)}
    read = F.arrow_udf(all_strings, "array<string>")
    held = spread_small(df).select("*", *(read(F.col(c)).alias(t) for c, t in texts.items()))
    masked = _mask_text_columns(held, [*columns, *texts.values()], registry, plan)
    return masked.select(*(F.arrow_udf(put_strings, df.schema[c].dataType)(F.col(c), F.col(texts[c])).alias(c) if c in texts else F.col(c)
                           for c in df.columns))


def mask_text(df: DataFrame, column: str, registry: Registry,
              plan: str | None = None) -> DataFrame:
    return mask_columns(df, [column], registry, plan)


def mask_nested(df: DataFrame, column: str, registry: Registry,
                plan: str | None = None) -> DataFrame:
    """String values at any depth of one column; map keys and numbers stay."""
    return mask_columns(df, [column], registry, plan)


def mask_table(df: DataFrame, registry: Registry, plan: str | None = None) -> DataFrame:
    """Every string value of every column: by value, not by column."""
    return mask_columns(df, df.columns, registry, plan)


_JSON_STRING = r'"(?:[^"\\]|\\.)*"\s*:?'


def mask_json(df: DataFrame, column: str, registry: Registry, plan: str | None = None) -> DataFrame:
    """A column of JSON texts: string values change, keys, numbers and layout stay."""
    if not registry.enabled or registry.size.rows == 0:
        return df
    literals = tokens(column, _JSON_STRING)
    decoded = F.transform(literals, lambda q: F.when(
        ~F.endswith(q, F.lit(":")), F.element_at(F.from_json(F.concat(F.lit("["), q, F.lit("]")), "array<string>"), 1)))
    # The values are masked as an array column, so that all plans serve JSON too.
    masked = mask_columns(df.withColumn("_values", decoded).withColumn("_plain", F.col("_values")),
                          ["_values"], registry, plan)
    changed = F.zip_with(F.arrays_zip("_values", "_plain"), literals, lambda v, q: F.when(
        v["_values"] != v["_plain"], F.regexp_extract(F.to_json(F.array(v["_values"])), r"(?s)^\[(.*)\]$", 1)).otherwise(q))
    text = splice(column, _JSON_STRING, changed)
    return masked.select(*(text.alias(c) if c == column else F.col(c) for c in df.columns))
