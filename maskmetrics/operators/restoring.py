"""From aliases back to values: text, HTML, query literals and filters."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, functions as F

from maskmetrics.functions.text import (
    WORD, html_escape, map_tokens, normalize, regex_quote, splice, tokens)
from maskmetrics.operators.lookup import Size, attach_values, measure
from maskmetrics.operators.masking import mask_table
from maskmetrics.operators.odd_aliases import held_strings
from maskmetrics.operators.registry import Registry
from maskmetrics.session import settle, spread_small

# How a token of a detected value looks, raw and HTML-escaped.
TOKEN = r"<[A-Z][A-Z_]*_\d+>"
ESCAPED_TOKEN = r"&lt;[A-Z][A-Z_]*_\d+&gt;"
_TOKEN_PARTS = r"^<([A-Z][A-Z_]*_\d+)>$"
# A token that lost its brackets must stand alone; an alias may stand inside a longer word.
_BARE = rf"(?<!{WORD})[A-Z][A-Z_]*_\d+(?!{WORD})"
_NUMBERED, _LETTERED = r"^(.*_)\d+$", r"^(.*_)[A-Z]$"
# What ends an alias behind its stem.
_ENDS = {"number": r"\d+", "letter": r"[A-Z](?![\p{L}\p{N}])"}
# Odd aliases, and stems, that one pattern lists; beyond, each text is given those that stand in it.
MOST_LISTED = 200
MOST_STEMS = 1_000

# A double-quoted literal, a doubled quote standing for one quote inside it.
LITERAL = r'"(?:[^"]|"")*"'
# The categories whose aliases may stand in a query literal.
LITERAL_CATEGORIES = ("Resource", "Contact", "Workspace", "Dataset", "Item")
LITERAL_ALIAS = "|".join([TOKEN, r"Client_[A-Z0-9]+", *(rf"{c}_\d+" for c in LITERAL_CATEGORIES)])


def _entries(mapping: DataFrame, html: bool) -> DataFrame:
    """(key, value) for every written form of an alias, unique on key."""
    value = html_escape("value") if html else F.col("value")
    base = mapping.select("alias", value.alias("value"))
    bare = F.regexp_extract("alias", _TOKEN_PARTS, 1)
    forms = [F.struct(F.lit(0).alias("rank"), F.col("alias").alias("key")),
             F.struct(F.lit(1).alias("rank"), F.when(bare != "", bare).alias("key"))]
    if html:
        forms.append(F.struct(F.lit(1).alias("rank"), html_escape("alias").alias("key")))
    # An alias of that very form goes before a form derived from another alias.
    return (base.select("value", F.explode(F.array(*forms)).alias("f"))
            .where(F.col("f.key").isNotNull())
            .groupBy("f.key").agg(F.min_by("value", F.struct("f.rank", "value")).alias("value")))


def _longest_of(ends: dict[str, str]) -> str:
    """A pattern for any of the texts, each followed by its end (a pattern), longer texts first.

    Texts that open alike share that part, so a match walks down one branch, however many there are.
    """
    def branch(texts: list[str], at: int) -> str:
        groups, own = [], None
        for opening, group in groupby(texts, lambda t: t[at:at + 1]):
            some = list(group)
            if not opening:
                own = ends[some[0]]
                continue
            until = len(commonprefix([some[0], some[-1]]))
            groups.append(regex_quote(some[0][at:until]) + branch(some, until))
        groups += [own] if own is not None else []
        return groups[0] if len(groups) == 1 else f"(?:{'|'.join(groups)})"

    return branch(sorted(ends), 0)


def _kind(alias: Column) -> Column:
    """struct(kind, text): a token; a stem with a number or a letter; or an odd alias, its text as it is."""
    numbered, lettered = F.regexp_extract(alias, _NUMBERED, 1), F.regexp_extract(alias, _LETTERED, 1)
    return (F.when(alias.rlike(_TOKEN_PARTS), F.struct(F.lit("token").alias("kind"), F.lit("").alias("text")))
            .when(numbered != "", F.struct(F.lit("number").alias("kind"), numbered.alias("text")))
            .when(lettered != "", F.struct(F.lit("letter").alias("kind"), lettered.alias("text")))
            .otherwise(F.struct(F.lit("odd").alias("kind"), alias.alias("text"))))


def _listed_pattern(stems: dict[str, set[str]], odd: set[str], html: bool) -> list[str | None]:
    """The alternatives, in the order in which they are tried: an odd alias goes before the stems if it continues one."""
    ends = {t: "(?:" + "|".join(e for k, e in _ENDS.items() if k in kinds) + ")" for t, kinds in stems.items()}
    lengths = sorted({len(t) for t in stems})
    longer = {t for t in odd if any(t[:n] in stems for n in lengths)}
    return [ESCAPED_TOKEN if html else None, TOKEN, *(_longest_of(e) if e else None for e in (dict.fromkeys(longer, ""), ends)),
            _BARE, _longest_of(dict.fromkeys(odd - longer, "")) if odd - longer else None]


def _row_pattern(parts: list[str | None]) -> Column:
    """``_listed_pattern`` for one row: what of the row's own strings (column ``found``) is not listed joins in at its place."""
    def own(*labels: str) -> Column:
        some = F.filter(F.coalesce("found", F.array().cast("array<struct<string:string,labels:array<string>>>")),
                        lambda s: F.arrays_overlap(s["labels"], F.array(*map(F.lit, labels))))
        ordered = F.array_sort(F.transform(some, lambda s: F.struct((-F.char_length(s["string"])).alias("n"), s["string"].alias("s"), s["labels"].alias("k"))))

        def written(x: Column) -> Column:
            literal = F.regexp_replace(x["s"], r"([\\.\[\]{}()*+\-?^$|/&~#])", r"\\$1")
            if labels[0] not in _ENDS:
                return literal
            ends = F.concat_ws("|", *(F.when(F.array_contains(x["k"], k), F.lit(e)) for k, e in _ENDS.items()))
            return F.concat(literal, F.lit("(?:"), ends, F.lit(")"))

        return F.when(F.size(ordered) > 0, F.array_join(F.transform(ordered, written), "|"))

    escaped, token, longer, ended, bare, odd = (F.lit(p) if p else None for p in parts)
    places = [escaped, token, longer, own("longer"), ended, own(*_ENDS), bare, odd, own("odd")]
    listed = "|".join(p for p in parts if p)
    return F.when(F.col("found").isNull(), F.lit(listed)).otherwise(F.concat_ws("|", *(p for p in places if p is not None)))


def _unlisted(named: DataFrame, with_stems: bool) -> DataFrame:
    """(string, labels) of the odd aliases, and of the stems too: what ends a stem, and whether an odd alias continues one."""
    kinds = named.where(F.col("form.kind").isin(*_ENDS)).select(F.col("form.text").alias("string"), F.col("form.kind").alias("label")).distinct()
    odd = named.where(F.col("form.kind") == "odd").select(F.col("alias").alias("string")).distinct()
    # A stem ends in an underscore.
    openings = F.transform(F.filter(F.sequence(F.lit(1), F.char_length("string")), lambda i: F.substring(F.col("string"), i, F.lit(1)) == "_"),
                           lambda i: F.substring(F.col("string"), F.lit(1), i))
    stems = kinds.select(F.col("string").alias("opening")).distinct()
    longer = odd.select("string", F.explode(openings).alias("opening")).join(stems, "opening", "left_semi").select("string").distinct()
    labelled = odd.join(longer.withColumn("label", F.lit("longer")), "string", "left").select("string", F.coalesce("label", F.lit("odd")).alias("label"))
    if with_stems:
        labelled = labelled.unionByName(kinds)
    return settle(labelled.groupBy("string").agg(F.collect_set("label").alias("labels")), "odd-aliases")


def _alias_pattern(df: DataFrame, column: str, mapping: DataFrame, html: bool) -> tuple[DataFrame, str | Column, Size]:
    """``df``, the pattern to look for in its texts (a column of the result where it differs by row), and the size of the mapping.

    Aliases are a stem and a number or a letter; the stems are few, so one pattern finds all aliases
    wherever they stand. An alias of another form is listed as it is: before the stems if it
    continues one, else after them, longer ones first.

    Beyond MOST_LISTED odd aliases, or MOST_STEMS stems, these do not go through the driver: an index finds which
    of them stand in a text, and the pattern of each text lists its own, with the same result.
    """
    named = mapping.where("alias <> ''").select("alias", "value", _kind(F.col("alias")).alias("form"))
    counts = named.groupBy(F.col("form.kind").alias("kind")).agg(
        F.count("*").alias("n"), F.count_distinct("form.text").alias("texts"),
        F.sum(F.char_length("alias") + F.coalesce(F.char_length("value"), F.lit(0))).alias("c")).collect()
    size = Size(sum(r["n"] for r in counts), sum(r["c"] for r in counts))
    few_stems = sum(r["texts"] for r in counts if r["kind"] in _ENDS) <= MOST_STEMS
    few_odd = few_stems and sum(r["texts"] for r in counts if r["kind"] == "odd") <= MOST_LISTED
    listed = [*(_ENDS if few_stems else ()), *(("odd",) if few_odd else ())]
    # At most MOST_STEMS and MOST_LISTED rows.
    forms = named.where(F.col("form.kind").isin(*listed)).select("form.kind", "form.text").distinct().collect() if listed else []
    stems: dict[str, set[str]] = {}
    for r in forms:
        if r["kind"] in _ENDS:
            stems.setdefault(r["text"], set()).add(r["kind"])
    parts = _listed_pattern(stems, {r["text"] for r in forms if r["kind"] == "odd"}, html)
    if few_odd:
        return df, "|".join(p for p in parts if p), size
    keyed = df.withColumn("_text_key", F.sha2(F.coalesce(F.col(column), F.lit("")), 256))
    texts = keyed.where(F.col(column).isNotNull()).select(F.col("_text_key").alias("text_key"), F.col(column).alias("text")).dropDuplicates(["text_key"])
    own = held_strings(texts, _unlisted(named, not few_stems)).withColumnRenamed("text_key", "_text_key")
    # One row per distinct text on the right: adaptive execution splits a text with very many copies.
    return keyed.join(own, "_text_key", "left"), _row_pattern(parts), size


def _found_values(df: DataFrame, column: str, mapping: DataFrame, html: bool,
                  plan: str | None) -> tuple[DataFrame, str | Column]:
    held, pattern, size = _alias_pattern(spread_small(df), column, mapping, html)
    size = Size(size.rows * (3 if html else 2), size.chars * (3 if html else 2))
    if isinstance(pattern, Column):
        held, pattern = held.withColumn("_pattern", pattern), F.col("_pattern")
    with_words = held.withColumn("_wanted", tokens(column, pattern))
    return attach_values(with_words, "_wanted", "_values", _entries(mapping, html),
                         F.col(column), size, plan), pattern


def restore_text(df: DataFrame, column: str, mapping: DataFrame, html: bool = False,
                 plan: str | None = None) -> DataFrame:
    """Replace every alias of ``mapping`` (alias, value), also inside a longer word.

    All digits behind a stem belong to the alias, and a letter only if no letter or digit
    follows. Tokens that lost their angle brackets are
    restored too, but only where they stand alone.
    """
    found, pattern = _found_values(df, column, mapping, html, plan)
    known = F.transform(F.arrays_zip("_wanted", "_values"),
                        lambda p: F.coalesce(p["_values"], p["_wanted"]))
    changed = F.exists("_values", lambda v: v.isNotNull())
    text = F.when(changed, splice(column, pattern, known)).otherwise(F.col(column))
    return found.select(*(text.alias(c) if c == column else F.col(c) for c in df.columns))


def restore_html(df: DataFrame, column: str, mapping: DataFrame,
                 plan: str | None = None) -> DataFrame:
    """As ``restore_text``, with values escaped and escaped alias forms known."""
    return restore_text(df, column, mapping, html=True, plan=plan)


def restore_counts(df: DataFrame, column: str, mapping: DataFrame, html: bool = True,
                   out: str = "restored", plan: str | None = None) -> DataFrame:
    """Number of distinct alias forms that are restored in each row."""
    found, _ = _found_values(df, column, mapping, html, plan)
    pairs = F.filter(F.arrays_zip("_wanted", "_values"), lambda p: p["_values"].isNotNull())
    forms = F.size(F.array_distinct(F.transform(pairs, lambda p: p["_wanted"])))
    return found.select(*df.columns, forms.cast("long").alias(out))


def without_categories(mapping: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """A mapping that leaves some categories masked, e.g. ``["Resource_"]``."""
    keep = F.lit(True)
    for prefix in prefixes:
        keep = keep & ~F.startswith("alias", F.lit(prefix))
    return mapping.where(keep)


def literal_alias_pattern(categories: Sequence[str] = ()) -> str:
    """The alias forms in query literals, with those of further categories."""
    extra = "".join(rf"|{c[:1].upper()}{c[1:].lower()}_\d+" for c in categories)
    return LITERAL_ALIAS + extra


def rewrite_alias_literals(df: DataFrame, column: str, mapping: DataFrame,
                           categories: Sequence[str] = (), rewritten: str = "rewritten",
                           count: str = "n", plan: str | None = None) -> DataFrame:
    """Put real values for known aliases, inside double-quoted literals only."""
    pattern = literal_alias_pattern(categories)
    literals = tokens(column, LITERAL)
    inside = F.flatten(F.transform(literals, lambda q: tokens(q, pattern)))
    found = mapping.select(F.col("alias").alias("key"), "value")
    with_words = spread_small(df).withColumn("_wanted", inside)
    known = attach_values(with_words, "_wanted", "_values", found, F.col(column),
                          measure(mapping, "alias", "value"), plan)
    hits = F.filter(F.arrays_zip("_wanted", "_values"), lambda p: p["_values"].isNotNull())
    known = known.withColumn("_hits", hits).withColumn(
        "_map", F.map_from_entries(F.array_distinct(F.transform(
            "_hits", lambda p: F.struct(p["_wanted"], F.replace(p["_values"], F.lit('"'), F.lit('""')))))))

    def in_literal(q: Column) -> Column:
        return map_tokens(q, pattern, lambda a: F.coalesce(F.element_at("_map", a), a))

    text = F.when(F.size("_hits") > 0, map_tokens(column, LITERAL, in_literal)) \
        .otherwise(F.col(column))
    return known.select(*df.columns, text.alias(rewritten),
                        F.size("_hits").cast("long").alias(count))


def filter_by_alias(df: DataFrame, column: str, aliases: Sequence[str],
                    registry: Registry) -> DataFrame:
    """Rows whose real value hides behind one of the given aliases.

    The aliases are a short list typed by an analyst, so their values are broadcast.
    """
    if not registry.enabled:
        return df.where(F.col(column).isin(list(aliases)))
    asked = df.sparkSession.createDataFrame([(a,) for a in dict.fromkeys(aliases)], "alias string")
    known = asked.join(registry.df.select("alias", "norm"), "alias", "left")
    wanted = known.select(F.coalesce("norm", normalize("alias")).alias("_norm")).distinct()
    return df.withColumn("_norm", normalize(column)) \
        .join(F.broadcast(wanted), "_norm", "left_semi").select(*df.columns)


def filter_and_mask(df: DataFrame, column: str, aliases: Sequence[str],
                    registry: Registry) -> DataFrame:
    """The round trip: filter on aliases, compute on real data, answer in aliases."""
    return mask_table(filter_by_alias(df, column, aliases, registry), registry)
