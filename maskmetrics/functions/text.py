"""Text columns: normalization, aliases, boundaries, splicing. All JVM-side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from maskmetrics.functions.matcher import unlike_lower

# One word character: letters and digits of any script, and the underscore.
WORD = r"[\p{L}\p{N}_]"
_SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column | str) -> Column:
    """Trim any Unicode white space, not only blanks."""
    return F.regexp_replace(as_column(c), rf"^{_SPACE}+|{_SPACE}+$", "")


def fold_case(c: Column | str) -> Column:
    """``matcher.fold`` as a column: simple case folding, character by character."""
    c = as_column(c)
    odd, image = unlike_lower()
    return F.when(c.rlike(r"[^\p{ASCII}]"), F.lower(F.translate(c, odd, image))).otherwise(F.lower(c))


def nfc(c: Column | str) -> Column:
    """Unicode NFC; the composer is called only for values outside ASCII."""
    c = as_column(c)
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    return F.when(c.isNull() | ~c.rlike(r"[^\p{ASCII}]"), c).otherwise(composed)


def normalize(c: Column | str) -> Column:
    """The key under which two spellings of a value are the same value."""
    return nfc(F.lower(strip(c)))


def default_alias(category: Column | str, index: Column | str) -> Column:
    """Alias number ``index`` (from 0) of a category."""
    category, index = as_column(category), as_column(index)
    number = (index + 1).cast("string")
    capitalized = F.concat(F.upper(F.substring(category, 1, 1)),
                           F.lower(F.substring(category, 2, 1_000_000)))
    letter = F.char((F.least(index, F.lit(25)) + 65).cast("bigint"))
    return (F.when((category == "client") & (index < 26), F.concat(F.lit("Client_"), letter))
            .otherwise(F.concat(capitalized, F.lit("_"), number)))


def html_escape(c: Column | str) -> Column:
    c = as_column(c)
    # The HTML escapes, ampersand first.
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"),
                         ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def contains_ci(c: Column | str, term: Column | str) -> Column:
    """Case-insensitive literal search; ``term`` is a Python string or a column."""
    term = F.lit(term) if isinstance(term, str) else term
    return F.contains(F.lower(as_column(c)), F.lower(term))


def tokens(text: Column | str, pattern: Column | str) -> Column:
    """All matches of ``pattern``, left to right; never null."""
    pattern = pattern if isinstance(pattern, Column) else F.lit(pattern)
    return F.coalesce(F.regexp_extract_all(as_column(text), pattern, F.lit(0)),
                      F.array().cast("array<string>"))


def splice(text: Column | str, pattern: Column | str, replacements: Column) -> Column:
    """Put ``replacements[i]`` in the place of the i-th match of ``pattern``."""
    gaps = F.split(as_column(text), pattern, -1)
    ends = F.concat(replacements, F.array(F.lit("")))
    return F.array_join(F.zip_with(gaps, ends, lambda g, r: F.concat(g, r)), "")


def map_tokens(text: Column | str, pattern: str, change: Callable[[Column], Column]) -> Column:
    """Rewrite every match of ``pattern`` with an expression over the match."""
    return splice(text, pattern, F.transform(tokens(text, pattern), change))


def totals_before(values: Column, join: Callable[[Column, Column], Column], zero: int = 0) -> Column:
    """For each number of an array, what ``join`` makes of all numbers before it.

    Worked out in blocks: a growing array is copied with each step, so one fold over a long
    list would cost its square.
    """
    def inside(block: Column) -> Column:
        start = F.struct(F.lit(zero).alias("now"), F.array().cast("array<int>").alias("seen"))
        return F.aggregate(block, start, lambda acc, x: F.struct(
            join(acc["now"], x).alias("now"), F.concat(acc["seen"], F.array(acc["now"])).alias("seen")), lambda acc: acc["seen"])

    def whole(block: Column) -> Column:
        return F.aggregate(block, F.lit(zero), join)

    size = 128
    cut = F.when(F.size(values) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / size).cast("int")),
        lambda b: F.slice(values, b * size + 1, F.lit(size)))).otherwise(F.array().cast("array<array<int>>"))
    return bind(cut, lambda blocks: F.flatten(F.zip_with(
        F.transform(blocks, inside), inside(F.transform(blocks, whole)),
        lambda block, first: F.transform(block, lambda x: join(first, x)))))


def regex_quote(literal: str) -> str:
    """A Java regex that matches ``literal`` exactly."""
    return "".join("\\" + ch if ch in r"\.[]{}()*+-?^$|/&~#" else ch for ch in literal)
