"""Stray personal data: detect typed spans, give each value one token, replace, restore."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import Column, DataFrame, functions as F

from maskmetrics.functions.pii_rules import (
    DEFAULT_TYPES, PATTERN_DETECTORS, SCORE_THRESHOLD, PatternDetector, is_false_positive,
    may_match)
from maskmetrics.functions.text import bind, nfc, strip, tokens, totals_before
from maskmetrics.operators.lookup import Size, attach_values
from maskmetrics.operators.masking import mask_table
from maskmetrics.operators.ordering import dense_index
from maskmetrics.operators.registry import Registry, get_mapping
from maskmetrics.session import settle, ship, spread_small

SPAN = "struct<start:int,end:int,entity_type:string,score:double,text:string>"
# Aliases of the dictionary that a detector must leave alone.
ALIASED = r"^(?:Client_[A-Z0-9]+|Resource_\d+|Contact_\d+)$"


@dataclass
class PluginDetector:
    """A detector outside Spark, e.g. a name-recognition model.

    ``find`` maps a list of texts to lists of (start, end, entity_type, score). It is
    None when its package is missing. ``state`` tells how it went.
    """

    name: str
    find: Callable[[list[str]], list[list[tuple[int, int, str, float]]]] | None
    enabled: bool = True
    _failed: object = field(default=None, repr=False)
    _message: object = field(default=None, repr=False)

    def state(self) -> str:
        if not self.enabled:
            return "disabled"
        if self.find is None:
            return "not_installed"
        return "failed" if self._failed is not None and self._failed.value else "active"

    def status_line(self) -> str:
        notes = {"active": "ACTIVE", "disabled": "INACTIVE (disabled)",
                 "not_installed": "INACTIVE (package not installed)",
                 "failed": f"failed on some texts ({self._message.value if self._message is not None else ''})"}
        return f"{self.name}: {notes[self.state()]}"


def pass2_state(enabled: bool, plugin: PluginDetector | None = None) -> str:
    """State of the detection pass; the pattern detectors are always available."""
    if not enabled:
        return "disabled"
    return "active" if plugin is None else plugin.state()


def _pattern_spans(text: Column, detector: PatternDetector) -> Column:
    """Spans in code points, from the lengths of the matches and of the gaps between."""
    nothing = F.array().cast(f"array<{SPAN}>")

    def located(found: Column) -> Column:
        # Both lists come from the same scan order: gap, match, gap, match, .. gap.
        if detector.context:
            pairs = bind(F.split(text, detector.pattern, -1), lambda gaps: F.transform(found, lambda h, i: F.struct(
                F.char_length(F.get(gaps, i)).alias("gap"), h.alias("hit"), detector.score_behind(before(gaps, found, i)).alias("score"))))
        else:
            pairs = F.filter(F.zip_with(F.split(text, detector.pattern, -1), found, lambda g, h: F.struct(
                F.char_length(g).alias("gap"), h.alias("hit"))), lambda p: p["hit"].isNotNull())
        spans = bind(pairs, lambda known: F.zip_with(known, totals_before(F.transform(
            known, lambda p: p["gap"] + F.char_length(p["hit"])), lambda a, x: a + x), span))
        if detector.valid is not None:
            spans = F.filter(spans, lambda s: detector.valid(s["text"]))
        return F.when(F.size(found) > 0, spans).otherwise(nothing)

    def before(gaps: Column, found: Column, i: Column) -> Column:
        """What stands between the last match but one and this one: a list of numbers shares its context."""
        return F.concat(F.coalesce(F.get(gaps, i - 1), F.lit("")), F.coalesce(F.get(found, i - 1), F.lit("")), F.get(gaps, i))

    def span(pair: Column, at: Column) -> Column:
        begin = at + pair["gap"]
        return F.struct(begin.alias("start"), (begin + F.char_length(pair["hit"])).alias("end"),
                        F.lit(detector.entity_type).alias("entity_type"),
                        (pair["score"] if detector.context else F.lit(float(detector.score))).alias("score"), pair["hit"].alias("text"))

    return F.when(may_match(text, detector), bind(tokens(text, detector.pattern), located)) \
        .otherwise(nothing)


class _First(AccumulatorParam):
    """Keeps the first text that is not empty."""

    def zero(self, value: str) -> str:
        return ""

    def addInPlace(self, value1: str, value2: str) -> str:
        return value1 or value2


_FOUND = pa.struct([
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("entity_type", pa.string()),
                                  ("score", pa.float64()), ("text", pa.string())]))), ("error", pa.string())])


def _plugin_spans(df: DataFrame, text: Column, plugin: PluginDetector) -> Column:
    """struct<spans, error> per text; a text that the detector cannot read loses only its own spans."""
    ship(df.sparkSession)
    find = plugin.find
    context = df.sparkSession.sparkContext
    failed = plugin._failed = context.accumulator(0)
    message = plugin._message = context.accumulator("", _First())

    @F.arrow_udf(f"struct<spans:array<{SPAN}>,error:string>")
    def run(texts: pa.Array) -> pa.Array:
        values = [t or "" for t in texts.to_pylist()]
        errors: list[str | None] = [None] * len(values)
        try:
            rows = find(values)
        except Exception:
            rows = []
            for i, value in enumerate(values):
                try:
                    rows += find([value])
                except Exception as e:
                    errors[i] = f"{type(e).__name__}: {e}"
                    rows.append([])
                    failed.add(1)
                    message.add(errors[i])
        out = [{"spans": [{"start": b, "end": e, "entity_type": k, "score": s, "text": v[b:e]} for b, e, k, s in found], "error": error}
               for v, found, error in zip(values, rows, errors)]
        return pa.array(out, _FOUND)

    return run(text)


def _without_overlaps(spans: Column) -> Column:
    """Higher score first, then longer, then further left; later ones must not touch it.

    One walk from left to right finds the spans that touch another; only those are ranked.
    """
    def touching(ordered: Column) -> Column:
        reach = totals_before(F.transform(ordered, lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        after = F.concat(F.transform(F.slice(ordered, 2, F.size(ordered)), lambda s: s["start"]),
                         F.array(F.lit(None).cast("int")))
        return F.transform(F.arrays_zip(ordered.alias("span"), reach.alias("reach"), after.alias("after")), lambda z: F.struct(
            z["span"].alias("span"), ((z["span"]["start"] < z["reach"]) | F.coalesce(z["after"] < z["span"]["end"], F.lit(False))).alias("touches")))

    def ranked_out(some: Column) -> Column:
        ranked = F.array_sort(F.transform(some, lambda s: F.struct(
            (-s["score"]).alias("a"), (s["start"] - s["end"]).alias("b"), s["start"].alias("c"),
            s["entity_type"].alias("d"), s.alias("span"))))
        return F.aggregate(
            ranked, F.array().cast(f"array<{SPAN}>"),
            lambda acc, r: F.when(
                F.exists(acc, lambda k: (k["start"] < r["span"]["end"]) & (r["span"]["start"] < k["end"])),
                acc).otherwise(F.concat(acc, F.array(r["span"]))))

    def resolve(marked: Column) -> Column:
        free = F.transform(F.filter(marked, lambda m: ~m["touches"]), lambda m: m["span"])
        rest = F.transform(F.filter(marked, lambda m: m["touches"]), lambda m: m["span"])
        return F.when(F.size(rest) == 0, free).otherwise(F.array_sort(F.concat(free, ranked_out(rest))))

    return F.when(F.size(spans) < 2, spans).otherwise(bind(bind(F.array_sort(spans), touching), resolve))


def explode_spans(detected: DataFrame, *keep: Column | str, spans: str = "spans") -> DataFrame:
    """One row per span. The outer form keeps Spark from pushing a size test of the spans
    under the projection that computes them, which would run every pattern twice."""
    return detected.select(*keep, F.explode_outer(spans).alias("s")).where(F.col("s").isNotNull())


def detect_pii(df: DataFrame, column: str, detectors: Sequence[PatternDetector] = PATTERN_DETECTORS,
               types: Sequence[str] | None = None, threshold: float = SCORE_THRESHOLD,
               plugin: PluginDetector | None = None, out: str = "spans",
               errors: str | None = None) -> DataFrame:
    """Add the spans of stray personal data that should be replaced, left to right.

    ``types`` replaces the default entity types as it is. Aliases of the dictionary and
    clear non-personal values are left out. ``errors`` names a column for the message of
    each text that the plug-in could not read; the patterns work on those as well.
    """
    df, text = spread_small(df), F.col(column)
    wanted = DEFAULT_TYPES if types is None else tuple(types)
    detectors = [d for d in detectors if d.entity_type in wanted and d.best >= threshold]
    parts = [_pattern_spans(text, d) for d in detectors]
    worth_it = may_match(text, *detectors)
    if plugin is not None and plugin.enabled and plugin.find is not None:
        # A column of its own, so that the detector runs once per text.
        df = df.withColumn("_plugin", _plugin_spans(df, text, plugin))
        parts.append(F.col("_plugin.spans"))
        worth_it = F.lit(True)
    every = F.concat(*parts) if parts else F.array().cast(f"array<{SPAN}>")
    usable = F.filter(every, lambda s: s["entity_type"].isin(*wanted) & (s["score"] >= threshold)
                      & ~s["text"].rlike(ALIASED) & ~is_false_positive(s["text"], s["entity_type"]))
    found = df.withColumn(out, F.when(worth_it, bind(usable, _without_overlaps))
                          .otherwise(F.array().cast(f"array<{SPAN}>")))
    if errors is not None:
        found = found.withColumn(errors, F.col("_plugin.error") if "_plugin" in df.columns else F.lit(None).cast("string"))
    return found.drop("_plugin")


def value_key(text: Column) -> Column:
    """Spellings of a detected value that share one token."""
    return nfc(F.lower(strip(text)))


@dataclass(frozen=True)
class TokenTable:
    """``df`` is (alias, value, entity_type, n, norm, sightings), unique on norm."""

    df: DataFrame
    size: Size


def assign_tokens(detected: DataFrame, doc_key: str, spans: str = "spans") -> TokenTable:
    """One token per value across all types, counted per type of the first sighting.

    Sightings are ordered by ``doc_key`` and, inside a text, from right to left.
    """
    seen = explode_spans(detected, F.col(doc_key).alias("doc"), spans=spans) \
        .select(value_key(F.col("s.text")).alias("norm"), "s.entity_type",
                F.struct("doc", (-F.col("s.start")).alias("back")).alias("place"), "s.text")
    first = seen.groupBy("norm").agg(
        F.min(F.struct("place", "entity_type", "text")).alias("f"), F.count("*").alias("sightings"))
    flat = first.select("norm", "sightings", F.col("f.entity_type").alias("entity_type"),
                        F.col("f.place.doc").alias("doc"), F.col("f.place.back").alias("back"),
                        F.col("f.text").alias("value"))
    numbered = dense_index(flat, ["entity_type"], ["doc", "back", "norm"], "i", measure="value")
    n = F.col("i") + 1
    alias = F.concat(F.lit("<"), "entity_type", F.lit("_"), n.cast("string"), F.lit(">"))
    return TokenTable(numbered.df.select(alias.alias("alias"), "value", "entity_type",
                                         n.alias("n"), "norm", "sightings"),
                      Size(numbered.rows, 2 * numbered.chars + 24 * numbered.rows))


def splice_spans(text: Column | str, spans: Column | str) -> Column:
    """Replace spans (struct with start, end, alias); they do not overlap.

    The text is taken apart into characters once and joined once, whatever the number of spans.
    """
    text, spans = (F.col(c) if isinstance(c, str) else c for c in (text, spans))

    def joined(chars: Column, ordered: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(ordered, lambda s: s["end"]))
        kept = F.zip_with(ordered, F.slice(ends, F.lit(1), F.size(ordered)), lambda s, e: F.concat(
            F.slice(chars, e + 1, s["start"] - e), F.array(s["alias"])))
        last = F.element_at(ends, -1)
        tail = F.slice(chars, last + 1, F.greatest(F.size(chars) - last, F.lit(0)))
        return F.array_join(F.concat(F.flatten(kept), tail), "")

    return bind(F.split(text, ""), lambda chars: bind(F.array_sort(spans), lambda ordered: joined(chars, ordered)))


def replace_spans(detected: DataFrame, column: str, table: TokenTable, spans: str = "spans",
                  plan: str | None = None) -> DataFrame:
    """Put each detected value's token in its place."""
    wanted = detected.withColumn("_wanted", F.transform(spans, lambda s: value_key(s["text"])))
    found = table.df.select(F.col("norm").alias("key"), F.col("alias").alias("value"))
    known = attach_values(wanted, "_wanted", "_values", found, F.col(column), table.size, plan)
    put = F.zip_with(F.col(spans), F.col("_values"), lambda s, a: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), a.alias("alias")))
    text = F.when(F.size(spans) > 0, splice_spans(column, put)).otherwise(F.col(column))
    return known.select(*(text.alias(c) if c == column else F.col(c)
                          for c in detected.columns if c != spans))


def full_mapping(registry: Registry, table: TokenTable | None = None) -> DataFrame:
    """(alias, value, source) of the dictionary and of the detections."""
    base = get_mapping(registry).withColumn("source", F.lit("registry"))
    if table is None:
        return base
    return base.unionByName(table.df.select("alias", "value").withColumn("source", F.lit("detection")))


@dataclass(frozen=True)
class Anonymized:
    df: DataFrame
    mapping: DataFrame
    tokens: TokenTable | None


def anonymize(df: DataFrame, column: str, doc_key: str, registry: Registry,
              pass2: bool = True, plugin: PluginDetector | None = None,
              types: Sequence[str] | None = None, plan: str | None = None) -> Anonymized:
    """Both passes: the dictionary over all columns, then stray data in ``column``."""
    masked = mask_table(df, registry, plan)
    if not registry.enabled or not pass2:
        return Anonymized(masked, full_mapping(registry), None)
    # Numbering and replacing both read the detections: they are made once.
    detected = settle(detect_pii(masked, column, types=types, plugin=plugin), "detected")
    table = assign_tokens(detected, doc_key)
    return Anonymized(replace_spans(detected, column, table), full_mapping(registry, table), table)


def pii_summary(detected: DataFrame, by: Sequence[str] = (), spans: str = "spans") -> DataFrame:
    """Detections and distinct values by entity type."""
    flat = explode_spans(detected, *by, spans=spans) \
        .select(*by, F.col("s.entity_type").alias("entity_type"),
                value_key(F.col("s.text")).alias("norm"))
    # Counting per value first keeps a value with very many sightings in small partial sums.
    per_value = flat.groupBy(*by, "entity_type", "norm").agg(F.count("*").alias("n"))
    return per_value.groupBy(*by, "entity_type").agg(
        F.sum("n").alias("detections"), F.count("*").alias("distinct_values"))
