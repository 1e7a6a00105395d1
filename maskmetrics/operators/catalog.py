"""Model definitions and catalogs: decoding parts, finding columns, searching lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskmetrics.functions.columns import classify_column, classify_unprotected_column
from maskmetrics.operators.registry import Registry, SensitiveColumn, alias_value, register_dynamic

# The payload type that is decoded, and the lines that name things.
INLINE = "InlineBase64"
TABLE_PATH = r"tables/([^/]+?)(?:\.tmdl$|/)"
COLUMN_LINE = r"(?i)^\s*column\s+'?([^']+)'?"
MEASURE_LINE = r"(?i)^\s*measure\s+(?:'([^']+)'|(\S+))"
DIMENSION_PREFIX = r"(?i)^(BI_|Dim_)"


def decode_parts(parts: DataFrame, strict: bool = True) -> DataFrame:
    """(.., path, text): parts of type InlineBase64; what is no base64 is left out.

    Listings and searches are ``strict``: a part with bytes that are no UTF-8 is left out.
    A column scan is not: it drops those bytes and reads the rest.
    """
    # Characters outside the alphabet are ignored, as base64 decoders commonly do.
    clean = F.regexp_replace("payload", r"[^A-Za-z0-9+/=]", "")
    raw = F.try_to_binary(clean, F.lit("base64")).cast("string")
    text = F.try_validate_utf8(raw) if strict else F.replace(F.make_valid_utf8(raw), F.lit("\ufffd"), F.lit(""))
    keep = [c for c in parts.columns if c not in ("payload", "payload_type")]
    return (parts.where((F.col("payload_type") == INLINE) & (F.col("payload") != ""))
            .select(*keep, text.alias("text")).where(F.col("text").isNotNull()))


def part_text(path: Column | str = "path", text: Column | str = "text") -> Column:
    """A decoded part under its header."""
    path, text = (F.col(c) if isinstance(c, str) else c for c in (path, text))
    return F.concat(F.lit("--- "), path, F.lit(" ---\n"), text)


def definition_text(decoded: DataFrame, model: str, order: str) -> DataFrame:
    """One text per model, parts in order. A model is one document, so its parts meet in
    one row; search and column scans below work on single parts and need no such row."""
    piece = F.struct(F.col(order).alias("o"), part_text().alias("t"))
    ordered = F.array_sort(F.collect_list(piece))
    return decoded.groupBy(model).agg(
        F.array_join(F.transform(ordered, lambda p: p["t"]), "\n\n").alias("text"))


def schema_columns(decoded: DataFrame) -> DataFrame:
    """(.., table, column) for every column line of a table's part."""
    keep = [c for c in decoded.columns if c not in ("path", "text")]
    name = F.regexp_extract("path", TABLE_PATH, 1)
    lines = decoded.select(*keep, name.alias("table"), "text").where("table != ''") \
        .select(*keep, "table", F.explode(F.split("text", "\n")).alias("line"))
    return lines.select(*keep, "table", F.regexp_extract("line", COLUMN_LINE, 1).alias("column")) \
        .where("column != ''")


def frame_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The same listing for DataFrames that are at hand."""
    rows = [(t, f.name) for t, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "table string, column string")


def detect_sensitive_columns(columns: DataFrame, prefix: str = DIMENSION_PREFIX) -> DataFrame:
    """(category, table, column) of dimension-table columns that hold names."""
    return columns.where(F.col("table").rlike(prefix)) \
        .select(classify_column("column").alias("category"), "table", "column") \
        .where(F.col("category").isNotNull()).distinct()


def detect_unprotected_columns(columns: DataFrame) -> DataFrame:
    """(family, table, column) of columns in any table that are never masked by name."""
    return columns.select(classify_unprotected_column("column").alias("family"), "table", "column") \
        .where(F.col("family").isNotNull()).distinct()


def unprotected_warnings(unprotected: DataFrame) -> DataFrame:
    """One warning text per column that the user should review."""
    hint = F.when(F.col("family") == "free_text", "free text, only screened by the detection pass") \
        .otherwise("descriptive, never masked automatically")
    text = F.concat(F.lit("'"), "table", F.lit("'["), "column", F.lit("] is NOT auto-anonymized: "), hint,
                    F.lit("; add it to sensitive_columns if it matters"))
    return unprotected.select("family", "table", "column", text.alias("warning"))


def coverage_missing(sensitive: Sequence[SensitiveColumn]) -> bool:
    """True when nothing is configured, so that real names would leave unmasked."""
    return not sensitive


def search_with_context(docs: DataFrame, key: str, text: str, term: str, context: int = 25,
                        limit: int | None = None) -> DataFrame:
    """Lines that hold ``term`` (any case), each with ``context`` lines around it.

    A hit closer than twice the context to the last kept hit is dropped. All others are
    returned, or the first ``limit`` of a document; ``found`` counts them all. Everything
    happens inside the document's row: no shuffle, and rows without the term are dropped
    before their lines are split.
    """
    needle = F.lower(F.lit(term))
    hits = F.filter(F.transform("_lines", lambda line, i: F.when(
        F.contains(F.lower(line), needle), i + 1)), lambda i: i.isNotNull())
    kept = F.aggregate(hits, F.array().cast("array<int>"), lambda acc, i: F.when(
        (F.size(acc) == 0) | (i - F.element_at(acc, -1) > 2 * context), F.concat(acc, F.array(i)))
        .otherwise(acc))
    per_doc = docs.where(F.contains(F.lower(F.col(text)), needle)) \
        .select(key, F.split(text, "\n").alias("_lines")).withColumn("_kept", kept)
    shown = per_doc.select(key, "_lines", F.size("_kept").alias("found"),
                           F.posexplode("_kept" if limit is None else F.slice("_kept", 1, limit)).alias("no", "line_number"))
    first = F.greatest(F.col("line_number") - context, F.lit(1))
    around = F.slice("_lines", first, F.col("line_number") + context - first + 1)
    return shown.select(key, (F.col("no") + 1).alias("match_no"), "line_number", "found",
                        F.trim(F.element_at("_lines", F.col("line_number"))).alias("match_line"),
                        F.array_join(around, "\n").alias("context"))


def list_named(decoded: DataFrame, pattern: str = MEASURE_LINE, out: str = "name") -> DataFrame:
    """Distinct names that lines of the texts declare, quoted or bare, sorted."""
    lines = decoded.select(F.explode(F.split("text", "\n")).alias("line")) \
        .where(F.col("line").rlike(pattern))
    quoted, bare = (F.regexp_extract("line", pattern, g) for g in (1, 2))
    return lines.select(F.when(quoted != "", quoted).otherwise(bare).alias(out)).distinct().orderBy(out)


def list_catalog(listing: DataFrame, registry: Registry, category: str, name: str = "name",
                 owner: str | None = None) -> tuple[DataFrame, Registry]:
    """A catalog listing with aliased names (and owners); ids stay as they are."""
    if not registry.enabled:
        return listing, registry
    grown = register_dynamic(registry, listing, name, category)
    if owner is not None:
        grown = register_dynamic(grown, listing, owner, "contact")
    shown = alias_value(listing, name, grown)
    return (shown if owner is None else alias_value(shown, owner, grown)), grown
