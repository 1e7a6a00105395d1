"""The alias dictionary: built from sensitive columns, extended later, looked up both ways."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from maskmetrics.functions.text import default_alias, normalize, strip
from maskmetrics.operators.lookup import Size, lookup_join, spread_of
from maskmetrics.operators.ordering import Indexed, dense_index


@dataclass(frozen=True)
class SensitiveColumn:
    category: str
    table: str
    column: str


@dataclass(frozen=True)
class Registry:
    """``df`` is (category, norm, alias, value, ordinal), unique on norm and on alias."""

    df: DataFrame
    size: Size
    warnings: tuple[str, ...] = ()
    enabled: bool = True

    @property
    def degraded(self) -> bool:
        return bool(self.warnings)

    def disabled(self) -> "Registry":
        """The same dictionary with the switch off: every rewrite is the identity."""
        return replace(self, enabled=False)


_FIELDS = ["category", "norm", "alias", "value", "ordinal"]


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct trimmed, non-blank strings of a column; other types hold no names."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        df = df.where(F.lit(False))
    value = strip(F.col(column).cast("string"))
    return df.select(value.alias("value")).where(F.col("value") != "").distinct()


def sample_values(df: DataFrame, column: str, n: int = 3) -> DataFrame:
    """The first ``n`` distinct values in binary order, for a repeatable self-test."""
    return distinct_values(df, column).orderBy("value").limit(n)


def _check_category(name: str) -> None:
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"a category is one word, so that its aliases are: {name!r}")


def build_registry(spark: SparkSession, sensitive: Sequence[SensitiveColumn],
                   tables: Mapping[str, DataFrame] | None = None) -> Registry:
    """Number the values of all sensitive columns, category by category.

    A value belongs to the first (category, column) that holds it and is numbered in the
    binary order of its normalized form. A column that cannot be resolved adds a warning
    and leaves the others usable.
    """
    tables = tables or {}
    categories: dict[str, int] = {}
    warnings, parts = [], []
    for column_no, spec in enumerate(sensitive):
        _check_category(spec.category)
        order = categories.setdefault(spec.category, len(categories))
        try:
            table = tables[spec.table] if spec.table in tables else spark.table(spec.table)
            values = distinct_values(table, spec.column)
            values.schema  # resolves the plan
        except (PySparkException, KeyError) as e:
            warnings.append(f"Failed to load {spec.table}[{spec.column}]: {e}")
            continue
        parts.append(values.select(
            F.lit(spec.category).alias("category"), F.lit(order).alias("cat_no"),
            F.lit(column_no).alias("col_no"), "value", normalize("value").alias("norm")))
    if not parts:
        schema = "category string, norm string, alias string, value string, ordinal long"
        return Registry(spark.createDataFrame([], schema), Size(0, 0), tuple(warnings))
    sightings = parts[0]
    for part in parts[1:]:
        sightings = sightings.unionByName(part)
    first = sightings.groupBy("norm").agg(
        F.min(F.struct("cat_no", "col_no", "value", "category")).alias("f"))
    entries = first.select("f.category", "f.cat_no", "f.col_no", "norm", "f.value")
    numbered = dense_index(entries, ["cat_no"], ["col_no", "norm"], measure="value")
    df = numbered.df.select("category", "norm", default_alias("category", "idx").alias("alias"),
                            "value", "ordinal")
    return Registry(df, Size(numbered.rows, numbered.chars), tuple(warnings))


def new_entries(registry: Registry, names: DataFrame, column: str, category: str) -> Indexed:
    """The entries, in the columns of a registry, for values that it does not know yet."""
    _check_category(category)
    seen = distinct_values(names, column).select("value", normalize("value").alias("norm"))
    fresh = (seen.groupBy("norm").agg(F.min("value").alias("value"))
             .join(registry.df.select("norm"), "norm", "left_anti"))
    numbered = dense_index(fresh, [], ["norm"], measure="value")
    # A category never loses entries, so its size is its next free index.
    used = registry.df.where(F.col("category") == category).count()
    added = numbered.df.select(
        F.lit(category).alias("category"), "norm",
        default_alias(F.lit(category), F.col("idx") + used).alias("alias"), "value",
        (F.col("ordinal") + registry.size.rows).alias("ordinal"))
    return Indexed(added, numbered.rows, numbered.chars)


def extended(registry: Registry, new: Indexed) -> Registry:
    size = Size(registry.size.rows + new.rows, registry.size.chars + new.chars)
    return replace(registry, df=registry.df.unionByName(new.df), size=size)


def register_dynamic(registry: Registry, names: DataFrame, column: str,
                     category: str) -> Registry:
    """Add new values after the existing ones; known values keep their alias."""
    if not registry.enabled:
        return registry
    return extended(registry, new_entries(registry, names, column, category))


def match_order(registry: Registry) -> DataFrame:
    """The order in which values are matched in text: longest first, then registration."""
    return registry.df.select(*_FIELDS, F.char_length("value").alias("length")) \
        .orderBy(F.desc("length"), "ordinal")


def alias_value(df: DataFrame, column: str, registry: Registry) -> DataFrame:
    """Replace whole values by their alias; unknown values stay as they are."""
    if not registry.enabled:
        return df
    keyed = df.withColumn("norm", normalize(column))
    joined = lookup_join(keyed, registry.df.select("norm", "alias"), ["norm"],
                         spread_of(df), registry.size)
    return joined.select(*(F.coalesce("alias", F.col(c)).alias(c) if c == column else F.col(c)
                           for c in df.columns))


def unalias_value(df: DataFrame, column: str, registry: Registry) -> DataFrame:
    """Replace whole aliases by the value they stand for; unknown ones stay."""
    if not registry.enabled:
        return df
    known = registry.df.select(F.col("alias").alias("_alias"), F.col("value").alias("_value"))
    joined = lookup_join(df.withColumn("_alias", F.col(column)), known, ["_alias"],
                         spread_of(df), registry.size)
    return joined.select(*(F.coalesce("_value", F.col(c)).alias(c) if c == column else F.col(c)
                           for c in df.columns))


def get_mapping(registry: Registry) -> DataFrame:
    return registry.df.select("alias", "value")


def registry_stats(registry: Registry, detections: DataFrame | None = None) -> DataFrame:
    """One row: entities, detections, degraded flag and warnings."""
    found = (detections.agg(F.count_distinct("alias").alias("detections"))
             if detections is not None else
             registry.df.sparkSession.range(1).select(F.lit(0).cast("long").alias("detections")))
    return found.select(
        F.lit(registry.enabled).alias("enabled"),
        F.lit(registry.size.rows).cast("long").alias("registry_entities"), "detections",
        F.lit(registry.degraded).alias("degraded"),
        F.array(*map(F.lit, registry.warnings)).cast("array<string>").alias("warnings"))


def category_counts(registry: Registry) -> DataFrame:
    return registry.df.groupBy("category").agg(F.count("*").alias("entities"))


def self_test(df: DataFrame, category: str, column: str, n: int = 3) -> tuple[bool, DataFrame]:
    """Alias ``n`` sample values; false when the column yields no entity at all."""
    sample = sample_values(df, column, n).withColumnRenamed("value", column)
    registry = build_registry(df.sparkSession, [SensitiveColumn(category, "sample", column)],
                              {"sample": sample})
    return registry.size.rows > 0, registry.df.select("value", "alias")
