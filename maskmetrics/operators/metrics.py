"""Declarative dashboards: KPI rows, gauges, monthly series and ranked tables as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, Window

from maskmetrics.functions.text import normalize
from maskmetrics.operators.lookup import measure
from maskmetrics.operators.registry import Registry, alias_value
from maskmetrics.session import settle


@dataclass(frozen=True)
class Kpi:
    label: str
    metric: str
    format: str = "num"


@dataclass(frozen=True)
class Gauge:
    label: str
    metric: str
    target: float | None = None
    max: float = 1.0


@dataclass(frozen=True)
class Series:
    label: str
    metric: str


@dataclass(frozen=True)
class TableColumn:
    label: str
    metric: str
    format: str = "num"


@dataclass(frozen=True)
class Dashboard:
    title: str
    kpis: tuple[Kpi, ...]
    gauges: tuple[Gauge, ...]
    charts: Mapping[str, tuple[Series, ...]]
    entity: str
    columns: tuple[TableColumn, ...]
    sort: str
    limit: int = 15
    filters: tuple[str, ...] = ("company", "time")
    descending: bool = True


def slug(label: str) -> str:
    """A column name for a label: "Avg CSAT Score" -> avg_csat_score."""
    return re.sub(r"[^a-z0-9]+", "_", label.lower().replace("%", " pct ")).strip("_")


def metric_parts(metric: str) -> list[str]:
    """The kind and the field names of ``sum:f``, ``ratio:a:b`` or ``wavg:s:n``."""
    kind, *fields = metric.split(":")
    if {"sum": 1, "ratio": 2, "wavg": 2}.get(kind) != len(fields):
        raise ValueError(f"unknown metric {metric!r}")
    return [kind, *fields]


def metric_value(metric: str, prefix: str = "") -> Column:
    """A metric over columns that already hold the sums of its fields."""
    _, *fields = metric_parts(metric)
    sums = [F.col(prefix + f).cast("double") for f in fields]
    return sums[0] if len(sums) == 1 else F.try_divide(sums[0], sums[1])


def _sums(metrics: Iterable[str], prefix: str = "") -> list[Column]:
    fields = dict.fromkeys(f for m in metrics for f in metric_parts(m)[1:])
    return [F.sum(f).alias(prefix + f) for f in fields]


def apply_filters(fact: DataFrame, equals: Mapping[str, object] | None = None,
                  time: str = "ts", start: str | None = None, end: str | None = None) -> DataFrame:
    """Company / queue / resource equality and a half-open period, before aggregation."""
    for column, value in (equals or {}).items():
        fact = fact.where(F.col(column) == F.lit(value))
    if start is not None:
        fact = fact.where(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        fact = fact.where(F.col(time) < F.lit(end).cast("timestamp_ntz"))
    return fact


def kpis(fact: DataFrame, board: Dashboard) -> DataFrame:
    """(label, metric, value, format): all KPIs from one pass over the fact."""
    sums = fact.agg(*_sums(k.metric for k in board.kpis))
    rows = F.array(*(F.struct(F.lit(k.label).alias("label"), F.lit(k.metric).alias("metric"),
                              metric_value(k.metric).alias("value"), F.lit(k.format).alias("format"))
                     for k in board.kpis))
    return sums.select(F.inline(rows))


def gauges(fact: DataFrame, board: Dashboard) -> DataFrame:
    """(label, value, target, max, on_target, fill)."""
    sums = fact.agg(*_sums(g.metric for g in board.gauges))
    rows = F.array(*(F.struct(
        F.lit(g.label).alias("label"), metric_value(g.metric).alias("value"),
        F.lit(g.target).cast("double").alias("target"), F.lit(float(g.max)).alias("max"))
        for g in board.gauges))
    value = F.col("value")
    return sums.select(F.inline(rows)).select(
        "label", "value", "target", "max", (value >= F.col("target")).alias("on_target"),
        F.least(F.try_divide(value, "max"), F.lit(1.0)).alias("fill"))


def monthly(fact: DataFrame, series: Iterable[Series], time: str = "ts") -> DataFrame:
    """One row per month, one column per series; ratios are ratios of sums."""
    series = tuple(series)
    month = F.to_date(F.date_trunc("month", F.col(time).cast("timestamp_ntz"))).alias("month")
    sums = fact.groupBy(month).agg(*_sums((s.metric for s in series), "s_"))
    return sums.select("month", *(metric_value(s.metric, "s_").alias(slug(s.label)) for s in series))


def ranked(totals: DataFrame, name: str, metrics: Mapping[str, str], sort: str, limit: int,
           descending: bool = True) -> DataFrame:
    """Top ``limit`` rows of per-entity sums with a rank; ties go by name.

    ``metrics`` maps output columns to metrics over the summed fields.
    """
    order = F.desc(sort) if descending else F.asc(sort)
    top = totals.orderBy(order, name).limit(limit)
    # Only the kept rows pass through the window.
    rank = F.row_number().over(Window.orderBy(order, name)).cast("long")
    return top.select(rank.alias("rank"), F.col(name).alias("name"),
                      *(metric_value(m).alias(c) for c, m in metrics.items()))


def ranked_table(fact: DataFrame, board: Dashboard, key: str, names: DataFrame | None = None,
                 name: str | None = None) -> DataFrame:
    """The table of a dashboard. ``names`` (key, name) is joined after the sums are made."""
    fields = [c.metric for c in board.columns] + [f"sum:{board.sort}"]
    totals = fact.groupBy(key).agg(*_sums(fields))
    if names is not None:
        totals = totals.join(names, key)
    return ranked(totals, name or key, {slug(c.label): c.metric for c in board.columns},
                  board.sort, board.limit, board.descending)


def masked_table(table: DataFrame, registry: Registry, column: str = "name") -> DataFrame:
    """A limited table with its name column as aliases.

    The dictionary may be large and the table is not: the table's names pick their few
    entries first. A table that turns out large is joined as a whole.
    """
    if not registry.enabled:
        return table
    table = settle(table, "table")
    if not measure(table, column).bounded:
        return alias_value(table, column, registry)
    keyed = table.withColumn("norm", normalize(column))
    wanted = keyed.select("norm").distinct()
    entries = registry.df.select("norm", "alias").join(F.broadcast(wanted), "norm", "left_semi")
    return keyed.join(F.broadcast(entries), "norm", "left").select(
        *(F.coalesce("alias", F.col(c)).alias(c) if c == column else F.col(c)
          for c in table.columns))


_FORMATS = {
    "num": lambda v: F.format_number(v, 0),
    "hrs": lambda v: F.concat(F.format_number(v, 1), F.lit(" h")),
    "pct": lambda v: F.concat(F.format_number(v * 100, 1), F.lit("%")),
    "eur": lambda v: F.concat(F.lit("€ "), F.format_number(v, 0)),
    "rating": lambda v: F.format_number(v, 2),
}


def formatted(df: DataFrame, value: str = "value", kind: str = "format",
              out: str = "shown") -> DataFrame:
    """Add the display text of a number; comparisons stay on the number."""
    shown = F.lit(None).cast("string")
    for name, show in _FORMATS.items():
        shown = F.when(F.col(kind) == name, show(F.col(value))).otherwise(shown)
    return df.withColumn(out, shown)


# --- the four generic report queries ----------------------------------------------

def summary(fact: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """One row of named metrics."""
    return fact.agg(*_sums(metrics.values(), "s_")) \
        .select(*(metric_value(m, "s_").alias(c) for c, m in metrics.items()))


def breakdown(fact: DataFrame, by: str, metrics: Mapping[str, str]) -> DataFrame:
    return fact.groupBy(by).agg(*_sums(metrics.values(), "s_")) \
        .select(by, *(metric_value(m, "s_").alias(c) for c, m in metrics.items()))


def trend(fact: DataFrame, unit: str, metrics: Mapping[str, str], time: str = "ts") -> DataFrame:
    period = F.to_date(F.date_trunc(unit, F.col(time).cast("timestamp_ntz"))).alias("period")
    return breakdown(fact.select("*", period), "period", metrics)


def ranking(fact: DataFrame, by: str, metric: str, limit: int) -> DataFrame:
    totals = fact.groupBy(by).agg(*_sums([metric]))
    totals = totals.withColumn("value", metric_value(metric))
    top = totals.select(by, "value").orderBy(F.desc("value"), by).limit(limit)
    rank = F.row_number().over(Window.orderBy(F.desc("value"), by)).cast("long")
    return top.select(rank.alias("rank"), by, "value")
