"""Datasets of the project and quarterly reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from maskmetrics.functions.text import contains_ci
from maskmetrics.operators.shapes import with_group_value
from maskmetrics.session import settle


def ratio(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(a.cast("double"), b.cast("double"))


def progress(tasks: DataFrame, project: str, done: Column) -> DataFrame:
    """Completed tasks, all tasks and their share."""
    return tasks.groupBy(project).agg(
        F.count_if(done).alias("completed"), F.count("*").alias("tasks")) \
        .withColumn("pct", ratio("completed", "tasks") * 100)


def budget_use(entries: DataFrame, project: str, actual: str, budget: str, date: str,
               today: Column) -> DataFrame:
    """Hours used against the budget, and days since the first entry."""
    return entries.groupBy(project).agg(
        F.sum(actual).alias("used"), F.sum(budget).alias("budget"), F.min(date).alias("started")) \
        .select(project, F.col("used").cast("double").alias("used"),
                F.col("budget").cast("double").alias("budget"),
                ratio("used", "budget").alias("budget_share"),
                F.datediff(today, F.to_date("started")).alias("days_elapsed"))


def phase_summary(entries: DataFrame, phase: str, actual: str, budget: str,
                  total_label: str = "Total") -> DataFrame:
    """Budget, spent, remaining and use per phase, with a grand total row."""
    # The grand total is made from the few rows per phase, not from the entries again.
    per_phase = entries.groupBy(phase).agg(F.sum(budget).alias("b"), F.sum(actual).alias("s"))
    sums = per_phase.rollup(phase).agg(F.sum("b").alias("b"), F.sum("s").alias("s"), F.grouping_id().alias("g"))
    return sums.select(
        F.when(F.col("g") == 1, F.lit(total_label)).otherwise(F.col(phase)).alias("phase"),
        (F.col("g") == 1).alias("is_total"), F.col("b").cast("double").alias("budget"),
        F.col("s").cast("double").alias("spent"), (F.col("b") - F.col("s")).cast("double").alias("remaining"),
        (ratio("s", "b") * 100).alias("pct_used"))


def status(value: Column | str, warn: float, over: float,
           labels: Sequence[str] = ("ok", "warn", "over")) -> Column:
    """``warn`` starts at its limit, ``over`` above its own."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value > over, labels[2]).when(value >= warn, labels[1]) \
        .when(value.isNotNull(), labels[0])


def budget_status(phases: DataFrame, warn: float = 80.0, over: float = 100.0) -> DataFrame:
    return phases.withColumn("status", status("pct_used", warn, over))


def gantt(tasks: DataFrame, project: str, task: str, start: str, end: str) -> DataFrame:
    """Start day (from 0), duration in days (both ends count) and length of the timeline."""
    spans = tasks.groupBy(project, task).agg(F.to_date(F.min(start)).alias("first_day"),
                                             F.to_date(F.max(end)).alias("last_day"))
    line = F.struct(F.min("first_day").alias("begin"), F.max("last_day").alias("finish"))
    placed = with_group_value(spans, [project], line, "line")
    return placed.select(
        project, task, F.datediff("first_day", "line.begin").alias("start_day"),
        (F.datediff("last_day", "first_day") + 1).alias("duration_days"),
        (F.datediff("line.finish", "line.begin") + 1).alias("total_days"))


def financial_overview(entries: DataFrame, by: str, revenue: str, cost: str) -> DataFrame:
    """Revenue, cost, profit, margin in percent and its band."""
    sums = entries.groupBy(by).agg(F.sum(revenue).alias("r"), F.sum(cost).alias("c"))
    margin = ratio(F.col("r") - F.col("c"), "r") * 100
    band = F.when(margin > 40, "high").when(margin >= 25, "medium").when(margin.isNotNull(), "low")
    return sums.select(by, F.col("r").cast("double").alias("revenue"), F.col("c").cast("double").alias("cost"),
                       (F.col("r") - F.col("c")).cast("double").alias("profit"),
                       margin.alias("margin_pct"), band.alias("band"))


def budget_analysis(entries: DataFrame, by: str, budget: str, actual: str) -> DataFrame:
    """Variance is actual minus budget, efficiency budget over actual."""
    sums = entries.groupBy(by).agg(F.sum(budget).alias("b"), F.sum(actual).alias("a"))
    return sums.select(by, F.col("b").cast("double").alias("budgeted"), F.col("a").cast("double").alias("actual"),
                       (F.col("a") - F.col("b")).cast("double").alias("variance"),
                       (ratio("b", "a") * 100).alias("efficiency_pct"))


def traffic_lights(projects: DataFrame, schedule: Column, budget: Column, margin: Column,
                   limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Green, amber or red for schedule and budget use (low is good) and margin (high is)."""
    lights = ("green", "amber", "red")
    low, high = limits["margin"]
    return projects.select(
        "*", status(schedule, *limits["schedule"], lights).alias("schedule_light"),
        status(budget, *limits["budget"], lights).alias("budget_light"),
        F.when(margin < low, "red").when(margin < high, "amber")
        .when(margin.isNotNull(), "green").alias("margin_light"))


def resource_shares(entries: DataFrame, resource: str, hours: str, rate: str) -> DataFrame:
    """Hours, estimated cost and share of all hours."""
    # Written once: the total sums the grouped sums, so the entries are read a single time.
    sums = settle(entries.groupBy(resource).agg(F.sum(hours).alias("h")), "hours")
    total = sums.agg(F.sum("h").cast("double").alias("total")).scalar()
    h = F.col("h").cast("double")
    return sums.select(resource, h.alias("hours"),
                       (F.col("h") * F.lit(rate).cast("decimal(6,2)")).cast("double").alias("est_cost"),
                       (F.try_divide(h, total) * 100).alias("pct_of_total"))


def resource_overview(entries: DataFrame, resource: str, hours: str, budget: str, date: str,
                      start: str, end: str) -> DataFrame:
    """Hours of the period, all hours, budget and what is left of it."""
    inside = (F.col(date) >= F.lit(start).cast("timestamp_ntz")) & (F.col(date) < F.lit(end).cast("timestamp_ntz"))
    sums = entries.groupBy(resource).agg(
        F.sum(F.when(inside, F.col(hours)).otherwise(0)).alias("p"), F.sum(hours).alias("t"),
        F.sum(budget).alias("b"))
    return sums.select(resource, F.col("p").cast("double").alias("this_period"),
                       F.col("t").cast("double").alias("total"), F.col("b").cast("double").alias("budget"),
                       (F.col("b") - F.col("t")).cast("double").alias("available"))


def reconcile(left: DataFrame, right: DataFrame, key: str, value: str,
              sources: tuple[str, str]) -> DataFrame:
    """One measure from two sources side by side, with the difference."""
    a, b = sources
    both = left.select(key, F.col(value).alias(a)).join(
        right.select(key, F.col(value).alias(b)), key, "full_outer")
    return both.select(key, F.col(a).cast("double").alias(a), F.col(b).cast("double").alias(b),
                       (F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))).cast("double").alias("difference"))


def for_audience(df: DataFrame, audience: str, financial: Sequence[str]) -> DataFrame:
    """The client version of a dataset has no financial columns."""
    return df.drop(*financial) if audience == "client" else df


def lookup_customer(df: DataFrame, customers: DataFrame, name: str, key: str, term: str) -> DataFrame:
    """Rows of the customers whose name contains ``term``, in any case."""
    return df.join(customers.where(contains_ci(name, term)).select(key), key, "left_semi")


def quarter_over_quarter(df: DataFrame, entity: str, date: str, **measures: Column) -> DataFrame:
    """Measures per entity and quarter, each with its value one quarter before."""
    quarter = F.to_date(F.date_trunc("quarter", F.col(date).cast("timestamp_ntz"))).alias("quarter")
    sums = df.groupBy(entity, quarter).agg(*(c.alias(n) for n, c in measures.items()))
    # One row per quarter and entity; a missing quarter gives no prior value.
    prior = sums.select(entity, F.to_date(F.add_months("quarter", 3)).alias("quarter"),
                        *(F.col(n).alias(f"prior_{n}") for n in measures))
    return sums.join(prior, [entity, "quarter"], "left")


def shares(df: DataFrame, by: str, count: str = "n", share: str = "share") -> DataFrame:
    """Rows per value and their share of all rows."""
    counts = settle(df.groupBy(by).agg(F.count("*").alias(count)), "counts")
    total = counts.agg(F.sum(count).alias("total")).scalar()
    return counts.withColumn(share, F.try_divide(F.col(count).cast("double"), total.cast("double")))


def age_bands(df: DataFrame, date: str, today: Column, limits: Sequence[tuple[str, int]],
              rest: str) -> DataFrame:
    """Rows per age band; ``limits`` are (label, days below)."""
    age = F.datediff(today, F.to_date(date))
    band = F.lit(rest)
    for label, below in reversed(list(limits)):
        band = F.when(age < below, label).otherwise(band)
    return df.groupBy(band.alias("band")).agg(
        F.count("*").alias("n"), F.min(age).alias("youngest_days"), F.max(age).alias("oldest_days"))


def maturity(df: DataFrame, entity: str, dimensions: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Scores from 1 to 10: a ratio of sums per dimension, scaled and clamped."""
    fields = dict.fromkeys(f for pair in dimensions.values() for f in pair)
    sums = df.groupBy(entity).agg(*(F.sum(f).alias(f"_{f}") for f in fields))

    def score(pair: tuple[str, str]) -> Column:
        r = ratio(f"_{pair[0]}", f"_{pair[1]}")
        return F.when(r.isNotNull(), F.greatest(F.lit(1.0), F.least(F.lit(10.0), 1 + 9 * r)))

    scored = sums.select(entity, *(score(p).alias(n) for n, p in dimensions.items()))
    names = list(dimensions)
    mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
    return scored.withColumn("overall", mean)


def top_by_kind(df: DataFrame, kind: str, score: str, key: str, limits: Mapping[str, int]) -> DataFrame:
    """The highest scores of each kind; Spark cuts every partition down before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(kind).orderBy(F.desc(score), key))
    most = max(limits.values())
    kept = df.where(F.col(kind).isin(*limits)).withColumn("rank", rank).where(F.col("rank") <= most)
    allowed = F.create_map(*(x for k, n in limits.items() for x in (F.lit(k), F.lit(n))))
    return kept.where(F.col("rank") <= F.element_at(allowed, F.col(kind)))
