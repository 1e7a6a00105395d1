"""KPIs, gauges, series and tables of the eight dashboards on the driver tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskmetrics.operators.distinct import SketchStore, distinct_over, distinct_sketches, error_bound
from maskmetrics.operators.metrics import (
    apply_filters, breakdown, formatted, gauges, kpis, masked_table, metric_parts, monthly, ranked_table,
    ranking, slug, summary, trend)
from maskmetrics.operators.registry import SensitiveColumn, build_registry
from maskmetrics.plans import fact_sql, facts
from maskmetrics.plans.dashboards import DASHBOARDS
from maskmetrics.plans.registered import query
from maskmetrics.session import scratch_root
from maskmetrics.sources.dashboard_spec import read_dashboard_spec


@dataclass(frozen=True)
class Source:
    """Where a dashboard gets its rows: the fact, its key and the names of the keys."""

    fact: Callable[[SparkSession, str], DataFrame]
    key: str
    cte: str
    relation: str
    keyed_fact: Callable[[SparkSession, str], DataFrame] | None = None
    names: Callable[[SparkSession, str], DataFrame] | None = None
    name: str | None = None


SOURCES = {
    "satisfaction": Source(facts.surveys, "contact", fact_sql.SURVEYS, "surveys"),
    "endpoint_health": Source(facts.devices, "contact", fact_sql.DEVICES, "devices"),
    "patch_compliance": Source(facts.endpoints, "brand", fact_sql.ENDPOINTS, "endpoints"),
    "project_performance": Source(facts.project_entries, "project", fact_sql.PROJECT_TIME, "project_time"),
    "resource_utilization": Source(facts.time_entries, "resource_id", fact_sql.RESOURCE_TIME,
                                   "resource_time", names=facts.resources, name="resource"),
    "revenue_billing": Source(facts.time_entries, "company_id", fact_sql.COMPANY_TIME, "company_time",
                              keyed_fact=facts.company_time_entries, names=facts.companies, name="company"),
    "sla_performance": Source(facts.tickets, "company_id", fact_sql.TICKETS, "tickets",
                              names=facts.companies, name="company"),
    "ticket_volume": Source(facts.tickets, "company_id", fact_sql.TICKETS, "tickets",
                            names=facts.companies, name="company"),
}


def _sql_value(metric: str) -> str:
    _, *fields = metric_parts(metric)
    sums = [f"CAST(SUM({f}) AS DOUBLE)" for f in fields]
    return sums[0] if len(sums) == 1 else f"{sums[0]} / NULLIF({sums[1]}, 0)"


def _kpi_sql(board, source: Source) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{k.label}' AS label, '{k.metric}' AS metric, {_sql_value(k.metric)} AS value, "
        f"'{k.format}' AS format FROM {source.relation}" for k in board.kpis)
    return f"WITH {source.cte} {rows}"


def _gauge_sql(board, source: Source) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{g.label}' AS label, {_sql_value(g.metric)} AS value, "
        f"CAST({'NULL' if g.target is None else g.target} AS DOUBLE) AS target, "
        f"CAST({g.max} AS DOUBLE) AS max FROM {source.relation}" for g in board.gauges)
    return (f"WITH {source.cte} SELECT label, value, target, max, value >= target AS on_target, "
            f"LEAST(value / NULLIF(max, 0), 1.0) AS fill FROM ({rows})")


def _series_sql(series, source: Source) -> str:
    columns = ", ".join(f"{_sql_value(s.metric)} AS {slug(s.label)}" for s in series)
    return (f"WITH {source.cte} SELECT CAST(date_trunc('month', ts) AS DATE) AS month, {columns} "
            f"FROM {source.relation} GROUP BY 1")


def _table_sql(board, source: Source) -> str:
    name = source.name or source.key
    columns = ", ".join(f"{_sql_value(c.metric)} AS {slug(c.label)}" for c in board.columns)
    return (f"WITH {source.cte} SELECT row_number() OVER (ORDER BY sort_value DESC, name) AS rank, "
            f"* EXCLUDE (sort_value) FROM (SELECT {name} AS name, {columns}, SUM({board.sort}) AS sort_value "
            f"FROM {source.relation} GROUP BY 1 ORDER BY sort_value DESC, name LIMIT {board.limit})")


def board_table(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    source = SOURCES[key]
    fact = (source.keyed_fact or source.fact)(spark, sf_dir)
    names = source.names(spark, sf_dir) if source.names else None
    return ranked_table(fact, DASHBOARDS[key], source.key, names, source.name)


def _register(key: str) -> None:
    board, source = DASHBOARDS[key], SOURCES[key]
    query(_kpi_sql(board, source), f"{key}_kpis")(lambda s, d: kpis(source.fact(s, d), board))
    if board.gauges:
        query(_gauge_sql(board, source), f"{key}_gauges")(lambda s, d: gauges(source.fact(s, d), board))
    for i, (title, series) in enumerate(board.charts.items()):
        suffix = "_series" if i == 0 else f"_series_{slug(title).split('_')[0]}"
        query(_series_sql(series, source), key + suffix)(
            lambda s, d, series=series: monthly(source.fact(s, d), series))
    query(_table_sql(board, source), f"{key}_table")(lambda s, d: board_table(s, d, key))


for _key in DASHBOARDS:
    _register(_key)

_CLIENT_ALIASES = """aliases AS (
  SELECT norm, CASE WHEN rn <= 26 THEN 'Client_' || chr(CAST(64 + rn AS INTEGER)) ELSE 'Client_' || rn END AS alias
  FROM (SELECT norm, row_number() OVER (ORDER BY norm) AS rn
        FROM (SELECT DISTINCT lower(trim(c_name)) AS norm FROM customer WHERE trim(c_name) <> '')))"""

_revenue_table = _table_sql(DASHBOARDS["revenue_billing"], SOURCES["revenue_billing"])


@query(f"WITH {_CLIENT_ALIASES}, top AS ({_revenue_table}) "
       "SELECT rank, alias AS name, revenue, hours, avg_rate, margin "
       "FROM top JOIN aliases ON norm = lower(trim(name))")
def revenue_by_client_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: revenue by client, with the clients as aliases."""
    customers = facts.table(spark, sf_dir, "customer")
    registry = build_registry(spark, [SensitiveColumn("client", "customer", "c_name")],
                              {"customer": customers})
    return masked_table(board_table(spark, sf_dir, "revenue_billing"), registry)


@query(f"WITH {fact_sql.TICKETS} SELECT CAST(SUM(t_total) AS DOUBLE) AS tickets, "
       "CAST(SUM(res_met) AS DOUBLE) / NULLIF(CAST(SUM(t_total) AS DOUBLE), 0) AS resolution_sla FROM tickets "
       "WHERE queue = '1-URGENT' AND ts >= TIMESTAMP '1997-01-01' AND ts < TIMESTAMP '1998-01-01'")
def filtered_ticket_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue and period filters before the aggregation; both reach the scan."""
    fact = apply_filters(facts.tickets(spark, sf_dir), {"queue": "1-URGENT"},
                         start="1997-01-01", end="1998-01-01")
    return summary(fact, {"tickets": "sum:t_total", "resolution_sla": "ratio:res_met:t_total"})


@query(f"WITH {fact_sql.TIME_ENTRIES} SELECT label, value, format, CASE format "
       "WHEN 'eur' THEN '€ ' || format('{:,}', CAST(round(value) AS BIGINT)) "
       "WHEN 'hrs' THEN format('{:,.1f}', value) || ' h' "
       "WHEN 'pct' THEN format('{:,.1f}', value * 100) || '%' END AS shown FROM ("
       + " UNION ALL ".join(
           f"SELECT '{k.label}' AS label, {_sql_value(k.metric)} AS value, '{k.format}' AS format FROM time_entries"
           for k in DASHBOARDS["revenue_billing"].kpis) + ")")
def formatted_revenue_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display texts beside the numbers."""
    return formatted(kpis(facts.time_entries(spark, sf_dir), DASHBOARDS["revenue_billing"])) \
        .select("label", "value", "format", "shown")


@query(f"WITH {fact_sql.TIME_ENTRIES} SELECT kind, CAST(SUM(rev) AS DOUBLE) AS revenue, "
       "CAST(SUM(rev) AS DOUBLE) / NULLIF(CAST(SUM(hrs) AS DOUBLE), 0) AS rate FROM time_entries GROUP BY 1")
def report_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breakdown(facts.time_entries(spark, sf_dir), "kind",
                     {"revenue": "sum:rev", "rate": "ratio:rev:hrs"})


@query(f"WITH {fact_sql.TICKETS} SELECT CAST(date_trunc('quarter', ts) AS DATE) AS period, "
       "CAST(SUM(t_cr) AS DOUBLE) AS created, CAST(SUM(res_met) AS DOUBLE) / "
       "NULLIF(CAST(SUM(t_total) AS DOUBLE), 0) AS sla FROM tickets GROUP BY 1")
def report_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend(facts.tickets(spark, sf_dir), "quarter",
                 {"created": "sum:t_cr", "sla": "ratio:res_met:t_total"})


@query(f"WITH {fact_sql.PROJECT_TIME} SELECT row_number() OVER (ORDER BY value DESC, project) AS rank, "
       "project, value FROM (SELECT project, CAST(SUM(rev) AS DOUBLE) AS value FROM project_time GROUP BY 1 "
       "ORDER BY value DESC, project LIMIT 10)")
def report_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking(facts.project_entries(spark, sf_dir), "project", "sum:rev", 10)


@query(f"WITH {fact_sql.SURVEYS} SELECT CAST(SUM(t_total) AS DOUBLE) AS surveys, "
       "CAST(SUM(csat_sum) AS DOUBLE) / NULLIF(CAST(SUM(csat_n) AS DOUBLE), 0) AS score FROM surveys")
def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(facts.surveys(spark, sf_dir),
                   {"surveys": "sum:t_total", "score": "wavg:csat_sum:csat_n"})


def _described(key: str) -> str:
    """A dashboard as its JSON description."""
    board = DASHBOARDS[key]
    columns = [{"label": "#", "type": "rank"}, {"label": "Name", "type": "name"}]
    for c in board.columns:
        kind, *fields = metric_parts(c.metric)
        columns.append({"label": c.label, "format": c.format, **({"field": fields[0]} if kind == "sum" else {"type": "derived", "calc": "/".join(fields)})})
    return json.dumps({
        "title": board.title, "kpi_rows": [[{"label": k.label, "metric": k.metric, "format": k.format}] for k in board.kpis],
        "table": {"columns": columns, "sort": board.sort, "limit": board.limit}})


@query(_table_sql(DASHBOARDS["sla_performance"], SOURCES["sla_performance"]))
def described_dashboard_table(spark: SparkSession, d: str) -> DataFrame:
    """The ranked table of a dashboard that is read from its description, a file in the shared folder."""
    path = f"{scratch_root(spark)}/maskmetrics/dashboard-{uuid.uuid4().hex}"
    spark.createDataFrame([(_described("sla_performance"),)], "value string").coalesce(1).write.text(path)
    source = SOURCES["sla_performance"]
    return ranked_table(source.fact(spark, d), read_dashboard_spec(path, spark), source.key, source.names(spark, d), source.name)


@query("SELECT EXTRACT(year FROM o_orderdate) AS year, EXTRACT(quarter FROM o_orderdate) AS quarter, o_orderpriority, COUNT(DISTINCT o_custkey) AS companies, "
       "true AS within_bound FROM orders GROUP BY 1, 2, 3")
def kept_distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    """Companies per quarter and priority from the sketches kept per month, within the error bound of the exact counts."""
    orders = facts.table(spark, d, "orders")
    store = SketchStore(spark, f"{scratch_root(spark)}/maskmetrics/sketches-{uuid.uuid4().hex}", "month")
    store.save(distinct_sketches(orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM")), ["month", "o_orderpriority"], "o_custkey"))
    month = F.to_date(F.concat(F.col("month"), F.lit("-01")))
    kept = distinct_over(store.load(), [F.year(month).alias("year"), F.quarter(month).alias("quarter"), "o_orderpriority"], "about")
    exact = orders.groupBy(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), "o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("companies"))
    # Small counts are exact but for rounding.
    within = F.abs(F.col("about") - F.col("companies")) <= F.greatest(F.lit(1.0), error_bound() * F.col("companies"))
    return exact.join(kept, ["year", "quarter", "o_orderpriority"]).select("year", "quarter", "o_orderpriority", "companies", within.alias("within_bound"))
