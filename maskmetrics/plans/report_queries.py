"""Project and quarterly report datasets on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskmetrics.operators import projects as p
from maskmetrics.operators.shapes import scaled_to_largest
from maskmetrics.plans import facts
from maskmetrics.plans.fact_sql import COMPANY_TIME, ENDPOINTS, PROJECT_TIME, RESOURCE_TIME, TICKETS
from maskmetrics.plans.registered import query

TODAY = "2002-01-01"


def today():
    return F.lit(TODAY).cast("date")


def _d(sql: str) -> str:
    return f"CAST({sql} AS DOUBLE)"


@query(f"WITH {PROJECT_TIME} SELECT project, SUM(milestones_done) AS completed, COUNT(*) AS tasks, "
       "CAST(SUM(milestones_done) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS pct FROM project_time GROUP BY 1")
def project_progress(spark: SparkSession, d: str) -> DataFrame:
    return p.progress(facts.project_entries(spark, d), "project", F.col("milestones_done") == 1)


@query(f"WITH {PROJECT_TIME} SELECT project, CAST(SUM(actual_hrs) AS DOUBLE) AS used, "
       "CAST(SUM(budget_hrs) AS DOUBLE) AS budget, CAST(SUM(actual_hrs) AS DOUBLE) / "
       "NULLIF(CAST(SUM(budget_hrs) AS DOUBLE), 0) AS budget_share, "
       f"date_diff('day', CAST(MIN(ts) AS DATE), DATE '{TODAY}') AS days_elapsed FROM project_time GROUP BY 1")
def project_budget_use(spark: SparkSession, d: str) -> DataFrame:
    return p.budget_use(facts.project_entries(spark, d), "project", "actual_hrs", "budget_hrs", "ts", today())


_PHASES = f"""WITH {PROJECT_TIME}, phases AS (
  SELECT CASE WHEN GROUPING(phase) = 1 THEN 'Total' ELSE phase END AS phase, GROUPING(phase) = 1 AS is_total,
    CAST(SUM(budget_hrs) AS DOUBLE) AS budget, CAST(SUM(actual_hrs) AS DOUBLE) AS spent,
    CAST(SUM(budget_hrs) - SUM(actual_hrs) AS DOUBLE) AS remaining,
    CAST(SUM(actual_hrs) AS DOUBLE) / NULLIF(CAST(SUM(budget_hrs) AS DOUBLE), 0) * 100 AS pct_used
  FROM project_time GROUP BY ROLLUP (phase)) """


@query(_PHASES + "SELECT * FROM phases")
def project_phase_summary(spark: SparkSession, d: str) -> DataFrame:
    return p.phase_summary(facts.project_entries(spark, d), "phase", "actual_hrs", "budget_hrs")


@query(_PHASES + "SELECT *, CASE WHEN pct_used > 101 THEN 'over' WHEN pct_used >= 99.5 THEN 'warn' "
       "WHEN pct_used IS NOT NULL THEN 'ok' END AS status FROM phases")
def project_budget_status(spark: SparkSession, d: str) -> DataFrame:
    return p.budget_status(project_phase_summary(spark, d), warn=99.5, over=101.0)


@query(f"WITH {PROJECT_TIME}, s AS (SELECT project, phase, CAST(MIN(ts) AS DATE) AS b, CAST(MAX(ts) AS DATE) AS e "
       "FROM project_time GROUP BY 1, 2) SELECT project, phase, "
       "date_diff('day', MIN(b) OVER (PARTITION BY project), b) AS start_day, date_diff('day', b, e) + 1 AS duration_days, "
       "date_diff('day', MIN(b) OVER (PARTITION BY project), MAX(e) OVER (PARTITION BY project)) + 1 AS total_days FROM s")
def project_gantt(spark: SparkSession, d: str) -> DataFrame:
    return p.gantt(facts.project_entries(spark, d), "project", "phase", "ts", "ts")


_FINANCE = (f"SELECT project, {_d('SUM(rev)')} AS revenue, {_d('SUM(cost)')} AS cost, "
            f"{_d('SUM(rev) - SUM(cost)')} AS profit, "
            f"{_d('SUM(rev) - SUM(cost)')} / NULLIF({_d('SUM(rev)')}, 0) * 100 AS margin_pct "
            "FROM (SELECT *, rev - profit AS cost FROM project_time) GROUP BY 1")


@query(f"WITH {PROJECT_TIME} SELECT *, CASE WHEN margin_pct > 40 THEN 'high' WHEN margin_pct >= 25 THEN 'medium' "
       f"WHEN margin_pct IS NOT NULL THEN 'low' END AS band FROM ({_FINANCE})")
def project_finances(spark: SparkSession, d: str) -> DataFrame:
    entries = facts.project_entries(spark, d).withColumn("cost", F.col("rev") - F.col("profit"))
    return p.financial_overview(entries, "project", "rev", "cost")


@query(f"WITH {PROJECT_TIME} SELECT project, {_d('SUM(budget_hrs)')} AS budgeted, {_d('SUM(actual_hrs)')} AS actual, "
       f"{_d('SUM(actual_hrs) - SUM(budget_hrs)')} AS variance, "
       f"{_d('SUM(budget_hrs)')} / NULLIF({_d('SUM(actual_hrs)')}, 0) * 100 AS efficiency_pct "
       "FROM project_time GROUP BY 1")
def project_budget_analysis(spark: SparkSession, d: str) -> DataFrame:
    return p.budget_analysis(facts.project_entries(spark, d), "project", "budget_hrs", "actual_hrs")


@query(f"WITH {PROJECT_TIME}, x AS (SELECT project, {_d('SUM(milestones_done)')} / COUNT(*) * 100 AS open_pct, "
       f"{_d('SUM(actual_hrs)')} / NULLIF({_d('SUM(budget_hrs)')}, 0) * 100 AS used_pct, "
       f"{_d('SUM(profit)')} / NULLIF({_d('SUM(rev)')}, 0) * 100 AS margin_pct FROM project_time GROUP BY 1) "
       "SELECT *, CASE WHEN open_pct > 50.5 THEN 'red' WHEN open_pct >= 49.5 THEN 'amber' ELSE 'green' END AS schedule_light, "
       "CASE WHEN used_pct > 105 THEN 'red' WHEN used_pct >= 98 THEN 'amber' ELSE 'green' END AS budget_light, "
       "CASE WHEN margin_pct < 26.2 THEN 'red' WHEN margin_pct < 26.4 THEN 'amber' ELSE 'green' END AS margin_light FROM x")
def project_traffic_lights(spark: SparkSession, d: str) -> DataFrame:
    sums = facts.project_entries(spark, d).groupBy("project").agg(
        *(F.sum(c).alias(c) for c in ("milestones_done", "actual_hrs", "budget_hrs", "profit", "rev")),
        F.count("*").alias("n"))
    use = sums.select("project", (p.ratio("milestones_done", "n") * 100).alias("open_pct"),
                      (p.ratio("actual_hrs", "budget_hrs") * 100).alias("used_pct"),
                      (p.ratio("profit", "rev") * 100).alias("margin_pct"))
    return p.traffic_lights(use, F.col("open_pct"), F.col("used_pct"), F.col("margin_pct"),
                            {"schedule": (49.5, 50.5), "budget": (98.0, 105.0), "margin": (26.2, 26.4)})


@query(f"WITH {RESOURCE_TIME} SELECT resource_id, {_d('SUM(hrs)')} AS hours, "
       f"{_d('SUM(hrs) * CAST(85.50 AS DECIMAL(6,2))')} AS est_cost, "
       f"{_d('SUM(hrs)')} / (SELECT {_d('SUM(hrs)')} FROM resource_time) * 100 AS pct_of_total "
       "FROM resource_time GROUP BY 1")
def resource_hour_shares(spark: SparkSession, d: str) -> DataFrame:
    return p.resource_shares(facts.time_entries(spark, d), "resource_id", "hrs", "85.50")


@query(f"WITH {PROJECT_TIME} SELECT resource_id, CAST(SUM(CASE WHEN ts >= TIMESTAMP '1998-01-01' AND "
       "ts < TIMESTAMP '1999-01-01' THEN hrs ELSE 0 END) AS DOUBLE) AS this_period, CAST(SUM(hrs) AS DOUBLE) AS total, "
       "CAST(SUM(budget_hrs) AS DOUBLE) AS budget, CAST(SUM(budget_hrs) - SUM(hrs) AS DOUBLE) AS available "
       "FROM project_time GROUP BY 1")
def resource_period_overview(spark: SparkSession, d: str) -> DataFrame:
    return p.resource_overview(facts.project_entries(spark, d), "resource_id", "hrs", "budget_hrs", "ts",
                               "1998-01-01", "1999-01-01")


@query(f"WITH {PROJECT_TIME} SELECT order_id, part_id, project, ts, kind FROM project_time "
       "WHERE line_status = 'F' AND kind = 'A'")
def completed_tasks(spark: SparkSession, d: str) -> DataFrame:
    return facts.project_entries(spark, d).where("line_status = 'F' AND kind = 'A'") \
        .select("order_id", "part_id", "project", "ts", "kind")


@query(f"WITH {PROJECT_TIME} SELECT order_id, part_id, project, ts, kind FROM project_time "
       "WHERE line_status = 'O' AND ts >= TIMESTAMP '2001-01-01'")
def planned_tasks(spark: SparkSession, d: str) -> DataFrame:
    return facts.project_entries(spark, d).where("line_status = 'O'") \
        .where(F.col("ts") >= F.lit("2001-01-01").cast("timestamp_ntz")) \
        .select("order_id", "part_id", "project", "ts", "kind")


@query(f"WITH {COMPANY_TIME}, a AS (SELECT o_custkey AS company_id, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS v "
       "FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), "
       "b AS (SELECT company_id, SUM(rev) AS v FROM company_time WHERE line_status = 'F' GROUP BY 1) "
       "SELECT COALESCE(a.company_id, b.company_id) AS company_id, CAST(a.v AS DOUBLE) AS orders, "
       "CAST(b.v AS DOUBLE) AS time_entries, CAST(COALESCE(a.v, 0) - COALESCE(b.v, 0) AS DOUBLE) AS difference "
       "FROM a FULL JOIN b ON a.company_id = b.company_id")
def revenue_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    booked = facts.tickets(spark, d).where("overdue = 0").groupBy("company_id").agg(F.sum("price").alias("v"))
    worked = facts.company_time_entries(spark, d).where("line_status = 'F'").groupBy("company_id") \
        .agg(F.sum("rev").alias("v"))
    return p.reconcile(booked, worked, "company_id", "v", ("orders", "time_entries"))


@query(f"WITH {PROJECT_TIME} SELECT project FROM ({_FINANCE})")
def client_project_report(spark: SparkSession, d: str) -> DataFrame:
    """The client version: no revenue, cost, profit or margin; Spark prunes their columns."""
    return p.for_audience(project_finances(spark, d), "client",
                          ["revenue", "cost", "profit", "margin_pct", "band"])


@query("SELECT o_orderkey AS ticket_id, o_custkey AS company_id, o_orderpriority AS queue FROM orders "
       "WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE contains(lower(c_name), lower('CUSTOMER#00000012')))")
def tickets_of_looked_up_customers(spark: SparkSession, d: str) -> DataFrame:
    return p.lookup_customer(facts.tickets(spark, d).select("ticket_id", "company_id", "queue"),
                             facts.companies(spark, d), "company", "company_id", "CUSTOMER#00000012")


@query(f"WITH {TICKETS}, q AS (SELECT queue, CAST(date_trunc('quarter', ts) AS DATE) AS quarter, COUNT(*) AS tickets, "
       "CAST(SUM(res_met) AS DOUBLE) / COUNT(*) AS sla FROM tickets GROUP BY 1, 2) "
       "SELECT q.*, b.tickets AS prior_tickets, b.sla AS prior_sla FROM q LEFT JOIN q b ON b.queue = q.queue "
       "AND b.quarter = CAST(q.quarter - INTERVAL 3 MONTH AS DATE)")
def quarter_against_prior(spark: SparkSession, d: str) -> DataFrame:
    return p.quarter_over_quarter(facts.tickets(spark, d), "queue", "ts", tickets=F.count("*"),
                                  sla=p.ratio(F.sum("res_met"), F.count("*")))


@query(f"WITH {PROJECT_TIME}, s AS (SELECT project, phase, CAST(SUM(hrs) AS DOUBLE) AS hours FROM project_time "
       "GROUP BY 1, 2) SELECT *, hours * 100 / MAX(hours) OVER (PARTITION BY project) AS width FROM s")
def phase_bar_widths(spark: SparkSession, d: str) -> DataFrame:
    sums = facts.project_entries(spark, d).groupBy("project", "phase").agg(F.sum("hrs").cast("double").alias("hours"))
    return scaled_to_largest(sums, "project", "hours")


@query(f"WITH {ENDPOINTS} SELECT state, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM endpoints) "
       "AS share FROM endpoints GROUP BY 1")
def patch_state_shares(spark: SparkSession, d: str) -> DataFrame:
    return p.shares(facts.endpoints(spark, d), "state")


@query(f"SELECT CASE WHEN age < 365 THEN 'under 1 year' WHEN age < 1095 THEN '1-3 years' WHEN age < 1825 THEN '3-5 years' "
       "ELSE 'older' END AS band, COUNT(*) AS n, MIN(age) AS youngest_days, MAX(age) AS oldest_days FROM "
       f"(SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '{TODAY}') AS age FROM orders) GROUP BY 1")
def contract_age_bands(spark: SparkSession, d: str) -> DataFrame:
    return p.age_bands(facts.tickets(spark, d), "ts", today(),
                       [("under 1 year", 365), ("1-3 years", 1095), ("3-5 years", 1825)], "older")


@query(f"WITH {TICKETS}, s AS (SELECT company_id, SUM(t_total) AS n, SUM(fr_met) AS f, SUM(res_met) AS r, "
       "SUM(overdue) AS o FROM tickets GROUP BY 1), x AS (SELECT company_id, "
       "GREATEST(1.0, LEAST(10.0, 1 + 9 * CAST(f AS DOUBLE) / n)) AS response, "
       "GREATEST(1.0, LEAST(10.0, 1 + 9 * CAST(r AS DOUBLE) / n)) AS resolution, "
       "GREATEST(1.0, LEAST(10.0, 1 + 9 * CAST(r AS DOUBLE) / NULLIF(o, 0))) AS backlog FROM s) "
       "SELECT company_id, response, resolution, CASE WHEN backlog_known THEN backlog END AS backlog, "
       "CASE WHEN backlog_known THEN (response + resolution + backlog) / 3 END AS overall FROM "
       "(SELECT x.*, s.o > 0 AS backlog_known FROM x JOIN s USING (company_id))")
def company_maturity(spark: SparkSession, d: str) -> DataFrame:
    return p.maturity(facts.tickets(spark, d), "company_id", {
        "response": ("fr_met", "t_total"), "resolution": ("res_met", "t_total"), "backlog": ("res_met", "overdue")})


@query(f"WITH {TICKETS}, s AS (SELECT company_id, SUM(overdue) AS o, SUM(res_met) AS r FROM tickets GROUP BY 1), "
       "k AS (SELECT 'risk' AS kind, company_id, o AS score FROM s UNION ALL SELECT 'opportunity', company_id, r FROM s) "
       "SELECT kind, company_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY score DESC, "
       "company_id) AS rank FROM k) WHERE rank <= CASE kind WHEN 'risk' THEN 4 ELSE 3 END")
def top_risks_and_opportunities(spark: SparkSession, d: str) -> DataFrame:
    sums = facts.tickets(spark, d).groupBy("company_id").agg(F.sum("overdue").alias("risk"),
                                                             F.sum("res_met").alias("opportunity"))
    kinds = sums.unpivot("company_id", ["risk", "opportunity"], "kind", "score")
    return p.top_by_kind(kinds, "kind", "score", "company_id", {"risk": 4, "opportunity": 3})
