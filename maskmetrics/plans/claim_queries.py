"""Reports about the driver's customers, and the checks of the numbers they state."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskmetrics.functions.claims import at_precision, format_claim, parse_numbers
from maskmetrics.operators.verification import (
    claim_rows, column_totals, derivable_claims, diff_expected, flatten_results, matched_claims, report_panels,
    rewrite_panel_aliases, run_panels, verification_summary, verify)
from maskmetrics.plans.alias_queries import ALIASES, desk_registry
from maskmetrics.plans.facts import MONEY, flag, table
from maskmetrics.plans.registered import query
from maskmetrics.operators.registry import get_mapping
from maskmetrics.session import scratch_root, settle
from maskmetrics.sources.reports import write_verification

KEY = ["report_id", "panel_no", "statement_no"]


def ticket_sums(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("o_totalprice").cast(MONEY)
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("report_id")).agg(
        F.count("*").alias("n"), F.sum(flag(F.col("o_orderstatus") == "F")).alias("resolved"),
        F.sum(price).alias("value"), F.max(price).alias("largest"))


def reports(spark: SparkSession, d: str) -> DataFrame:
    """One HTML report per customer, with four statements in three markup families.

    Reports whose number is 3 modulo 7 state one ticket too many, those at 1 modulo 5 a
    wrong largest value.
    """
    r, n = F.col("report_id"), F.col("n")
    text = lambda c: c.cast("string")
    stated = n + F.when(r % 7 == 3, 1).otherwise(0)
    largest = F.col("largest") + F.when(r % 5 == 1, F.lit("0.01")).otherwise("0.00").cast(MONEY)
    share = F.round(F.col("resolved").cast("double") * 100 / n, 0).cast("int")
    html = F.concat(
        F.lit("<html><body><h2>Tickets</h2><div class=\"dax-toggle\"><div><span>View DAX Query — Ticket volume</span></div>"
              "<pre><code>EVALUATE ROW(\"n\", FILTER(T, T[name] = \"Client_"), text(r + 27),
        F.lit("\" &amp;&amp; T[age] &gt;= 0))\n-- Result: tickets in 2026 = "), F.format_number(stated, 0), F.lit("; resolved = "), text(F.col("resolved")),
        F.lit(" ("), text(share), F.lit("%); rest = "), text(n - F.col("resolved")),
        F.lit("</code></pre></div><section data-screen-label=\"Value\"><details class=\"dax-proof\"><pre>\n// two statements\n"
              "EVALUATE ROW(\"v\")\n-- Result: value = € "), F.format_number(F.col("value"), 2),
        F.lit("\nDEFINE VAR x = 1\nEVALUATE ROW(\"m\", x)\n-- Resultaat: largest = "), text(largest),
        F.lit(" on 21 Jan 2026\n</pre></details></section><div class=\"dax-query\"><span class=\"dax-title\">Details</span>"
              "<pre>EVALUATE T</pre></div><pre>none</pre></body></html>"))
    return ticket_sums(spark, d).select("report_id", html.alias("html"))


_SUMS = """sums AS (SELECT o_custkey AS report_id, COUNT(*) AS n, SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS resolved,
  SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS value, MAX(CAST(o_totalprice AS DECIMAL(12,2))) AS largest FROM orders GROUP BY 1)"""
_CLAIMS = f"""{_SUMS}, claims AS (
  SELECT report_id, 0 AS panel_no, 0 AS statement_no, 0 AS claim_no, CAST(n + CASE WHEN report_id % 7 = 3 THEN 1 ELSE 0 END AS DOUBLE) AS value, 0 AS decimals, false AS is_percent FROM sums
  UNION ALL SELECT report_id, 0, 0, 1, CAST(resolved AS DOUBLE), 0, false FROM sums
  UNION ALL SELECT report_id, 0, 0, 2, CAST(round(CAST(resolved AS DOUBLE) * 100 / n, 0) AS DOUBLE), 0, true FROM sums
  UNION ALL SELECT report_id, 0, 0, 3, CAST(n - resolved AS DOUBLE), 0, false FROM sums
  UNION ALL SELECT report_id, 1, 0, 0, CAST(value AS DOUBLE), 2, false FROM sums
  UNION ALL SELECT report_id, 1, 1, 0, CAST(largest + CASE WHEN report_id % 5 = 1 THEN 0.01 ELSE 0.00 END AS DOUBLE), 2, false FROM sums)"""


@query(f"""WITH {_SUMS} SELECT report_id, 0 AS panel_no, 0 AS statement_no, 'Ticket volume' AS section, 'dax-toggle' AS family,
    'EVALUATE ROW("n", FILTER(T, T[name] = "Client_' || (report_id + 27) || '" && T[age] >= 0))' AS query FROM sums
  UNION ALL SELECT report_id, 1, 0, 'Value (1/2)', 'dax-proof', '// two statements' || chr(10) || 'EVALUATE ROW("v")' FROM sums
  UNION ALL SELECT report_id, 1, 1, 'Value (2/2)', 'dax-proof', 'DEFINE VAR x = 1' || chr(10) || 'EVALUATE ROW("m", x)' FROM sums
  UNION ALL SELECT report_id, 2, 0, 'Details', 'dax-query', 'EVALUATE T' FROM sums""")
def extracted_panels(spark: SparkSession, d: str) -> DataFrame:
    """Query panels of all reports, one row per statement."""
    return report_panels(reports(spark, d)).drop("expected")


@query(f"WITH {_CLAIMS} SELECT * FROM claims")
def stated_claims(spark: SparkSession, d: str) -> DataFrame:
    """Numbers the reports state; years and dates are none."""
    return claim_rows(report_panels(reports(spark, d)).withColumn("query_id", F.lit("")), KEY).drop("query_id")




@query("""SELECT o_orderkey, unnest([CAST(o_orderkey * 1000 + 7 AS DOUBLE), CAST((o_custkey + 5000) AS DOUBLE) + 0.5, -(o_custkey + 0.25), 3.0]) AS value,
    unnest([0, 2, 2, 0]) AS decimals, unnest([false, false, true, false]) AS is_percent,
    unnest([CAST(o_orderkey * 1000 + 7 AS VARCHAR), CAST(o_custkey + 5000 AS VARCHAR) || '.50', '-' || o_custkey || '.25%', '3']) AS shown
  FROM orders""")
def parsed_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers in running text, in both ways to write thousands and decimals."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    dotted = F.regexp_replace((F.col("o_custkey") + 5000).cast("string"), r"(\d{3})$", ".$1")
    text = F.concat(F.lit("M365 tier P4, Microsoft 365: "), F.format_number(key * 1000 + 7, 0), F.lit(" of € "), dotted,
                    F.lit(",50 in Jan 2026 / 2026-01-21 since 2025: -"), cust, F.lit(".25% +3"))
    rows = table(spark, d, "orders").select("o_orderkey", F.explode(parse_numbers(text)).alias("c"))
    return rows.select("o_orderkey", "c.value", "c.decimals", "c.is_percent",
                       format_claim(F.col("c.value"), F.col("c.decimals"), F.col("c.is_percent")).alias("shown"))


def _query_id(panel: int, statement: int) -> Column:
    return F.concat(F.col("report_id").cast("string"), F.lit(f":{panel}:{statement}"))


def panel_results(spark: SparkSession, d: str) -> DataFrame:
    """What the queries of the reports return, in long form."""
    sums = settle(ticket_sums(spark, d), "sums")
    zero = F.lit(0)
    return (flatten_results(sums, _query_id(0, 0), zero, ["n", "resolved"])
            .unionByName(flatten_results(sums, _query_id(1, 0), zero, ["value"]))
            .unionByName(flatten_results(sums, _query_id(1, 1), zero, ["largest"])))


def panel_errors(spark: SparkSession, d: str) -> DataFrame:
    return ticket_sums(spark, d).where(F.col("report_id") % 11 == 0).select(
        _query_id(2, 0).alias("query_id"), F.lit("table T is gone").alias("message"))


def report_claims(spark: SparkSession, d: str) -> DataFrame:
    query_id = F.concat_ws(":", *(F.col(c).cast("string") for c in KEY))
    return report_panels(reports(spark, d)).withColumn("query_id", query_id)


@query("""SELECT CAST(o_custkey AS VARCHAR) AS query_id, o_orderkey AS row_no, unnest(['price', 'tag', 'gap']) AS col,
    unnest([o_totalprice, CAST(o_orderkey AS DOUBLE) / 2, CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE CAST(o_orderkey AS DOUBLE) END]) AS value FROM orders""")
def flattened_cells(spark: SparkSession, d: str) -> DataFrame:
    """Null counts as 0, numeric text is read, other text and booleans are left out."""
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        "o_custkey", key, F.col("o_totalprice").alias("price"), (key.cast("double") / 2).cast("string").alias("tag"),
        F.when(key % 3 != 0, key).alias("gap"), F.col("o_orderpriority").alias("word"), (key > 5).alias("yes"))
    return flatten_results(rows, "o_custkey", "o_orderkey", ["price", "tag", "gap", "word", "yes"]).drop("col_no")


@query(f"WITH {_SUMS} SELECT query_id, col, total FROM (SELECT report_id || ':0:0' AS query_id, unnest(['n', 'resolved']) AS col, "
       "unnest([CAST(n AS DOUBLE), CAST(resolved AS DOUBLE)]) AS total FROM sums UNION ALL SELECT report_id || ':1:0', 'value', CAST(value AS DOUBLE) "
       "FROM sums UNION ALL SELECT report_id || ':1:1', 'largest', CAST(largest AS DOUBLE) FROM sums)")
def result_column_totals(spark: SparkSession, d: str) -> DataFrame:
    return column_totals(panel_results(spark, d))


_CELLS = ("cells AS (SELECT report_id, 0 AS panel_no, 0 AS statement_no, 'n' AS col, CAST(n AS DOUBLE) AS v FROM sums UNION ALL SELECT report_id, 0, 0, 'resolved', CAST(resolved AS DOUBLE) FROM sums "
          "UNION ALL SELECT report_id, 1, 0, 'value', CAST(value AS DOUBLE) FROM sums UNION ALL SELECT report_id, 1, 1, 'largest', CAST(largest AS DOUBLE) FROM sums)")
# printf rounds the exact binary value, as the engine does.
_MATCH = ("abs(CAST(printf('%.*f', CAST(decimals AS INT), v) AS DOUBLE) - value) < pow(10, -(decimals + 6)) OR (is_percent AND "
          "abs(CAST(printf('%.*f', CAST(decimals AS INT), v * 100) AS DOUBLE) - value) < pow(10, -(decimals + 6)))")
_JUDGED = f"""{_CLAIMS}, {_CELLS}, judged AS (SELECT c.*, EXISTS (SELECT 1 FROM cells r WHERE r.report_id = c.report_id AND r.panel_no = c.panel_no
    AND r.statement_no = c.statement_no AND ({_MATCH})) AS matched,
  EXISTS (SELECT 1 FROM cells a JOIN cells b ON a.report_id = b.report_id AND a.panel_no = b.panel_no AND a.statement_no = b.statement_no
    WHERE a.report_id = c.report_id AND a.panel_no = c.panel_no AND a.statement_no = c.statement_no
    AND abs(CAST(printf('%.*f', CAST(c.decimals AS INT), CASE WHEN a.col = b.col THEN a.v ELSE abs(a.v - b.v) END) AS DOUBLE) - c.value) < pow(10, -(c.decimals + 6))) AS derivable
  FROM claims c)"""


@query(f"WITH {_JUDGED} SELECT report_id, panel_no, statement_no, claim_no, value, decimals, is_percent, matched FROM judged")
def matched_report_claims(spark: SparkSession, d: str) -> DataFrame:
    claims = claim_rows(report_claims(spark, d), KEY)
    return matched_claims(claims, panel_results(spark, d)).drop("query_id")


@query(f"WITH {_JUDGED} SELECT report_id, panel_no, statement_no, claim_no, value, decimals, is_percent FROM judged WHERE NOT matched")
def unmatched_report_claims(spark: SparkSession, d: str) -> DataFrame:
    return diff_expected(claim_rows(report_claims(spark, d), KEY), panel_results(spark, d)).drop("query_id")


@query(f"WITH {_JUDGED} SELECT DISTINCT report_id || ':' || panel_no || ':' || statement_no AS query_id, value, decimals FROM judged WHERE derivable")
def derivable_report_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims that are a column total or the difference of two."""
    claims = claim_rows(report_claims(spark, d), KEY)
    return derivable_claims(claims, column_totals(panel_results(spark, d)))


_VERIFIED = f"""{_JUDGED}, panels AS (SELECT report_id, unnest([0, 1, 1, 2]) AS panel_no, unnest([0, 0, 1, 0]) AS statement_no FROM sums),
  counted AS (SELECT report_id, panel_no, statement_no, SUM(CASE WHEN matched THEN 1 ELSE 0 END) AS checked,
    SUM(CASE WHEN NOT matched AND NOT is_percent AND NOT derivable THEN 1 ELSE 0 END) AS missing,
    SUM(CASE WHEN NOT matched AND (is_percent OR derivable) THEN 1 ELSE 0 END) AS n_derived FROM judged GROUP BY 1, 2, 3),
  verified AS (SELECT report_id, panel_no, statement_no,
    CASE WHEN panel_no = 2 AND report_id % 11 = 0 THEN 'ERROR' WHEN missing > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
    CASE WHEN panel_no = 2 AND report_id % 11 = 0 THEN NULL WHEN checked IS NULL THEN false WHEN missing > 0 THEN true ELSE checked > 0 END AS value_checked,
    CASE WHEN panel_no = 2 AND report_id % 11 = 0 THEN NULL ELSE COALESCE(n_derived, 0) END AS n_derived
    FROM panels LEFT JOIN counted USING (report_id, panel_no, statement_no))"""


@query(f"WITH {_VERIFIED} SELECT * FROM verified")
def verified_reports(spark: SparkSession, d: str) -> DataFrame:
    """PASS, FAIL or ERROR for every statement of every report."""
    done = verify(report_claims(spark, d), panel_results(spark, d), panel_errors(spark, d), KEY)
    return done.select(*KEY, "status", "value_checked", F.when(F.col("derived").isNotNull(), F.size("derived")).alias("n_derived"))


@query(f"WITH {_VERIFIED} SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) FILTER (WHERE value_checked) AS value_checked, "
       "COUNT(*) FILTER (WHERE status = 'PASS' AND NOT value_checked) AS execute_only, COUNT(*) FILTER (WHERE status <> 'PASS') AS failed FROM verified")
def verification_totals(spark: SparkSession, d: str) -> DataFrame:
    return verification_summary(verify(report_claims(spark, d), panel_results(spark, d), panel_errors(spark, d), KEY))


@query(f"""WITH {ALIASES}, {_SUMS} SELECT report_id, 0 AS panel_no, 0 AS statement_no, 'EVALUATE ROW("n", FILTER(T, T[name] = "' || COALESCE(value_of.value, 'Client_' || (report_id + 27))
    || '" && T[age] >= 0))' AS query, CASE WHEN value_of.value IS NULL THEN 0 ELSE 1 END AS aliases_rewritten
  FROM sums LEFT JOIN clients value_of ON value_of.alias = 'Client_' || (report_id + 27)
  UNION ALL SELECT report_id, 1, 0, '// two statements' || chr(10) || 'EVALUATE ROW("v")', 0 FROM sums
  UNION ALL SELECT report_id, 1, 1, 'DEFINE VAR x = 1' || chr(10) || 'EVALUATE ROW("m", x)', 0 FROM sums
  UNION ALL SELECT report_id, 2, 0, 'EVALUATE T', 0 FROM sums""")
def panels_with_real_names(spark: SparkSession, d: str) -> DataFrame:
    """Alias literals of panel queries are rewritten before the queries run."""
    panels = report_panels(reports(spark, d))
    return rewrite_panel_aliases(panels, get_mapping(desk_registry(spark, d))).select(
        "report_id", "panel_no", "statement_no", "query", "aliases_rewritten")


@query("SELECT 'orders by status' AS query_id, 'n' AS col, CAST(COUNT(*) AS DOUBLE) AS value FROM orders GROUP BY o_orderstatus "
       "UNION ALL SELECT 'largest part', 'size', CAST(MAX(p_size) AS DOUBLE) FROM part")
def named_query_results(spark: SparkSession, d: str) -> DataFrame:
    """Named queries run once each; the one that fails leaves an error row instead."""
    results, _ = run_panels(spark, {
        "orders by status": lambda s: table(s, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")),
        "largest part": lambda s: table(s, d, "part").agg(F.max("p_size").alias("size")),
        "broken": lambda s: table(s, d, "part").select("no_such_column")})
    return results.select("query_id", "col", "value")


@query(f"WITH {_VERIFIED} SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE status = 'PASS') AS passed, "
       "COUNT(*) FILTER (WHERE status <> 'PASS') AS failed FROM verified")
def written_verification(spark: SparkSession, d: str) -> DataFrame:
    """Verification results as JSON files, and their totals read back."""
    run = f"{scratch_root(spark)}/maskmetrics/verification-{uuid.uuid4().hex}"
    write_verification(verify(report_claims(spark, d), panel_results(spark, d), panel_errors(spark, d), KEY), run)
    return spark.read.schema("total long, passed long, failed long").json(f"{run}/totals")


_SPACED = f"""{_SUMS} SELECT report_id, 0 AS claim_no, -CAST(value AS DOUBLE) AS value, 2 AS decimals, false AS is_percent FROM sums
  UNION ALL SELECT report_id, 1, CAST(resolved AS DOUBLE), 0, true FROM sums UNION ALL SELECT report_id, 2, CAST(n AS DOUBLE), 0, false FROM sums"""


@query(f"WITH {_SPACED}")
def parsed_numbers_with_fixed_spaces(spark: SparkSession, d: str) -> DataFrame:
    """No-break spaces in amounts, before signs of per cent and in dates."""
    space = "\u00a0"
    text = F.concat(F.lit(f"-€{space}"), F.format_number("value", 2), F.lit(" and "), F.col("resolved").cast("string"),
                    F.lit(f"{space}% on 21{space}Jan{space}2026; "), F.col("n").cast("string"))
    found = ticket_sums(spark, d).select("report_id", F.posexplode(parse_numbers(text)).alias("claim_no", "c"))
    return found.select("report_id", "claim_no", "c.value", "c.decimals", "c.is_percent")


_TIES = ("SELECT p_partkey, CAST(printf('%.2f', p_partkey / 8.0) AS DOUBLE) AS eighths, "
         "CAST(printf('%.2f', CAST(p_partkey + 0.005 AS DOUBLE)) AS DOUBLE) AS halves FROM part")


@query(_TIES)
def values_at_shown_precision(spark: SparkSession, d: str) -> DataFrame:
    """Binary values near and at a half, rounded as their exact value asks."""
    key = F.col("p_partkey").cast("double")
    two = F.lit(2)
    return table(spark, d, "part").select("p_partkey", (at_precision(key / 8, two) / 100).alias("eighths"),
                                          (at_precision(key + 0.005, two) / 100).alias("halves"))
