"""The query constructs an analyst sends through, as DataFrame code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskmetrics.functions.text import contains_ci
from maskmetrics.operators.shapes import (
    joined_values, ranked_within, running_to_here, same_period_last_year, selected_value, share_of_group,
    top_n, year_to_date)
from maskmetrics.plans import facts
from maskmetrics.plans.fact_sql import PROJECT_TIME, TICKETS, TIME_ENTRIES
from maskmetrics.plans.registered import query
from maskmetrics.plans.facts import MONEY, table


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_size >= 10 AND p_size < 20 AND p_type = 'ECONOMY'")
def filtered_rows(spark: SparkSession, d: str) -> DataFrame:
    """Filter and select columns; both reach the scan."""
    return table(spark, d, "part").where("p_size >= 10 AND p_size < 20 AND p_type = 'ECONOMY'") \
        .select("p_partkey", "p_name", "p_brand")


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * "
       "(1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net FROM lineitem WHERE l_returnflag IN ('A', 'N') "
       "AND (l_quantity >= 45 OR l_tax > 0.07)")
def selected_columns(spark: SparkSession, d: str) -> DataFrame:
    """Membership, and, or, comparisons and a computed column."""
    rows = table(spark, d, "lineitem").where(
        F.col("l_returnflag").isin("A", "N") & ((F.col("l_quantity") >= 45) | (F.col("l_tax") > 0.07)))
    return rows.select("l_orderkey", "l_linenumber", facts.revenue().cast("double").alias("net"))


@query(f"WITH {TIME_ENTRIES} SELECT kind, line_status, CAST(SUM(rev) AS DOUBLE) AS revenue, COUNT(*) AS n "
       "FROM time_entries GROUP BY 1, 2")
def grouped_measures(spark: SparkSession, d: str) -> DataFrame:
    return facts.time_entries(spark, d).groupBy("kind", "line_status").agg(
        F.sum("rev").cast("double").alias("revenue"), F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_orders(spark: SparkSession, d: str) -> DataFrame:
    return top_n(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 25, "o_totalprice", "o_orderkey")


@query("SELECT p_partkey, p_size FROM (SELECT p_partkey, p_size, rank() OVER (ORDER BY p_size DESC) AS r FROM part) "
       "WHERE r <= 10")
def top_sizes_with_ties(spark: SparkSession, d: str) -> DataFrame:
    return top_n(table(spark, d, "part").select("p_partkey", "p_size"), 10, "p_size", "p_partkey", ties=True)


@query("SELECT COUNT(*) AS orders, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS resolved, "
       "CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) END) AS DOUBLE) AS open_value "
       "FROM orders WHERE o_orderpriority = '2-HIGH'")
def measures_under_conditions(spark: SparkSession, d: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, d, "orders").where("o_orderpriority = '2-HIGH'").agg(
        F.count("*").alias("orders"), F.count_if(status == "F").alias("resolved"),
        F.sum(F.when(status == "O", F.col("o_totalprice").cast(MONEY))).cast("double").alias("open_value"))


@query("SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_combinations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderpriority", "o_orderstatus").distinct()


@query("SELECT COUNT(*) AS n, CAST(SUM(CAST(p_retailprice AS DECIMAL(12,2)) * p_size) AS DOUBLE) AS stock_value, "
       "CAST(SUM(CAST(p_size AS BIGINT) * 2) AS DOUBLE) / COUNT(p_size) AS avg_double_size, "
       "MAX(p_retailprice - p_size) AS max_gap, MIN(p_retailprice - p_size) AS min_gap, "
       "COUNT(CASE WHEN p_size > 25 THEN 1 END) AS large FROM part")
def one_row_of_measures(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size").cast("long")
    return table(spark, d, "part").agg(
        F.count("*").alias("n"),
        F.sum(F.col("p_retailprice").cast(MONEY) * F.col("p_size")).cast("double").alias("stock_value"),
        F.avg(size * 2).alias("avg_double_size"), F.max(F.col("p_retailprice") - size).alias("max_gap"),
        F.min(F.col("p_retailprice") - size).alias("min_gap"), F.count_if(size > 25).alias("large"))


@query("SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS companies FROM orders GROUP BY 1")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("companies"))


@query("SELECT p_size % 5 AS bucket, CAST(SUM(p_size) AS DOUBLE) / NULLIF(SUM(CASE WHEN p_size > 45 THEN 1 ELSE 0 END), 0) "
       "AS safe_ratio FROM part WHERE p_size < 48 GROUP BY 1")
def safe_division(spark: SparkSession, d: str) -> DataFrame:
    """A ratio whose denominator is 0 for some groups gives null there."""
    size = F.col("p_size")
    return table(spark, d, "part").where(size < 48).groupBy((size % 5).alias("bucket")).agg(
        F.try_divide(F.sum(size).cast("double"), F.sum(facts.flag(size > 45)).cast("double")).alias("safe_ratio"))


@query("SELECT c_custkey, c_nationkey, c_acctbal, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank FROM customer "
       "WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC)")
def ranked_customers(spark: SparkSession, d: str) -> DataFrame:
    return ranked_within(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"),
                         ["c_nationkey"], "c_acctbal")


@query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey "
       "LEFT JOIN region ON r_regionkey = n_regionkey")
def related_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of related dimensions; both are far below the broadcast threshold Spark checks."""
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, d, "customer").join(nation, "c_nationkey", "left").join(region, "n_regionkey", "left") \
        .select("c_custkey", "n_name", "r_name")


@query("SELECT p_brand, n, avg_size, avg_size > 25 AS large FROM (SELECT p_brand, COUNT(*) AS n, "
       "CAST(SUM(p_size) AS DOUBLE) / COUNT(*) AS avg_size FROM part GROUP BY 1)")
def summarized_with_added_columns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.avg("p_size").alias("avg_size")) \
        .withColumn("large", F.col("avg_size") > 25)


@query("SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) / CAST(SUM(CAST(o_totalprice AS "
       "DECIMAL(12,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS share FROM orders")
def order_share_of_customer(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast(MONEY).alias("price"))
    return share_of_group(rows, ["o_custkey"], "price").select("o_orderkey", "o_custkey", "share")


@query("SELECT p_name, CASE WHEN COUNT(DISTINCT p_brand) = 1 THEN MAX(p_brand) END AS only_brand FROM part "
       "WHERE p_size > 44 GROUP BY 1")
def selected_brand(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where("p_size > 44").groupBy("p_name").agg(
        selected_value("p_brand").alias("only_brand"))


@query("SELECT p_partkey, p_brand, p_size, SUM(CAST(p_size AS BIGINT)) OVER (PARTITION BY p_brand ORDER BY p_size "
       "RANGE UNBOUNDED PRECEDING) AS so_far FROM part")
def row_against_its_group(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return running_to_here(rows, ["p_brand"], "p_size", "p_size")


@query(f"WITH {TICKETS}, s AS (SELECT queue, CAST(ts AS DATE) AS day, SUM(price) AS price FROM tickets GROUP BY 1, 2) "
       "SELECT queue, day, CAST(price AS DOUBLE) AS price, CAST(SUM(price) OVER (PARTITION BY queue, year(day) "
       "ORDER BY day) AS DOUBLE) AS ytd FROM s")
def tickets_year_to_date(spark: SparkSession, d: str) -> DataFrame:
    daily = facts.tickets(spark, d).select("queue", F.to_date("ts").alias("day"), "price")
    return year_to_date(daily, ["queue"], "day", "price").select(
        "queue", "day", F.col("price").cast("double").alias("price"), F.col("ytd").cast("double").alias("ytd"))


@query(f"WITH {TICKETS}, s AS (SELECT queue, CAST(date_trunc('month', ts) AS DATE) AS month, COUNT(*) AS n "
       "FROM tickets GROUP BY 1, 2) SELECT s.*, b.n AS last_year FROM s LEFT JOIN s b ON b.queue = s.queue "
       "AND b.month = CAST(s.month - INTERVAL 12 MONTH AS DATE)")
def tickets_same_period_last_year(spark: SparkSession, d: str) -> DataFrame:
    months = facts.tickets(spark, d).groupBy("queue", F.to_date(F.date_trunc("month", "ts")).alias("month")) \
        .agg(F.count("*").alias("n"))
    return same_period_last_year(months, ["queue"], "month", "n")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'O' THEN 'open' ELSE 'backlog' END AS state, "
       "s_acctbal IS NULL AS no_supplier, COALESCE(s_name, 'none') AS supplier FROM orders "
       "LEFT JOIN supplier ON s_suppkey = o_orderkey")
def switched_values(spark: SparkSession, d: str) -> DataFrame:
    suppliers = table(spark, d, "supplier").withColumnRenamed("s_suppkey", "o_orderkey")
    status = F.col("o_orderstatus")
    return table(spark, d, "orders").join(suppliers, "o_orderkey", "left").select(
        "o_orderkey", F.when(status == "F", "resolved").when(status == "O", "open").otherwise("backlog").alias("state"),
        F.isnull("s_acctbal").alias("no_supplier"), F.coalesce("s_name", F.lit("none")).alias("supplier"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus || '/' || o_orderpriority AS tag FROM orders")
def formatted_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("tag"))


@query("SELECT p_name, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS joined FROM part GROUP BY 1")
def joined_types(spark: SparkSession, d: str) -> DataFrame:
    return joined_values(table(spark, d, "part"), ["p_name"], "p_type")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), lower('RiNG'))")
def searched_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(contains_ci("p_name", "RiNG")).select("p_partkey", "p_name")


@query(f"WITH {PROJECT_TIME}, x AS (SELECT 30 AS least) SELECT project, COUNT(*) AS n FROM project_time, x "
       "WHERE hrs >= least GROUP BY 1")
def measures_with_variable(spark: SparkSession, d: str) -> DataFrame:
    least = 30
    return facts.project_entries(spark, d).where(F.col("hrs") >= least).groupBy("project").agg(F.count("*").alias("n"))
