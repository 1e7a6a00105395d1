"""The driver tables in the roles of a service desk: tickets, time entries, surveys, devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flag(condition: Column) -> Column:
    """1 or 0, for sums that count."""
    return F.when(condition, 1).otherwise(0)


def revenue() -> Column:
    """Exact to four decimals and small enough for long arithmetic."""
    return F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast(RATE))


def time_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: revenue, profit, hours and their split."""
    hours = F.col("l_quantity").cast(MONEY)
    billable = F.col("l_returnflag") != "R"
    cost = F.lit("0.70").cast(RATE) * F.col("l_extendedprice").cast(MONEY)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("resource_id"), F.col("l_shipdate").alias("ts"),
        revenue().alias("rev"), (revenue() - cost).alias("profit"), hours.alias("hrs"),
        hours.alias("total_hrs"), F.when(billable, hours).otherwise(0).alias("bill_hrs"),
        F.when(billable, 0).otherwise(hours).alias("nonbill_hrs"), hours.alias("actual_hrs"),
        flag(F.col("l_linestatus") == "F").alias("milestones_done"),
        F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("line_status"))


def company_time_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time entries with the company of their order."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("company_id"))
    return time_entries(spark, sf_dir).join(orders, "order_id")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company"))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("resource_id"), F.col("s_name").alias("resource"))


def project_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time entries with project (brand), phase (type) and budget (size) of their part."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_id"), F.col("p_brand").alias("project"),
        F.col("p_type").alias("phase"), F.col("p_size").cast("long").alias("budget_hrs"))
    return time_entries(spark, sf_dir).join(parts, "part_id")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: created, resolved (F), open (O) and backlog (P)."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ticket_id"), F.col("o_custkey").alias("company_id"),
        F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("queue"),
        F.lit(1).alias("t_total"), F.lit(1).alias("t_cr"), flag(status == "F").alias("t_res"),
        flag(status == "O").alias("t_open"), flag(status == "P").alias("t_backlog"),
        flag(status != "P").alias("fr_met"), flag(status == "F").alias("res_met"),
        flag(status == "P").alias("overdue"), F.col("o_totalprice").cast(MONEY).alias("price"))


def surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: purchases are answered surveys, their value is the score."""
    answered = F.col("event_type") == "purchase"
    return table(spark, sf_dir, "events").select(
        contact().alias("contact"), "ts", F.lit(1).alias("t_total"), flag(answered).alias("csat_n"),
        F.when(answered, F.col("value").cast(MONEY)).otherwise(0).alias("csat_sum"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: clicks and views are devices online, errors are alerts."""
    kind = F.col("event_type")
    online = kind.isin("click", "view")
    return table(spark, sf_dir, "events").select(
        contact().alias("contact"), "ts", flag(online).alias("online"), flag(~online).alias("offline"),
        F.lit(1).alias("total_devices"), flag(kind == "error").alias("alerts"),
        flag(kind == "signup").alias("tickets"))


def contact() -> Column:
    return F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))


def endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part: its size tells how far its patches are."""
    size = F.col("p_size")
    installed = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 365).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand"), installed.cast("timestamp_ntz").alias("ts"),
        F.lit(1).alias("total_endpoints"), flag(size <= 40).alias("patched"),
        flag(size > 40).alias("unpatched"), flag(size > 48).alias("critical"),
        flag(size > 45).alias("overdue"),
        F.when(size <= 40, "installed").when(size <= 43, "approved-pending")
        .when(size <= 46, "install-error").when(size <= 48, "reboot-required")
        .otherwise("no-policy").alias("state"))
