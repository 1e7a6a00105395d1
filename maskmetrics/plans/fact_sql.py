"""The facts of plans.facts in SQL, as common table expressions for the oracle queries."""

TIME_ENTRIES = """time_entries AS (
  SELECT l_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS resource_id, l_shipdate AS ts,
    CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS rev,
    CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
      - CAST(0.70 AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS profit,
    CAST(l_quantity AS DECIMAL(12,2)) AS hrs, CAST(l_quantity AS DECIMAL(12,2)) AS total_hrs,
    CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END AS bill_hrs,
    CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END AS nonbill_hrs,
    CAST(l_quantity AS DECIMAL(12,2)) AS actual_hrs,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS milestones_done,
    l_returnflag AS kind, l_linestatus AS line_status FROM lineitem)"""

COMPANY_TIME = TIME_ENTRIES + """, company_time AS (
  SELECT t.*, o_custkey AS company_id, c_name AS company FROM time_entries t
  JOIN orders ON o_orderkey = t.order_id JOIN customer ON c_custkey = o_custkey)"""

RESOURCE_TIME = TIME_ENTRIES + """, resource_time AS (
  SELECT t.*, s_name AS resource FROM time_entries t JOIN supplier ON s_suppkey = t.resource_id)"""

PROJECT_TIME = TIME_ENTRIES + """, project_time AS (
  SELECT t.*, p_brand AS project, p_type AS phase, CAST(p_size AS BIGINT) AS budget_hrs
  FROM time_entries t JOIN part ON p_partkey = t.part_id)"""

TICKETS = """tickets AS (
  SELECT o_orderkey AS ticket_id, o_custkey AS company_id, c_name AS company, o_orderdate AS ts,
    o_orderpriority AS queue, 1 AS t_total, 1 AS t_cr,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS t_res,
    CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS t_open,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS t_backlog,
    CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END AS fr_met,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS res_met,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS overdue,
    CAST(o_totalprice AS DECIMAL(12,2)) AS price
  FROM orders JOIN customer ON c_custkey = o_custkey)"""

SURVEYS = """surveys AS (
  SELECT 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS contact, ts, 1 AS t_total,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS csat_n,
    CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) ELSE 0 END AS csat_sum
  FROM events)"""

DEVICES = """devices AS (
  SELECT 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS contact, ts,
    CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS online,
    CASE WHEN event_type NOT IN ('click', 'view') THEN 1 ELSE 0 END AS offline,
    1 AS total_devices, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS alerts,
    CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS tickets FROM events)"""

ENDPOINTS = """endpoints AS (
  SELECT p_brand AS brand, DATE '2024-01-01' + CAST(p_partkey % 365 AS INTEGER) AS ts,
    1 AS total_endpoints, CASE WHEN p_size <= 40 THEN 1 ELSE 0 END AS patched,
    CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS unpatched,
    CASE WHEN p_size > 48 THEN 1 ELSE 0 END AS critical,
    CASE WHEN p_size > 45 THEN 1 ELSE 0 END AS overdue,
    CASE WHEN p_size <= 40 THEN 'installed' WHEN p_size <= 43 THEN 'approved-pending'
      WHEN p_size <= 46 THEN 'install-error' WHEN p_size <= 48 THEN 'reboot-required'
      ELSE 'no-policy' END AS state FROM part)"""
