"""Dictionary, masking and restoring on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskmetrics.functions.text import default_alias
from maskmetrics.operators.masking import mask_json, mask_nested, mask_table, mask_text
from maskmetrics.operators.registry import (
    Registry, SensitiveColumn, alias_value, build_registry, category_counts, distinct_values, get_mapping,
    match_order, register_dynamic, registry_stats, sample_values, self_test, unalias_value)
from maskmetrics.operators.restoring import (
    filter_and_mask, filter_by_alias, restore_counts, restore_html, restore_text, rewrite_alias_literals,
    without_categories)
from maskmetrics.plans.facts import contact, table
from maskmetrics.plans.registered import query
from maskmetrics.session import scratch_root
from maskmetrics.sources.mapping_store import MappingStore, mapping_from_json
from maskmetrics.sources.reports import restore_files

# --- the dictionary of the service desk, in both languages --------------------------


def desk_registry(spark: SparkSession, d: str) -> Registry:
    """Clients, resources and contacts of the driver tables."""
    contacts = table(spark, d, "events").select(contact().alias("email"))
    return build_registry(
        spark,
        [SensitiveColumn("client", "customer", "c_name"), SensitiveColumn("resource", "supplier", "s_name"),
         SensitiveColumn("contact", "contacts", "email")],
        {"customer": table(spark, d, "customer"), "supplier": table(spark, d, "supplier"), "contacts": contacts})


ALIASES = """clients AS (
  SELECT norm, value, rn, CASE WHEN rn <= 26 THEN 'Client_' || chr(CAST(64 + rn AS INTEGER)) ELSE 'Client_' || rn END AS alias
  FROM (SELECT norm, value, row_number() OVER (ORDER BY norm) AS rn
        FROM (SELECT lower(trim(c_name)) AS norm, MIN(trim(c_name)) AS value FROM customer GROUP BY 1))),
resources AS (
  SELECT norm, value, rn, 'Resource_' || rn AS alias FROM (SELECT norm, value, row_number() OVER (ORDER BY norm) AS rn
        FROM (SELECT lower(trim(s_name)) AS norm, MIN(trim(s_name)) AS value FROM supplier GROUP BY 1))),
contacts AS (
  SELECT norm, norm AS value, rn, 'Contact_' || rn AS alias FROM (SELECT norm, row_number() OVER (ORDER BY norm) AS rn
        FROM (SELECT DISTINCT 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS norm FROM events))),
registry AS (
  SELECT 'client' AS category, norm, alias, value, rn - 1 AS ordinal FROM clients
  UNION ALL SELECT 'resource', norm, alias, value, (SELECT COUNT(*) FROM clients) + rn - 1 FROM resources
  UNION ALL SELECT 'contact', norm, alias, value,
    (SELECT COUNT(*) FROM clients) + (SELECT COUNT(*) FROM resources) + rn - 1 FROM contacts)"""


@query("SELECT DISTINCT trim(c_mktsegment) AS value FROM customer WHERE trim(c_mktsegment) <> ''")
def distinct_segments(spark: SparkSession, d: str) -> DataFrame:
    return distinct_values(table(spark, d, "customer"), "c_mktsegment")


@query("SELECT DISTINCT trim(s_name) AS value FROM supplier ORDER BY 1 LIMIT 3")
def sampled_suppliers(spark: SparkSession, d: str) -> DataFrame:
    return sample_values(table(spark, d, "supplier"), "s_name")


@query(f"WITH {ALIASES} SELECT category, norm, alias, value, ordinal FROM registry")
def alias_registry(spark: SparkSession, d: str) -> DataFrame:
    return desk_registry(spark, d).df


@query(f"WITH {ALIASES} SELECT alias, value FROM registry")
def alias_mapping(spark: SparkSession, d: str) -> DataFrame:
    return get_mapping(desk_registry(spark, d))


@query(f"WITH {ALIASES} SELECT category, COUNT(*) AS entities FROM registry GROUP BY 1")
def alias_counts(spark: SparkSession, d: str) -> DataFrame:
    return category_counts(desk_registry(spark, d))


@query(f"WITH {ALIASES} SELECT true AS enabled, COUNT(*) AS registry_entities, 0 AS detections, true AS degraded "
       "FROM registry WHERE category = 'client'")
def registry_with_failed_column(spark: SparkSession, d: str) -> DataFrame:
    """One column cannot be loaded: a warning, and the other column still works."""
    registry = build_registry(
        spark, [SensitiveColumn("client", "customer", "c_name"), SensitiveColumn("resource", "customer", "no_such")],
        {"customer": table(spark, d, "customer")})
    return registry_stats(registry).drop("warnings")


@query(f"WITH {ALIASES} SELECT category, norm, alias, value, ordinal, length(value) AS length FROM registry")
def alias_match_order(spark: SparkSession, d: str) -> DataFrame:
    return match_order(desk_registry(spark, d))


@query(f"WITH {ALIASES}, fresh AS (SELECT norm, value, row_number() OVER (ORDER BY norm) - 1 AS i FROM "
       "(SELECT lower(p_name) AS norm, MIN(p_name) AS value FROM part GROUP BY 1)) "
       "SELECT category, norm, alias, value, ordinal FROM registry UNION ALL SELECT 'dataset', norm, 'Dataset_' || (i + 1), value, "
       "(SELECT COUNT(*) FROM registry) + i FROM fresh")
def registry_grown_by_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Catalog names are added later; values that are known keep their alias."""
    registry = desk_registry(spark, d)
    registry = register_dynamic(registry, table(spark, d, "part"), "p_name", "dataset")
    return register_dynamic(registry, table(spark, d, "customer"), "c_name", "client").df


@query("SELECT value, 'Client_' || chr(CAST(64 + row_number() OVER (ORDER BY value) AS INTEGER)) AS alias FROM "
       "(SELECT DISTINCT trim(c_name) AS value FROM customer ORDER BY 1 LIMIT 3)")
def registry_self_test(spark: SparkSession, d: str) -> DataFrame:
    ok, shown = self_test(table(spark, d, "customer"), "client", "c_name")
    return shown.where(F.lit(ok))


@query(f"WITH {ALIASES} SELECT c_custkey, COALESCE(alias, c_name) AS c_name, c_mktsegment FROM customer "
       "LEFT JOIN clients ON norm = lower(trim(c_name))")
def aliased_customers(spark: SparkSession, d: str) -> DataFrame:
    return alias_value(table(spark, d, "customer"), "c_name", desk_registry(spark, d)) \
        .select("c_custkey", "c_name", "c_mktsegment")


@query("SELECT c_custkey, c_name FROM customer")
def unaliased_customers(spark: SparkSession, d: str) -> DataFrame:
    registry = desk_registry(spark, d)
    masked = alias_value(table(spark, d, "customer").select("c_custkey", "c_name"), "c_name", registry)
    return unalias_value(masked, "c_name", registry)


@query("SELECT c_custkey, c_name FROM customer")
def masking_switched_off(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    return mask_table(customers, desk_registry(spark, d).disabled())


# --- text and nested data ----------------------------------------------------------

def line_texts(spark: SparkSession, d: str) -> DataFrame:
    """One sentence per line item that names a client, a resource and nobody else."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    text = F.concat(F.lit("Order "), F.col("l_orderkey").cast("string"), F.lit(" for "), F.upper("c_name"),
                    F.lit("'s desk (via "), "s_name", F.lit("), not x"), "c_name", F.lit("."))
    # Orders take their names along before they meet the lines, which are then moved once less.
    return lines.join(orders.join(customers, "o_custkey"), "l_orderkey").join(suppliers, "l_suppkey") \
        .select("l_orderkey", "l_linenumber", "l_partkey", text.alias("text"))


_LINES = """FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey"""
_LINE_TEXT = ("'Order ' || l_orderkey || ' for ' || {client} || '''s desk (via ' || {resource} || '), not x' || c_name || '.'")
_MASKED_LINES = (f"WITH {ALIASES} SELECT l_orderkey, l_linenumber, l_partkey, "
                 + _LINE_TEXT.format(client="clients.alias", resource="resources.alias") + f" AS text {_LINES} "
                 "JOIN clients ON clients.norm = lower(c_name) JOIN resources ON resources.norm = lower(s_name)")


@query(_MASKED_LINES)
def masked_line_texts(spark: SparkSession, d: str) -> DataFrame:
    """Free text with the dictionary plan its size picks."""
    return mask_text(line_texts(spark, d), "text", desk_registry(spark, d))


@query(_MASKED_LINES)
def masked_line_texts_by_join(spark: SparkSession, d: str) -> DataFrame:
    """The same with the plan for a dictionary that fits no executor."""
    return mask_text(line_texts(spark, d), "text", desk_registry(spark, d), plan="large")


_PLACES = """places AS (SELECT r_regionkey AS k, r_name AS name, 'Region_' || row_number() OVER (ORDER BY lower(r_name)) AS alias
  FROM region), lands AS (SELECT n_nationkey AS k, n_name AS name, n_regionkey AS r,
  'Nation_' || row_number() OVER (ORDER BY lower(n_name)) AS alias FROM nation)"""


@query(f"WITH {_PLACES} SELECT c_custkey, 'To ' || lands.alias || ' in ' || places.alias || '; ' || c_mktsegment || ' NATION_' AS text "
       "FROM customer JOIN lands ON lands.k = c_nationkey JOIN places ON places.k = lands.r")
def masked_place_texts(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary of thirty values runs as JVM regex replacements."""
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    registry = build_registry(
        spark, [SensitiveColumn("region", "region", "r_name"), SensitiveColumn("nation", "nation", "n_name")],
        {"region": region, "nation": nation})
    text = F.concat(F.lit("To "), F.lower("n_name"), F.lit(" in "), "r_name", F.lit("; "), "c_mktsegment", F.lit(" NATION_"))
    rows = table(spark, d, "customer").join(nation, "c_nationkey").join(region, "n_regionkey") \
        .select("c_custkey", text.alias("text"))
    return mask_text(rows, "text", registry)


@query(f"WITH {ALIASES} SELECT o_orderkey, alias AS first_name, 'about ' || alias AS note, o_totalprice AS amount, "
       "c_name AS map_key, alias AS map_value FROM orders JOIN customer ON c_custkey = o_custkey "
       "JOIN clients ON norm = lower(c_name)")
def masked_nested_orders(spark: SparkSession, d: str) -> DataFrame:
    """String values at any depth change; map keys and numbers do not."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    rows = table(spark, d, "orders").join(customers, "o_custkey").select("o_orderkey", F.struct(
        F.array(F.struct(F.col("c_name").alias("name"), F.col("o_totalprice").alias("amount"),
                         F.array(F.concat(F.lit("about "), F.lower("c_name"))).alias("notes"))).alias("rows"),
        F.create_map("c_name", "c_name").alias("tags")).alias("result"))
    masked = mask_nested(rows, "result", desk_registry(spark, d))
    first = F.col("result.rows")[0]
    return masked.select("o_orderkey", first["name"].alias("first_name"), first["notes"][0].alias("note"),
                         first["amount"].alias("amount"), F.map_keys("result.tags")[0].alias("map_key"),
                         F.map_values("result.tags")[0].alias("map_value"))


@query(f"WITH {ALIASES} SELECT o_orderkey, clients.alias AS c_name, 'owner: ' || clients.alias AS note, o_orderstatus, o_totalprice "
       "FROM orders JOIN customer ON c_custkey = o_custkey JOIN clients ON norm = lower(c_name)")
def masked_table_by_value(spark: SparkSession, d: str) -> DataFrame:
    """Every string column is searched, also those that nobody configured."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    rows = table(spark, d, "orders").join(customers, "o_custkey").select(
        "o_orderkey", "c_name", F.concat(F.lit("owner: "), "c_name").alias("note"), "o_orderstatus", "o_totalprice")
    return mask_table(rows, desk_registry(spark, d))


@query(f"WITH {ALIASES} SELECT o_orderkey, '{{\"' || c_name || '\":[\"' || alias || '\",' || o_custkey || '],\"note\":\"say \\\"' || alias || '\\\"\"}}' AS json "
       "FROM orders JOIN customer ON c_custkey = o_custkey JOIN clients ON norm = lower(c_name)")
def masked_json_texts(spark: SparkSession, d: str) -> DataFrame:
    """JSON texts: names go from values and stay in keys."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    text = F.concat(F.lit('{"'), "c_name", F.lit('":["'), "c_name", F.lit('",'), F.col("o_custkey").cast("string"),
                    F.lit('],"note":"say \\"'), "c_name", F.lit('\\""}'))
    rows = table(spark, d, "orders").join(customers, "o_custkey").select("o_orderkey", text.alias("json"))
    return mask_json(rows, "json", desk_registry(spark, d))


@query(f"WITH {ALIASES} SELECT o_orderkey, alias AS who, 'say ' || alias || '!' AS note, CAST(o_custkey AS BIGINT) AS number, CAST(o_orderdate AS DATE) AS day, "
       "o_totalprice AS price, 'OBJECT<at: DATE, by: STRING, key: BIGINT, notes: ARRAY<STRING>, price: DOUBLE>' AS kinds "
       "FROM orders JOIN customer ON c_custkey = o_custkey JOIN clients ON norm = lower(c_name)")
def masked_variant_orders(spark: SparkSession, d: str) -> DataFrame:
    """VARIANT values of a table: names go from strings at any depth, all other values keep their types."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    packed = F.to_variant_object(F.struct(
        F.to_date("o_orderdate").alias("at"), F.col("c_name").alias("by"), F.col("o_custkey").cast("long").alias("key"),
        F.array(F.concat(F.lit("say "), "c_name", F.lit("!")), F.lit("")).alias("notes"), F.col("o_totalprice").cast("double").alias("price")))
    rows = table(spark, d, "orders").join(customers, "o_custkey").select("o_orderkey", packed.alias("v"))
    masked = mask_table(rows, desk_registry(spark, d))
    return masked.select("o_orderkey", F.variant_get("v", "$.by", "string").alias("who"), F.variant_get("v", "$.notes[0]", "string").alias("note"),
                         F.variant_get("v", "$.key", "long").alias("number"), F.variant_get("v", "$.at", "date").alias("day"),
                         F.variant_get("v", "$.price", "double").alias("price"), F.schema_of_variant("v").alias("kinds"))


@query(f"WITH {ALIASES} SELECT event_id, '{{\"by\":\"' || alias || '\",\"props\":' || replace(props, ' ', '') || '}}' AS json "
       "FROM events JOIN contacts ON norm = 'user' || CAST(user_id AS VARCHAR) || '@example.com'")
def masked_parsed_events(spark: SparkSession, d: str) -> DataFrame:
    """Parsed JSON of events with the contact in it, masked by the plan of a large dictionary and printed again."""
    text = F.concat(F.lit('{"by":"'), contact(), F.lit('","props":'), "props", F.lit("}"))
    rows = table(spark, d, "events").select("event_id", F.parse_json(text).alias("v"))
    return mask_nested(rows, "v", desk_registry(spark, d), plan="large").select("event_id", F.to_json("v").alias("json"))


# --- restoring ---------------------------------------------------------------------

_PLAIN_LINES = (f"SELECT l_orderkey, l_linenumber, l_partkey, "
                + _LINE_TEXT.format(client="c_name", resource="s_name") + f" AS text {_LINES}")


@query(_PLAIN_LINES)
def restored_line_texts(spark: SparkSession, d: str) -> DataFrame:
    """Masked and restored again; names come back in their registered spelling."""
    registry = desk_registry(spark, d)
    return restore_text(mask_text(line_texts(spark, d), "text", registry), "text", get_mapping(registry))


@query("SELECT o_orderkey, 'By ' || c_name || ', x' || c_name || 'y, desk-' || o_custkey || '?' AS text FROM orders JOIN customer ON c_custkey = o_custkey")
def restored_odd_aliases(spark: SparkSession, d: str) -> DataFrame:
    """One alias per customer that is no stem with a number, too many to list: an index of their rarest grams finds them."""
    desk = F.concat(F.lit("desk-"), F.col("c_custkey").cast("string"), F.lit("#"))
    mapping = table(spark, d, "customer").select(desk.alias("alias"), F.col("c_name").alias("value"))
    key = F.col("o_custkey").cast("string")
    text = F.concat(F.lit("By desk-"), key, F.lit("#, xdesk-"), key, F.lit("#y, desk-"), key, F.lit("?"))
    return restore_text(table(spark, d, "orders").select("o_orderkey", text.alias("text")), "text", mapping)


@query(_PLAIN_LINES)
def restored_line_texts_by_join(spark: SparkSession, d: str) -> DataFrame:
    registry = desk_registry(spark, d)
    masked = mask_text(line_texts(spark, d), "text", registry)
    return restore_text(masked, "text", get_mapping(registry), plan="join")


@query(f"WITH {ALIASES} SELECT l_orderkey, l_linenumber, l_partkey, "
       + _LINE_TEXT.format(client="c_name", resource="resources.alias")
       + f" AS text {_LINES} JOIN resources ON norm = lower(s_name)")
def restored_without_resources(spark: SparkSession, d: str) -> DataFrame:
    """Selective restore: resources stay aliases."""
    registry = desk_registry(spark, d)
    masked = mask_text(line_texts(spark, d), "text", registry)
    return restore_text(masked, "text", without_categories(get_mapping(registry), ["Resource_"]))


def person_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Tokens whose values need escaping in HTML."""
    value = F.concat(F.lit("T&J <"), "c_name", F.lit(">"))
    return table(spark, d, "customer").select(
        F.concat(F.lit("<PERSON_"), (F.col("c_custkey") + 1).cast("string"), F.lit(">")).alias("alias"), value.alias("value"))


def _person(key: Column) -> Column:
    return (key + 1).cast("string")


@query("SELECT o_orderkey, 'T&J <' || c_name || '> and T&J <' || c_name || '>, not PERSON_' || (c_custkey + 1) || '9X' AS text "
       "FROM orders JOIN customer ON c_custkey = o_custkey")
def restored_bare_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens that lost their brackets are restored, longer look-alikes are not."""
    n = _person(F.col("o_custkey"))
    text = F.concat(F.lit("PERSON_"), n, F.lit(" and <PERSON_"), n, F.lit(">, not PERSON_"), n, F.lit("9X"))
    return restore_text(table(spark, d, "orders").select("o_orderkey", text.alias("text")), "text", person_mapping(spark, d))


def _reports(spark: SparkSession, d: str) -> DataFrame:
    n = _person(F.col("o_custkey"))
    html = F.concat(F.lit("<p>&lt;PERSON_"), n, F.lit("&gt; / <PERSON_"), n, F.lit("> / PERSON_"), n, F.lit(" / CLIENT_x</p>"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("report_id"), html.alias("html"))


@query("SELECT o_orderkey AS report_id, '<p>' || v || ' / ' || v || ' / ' || v || ' / CLIENT_x</p>' AS html FROM "
       "(SELECT o_orderkey, 'T&amp;J &lt;' || c_name || '&gt;' AS v FROM orders JOIN customer ON c_custkey = o_custkey)")
def restored_reports(spark: SparkSession, d: str) -> DataFrame:
    """HTML reports: escaped and raw alias forms are known, values are escaped."""
    return restore_html(_reports(spark, d), "html", person_mapping(spark, d))


@query("SELECT o_orderkey AS report_id, 3 AS restored FROM orders")
def restored_report_counts(spark: SparkSession, d: str) -> DataFrame:
    return restore_counts(_reports(spark, d), "html", person_mapping(spark, d)).select("report_id", "restored")


def query_log(spark: SparkSession, d: str) -> DataFrame:
    """Stored queries that filter on aliases, with aliases outside literals too."""
    k = (F.col("o_orderkey") + 27).cast("string")
    text = F.concat(F.lit("FILTER(T, T[name] = \"Client_"), k, F.lit("\" && Client_"), k,
                    F.lit(" > 1 || T[owner] = \"said \"\"Resource_"), k, F.lit("\"\" twice\")"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("query_id"), text.alias("query"))


@query(f"WITH {ALIASES} SELECT query_id, 'FILTER(T, T[name] = \"' || COALESCE(c.value, 'Client_' || k) || '\" && Client_' || k || "
       "' > 1 || T[owner] = \"said \"\"' || COALESCE(r.value, 'Resource_' || k) || '\"\" twice\")' AS rewritten, "
       "CASE WHEN c.value IS NULL THEN 0 ELSE 1 END + CASE WHEN r.value IS NULL THEN 0 ELSE 1 END AS n "
       "FROM (SELECT o_orderkey AS query_id, CAST(o_orderkey + 27 AS VARCHAR) AS k FROM orders) "
       "LEFT JOIN clients c ON c.alias = 'Client_' || k LEFT JOIN resources r ON r.alias = 'Resource_' || k")
def rewritten_query_log(spark: SparkSession, d: str) -> DataFrame:
    return rewrite_alias_literals(query_log(spark, d), "query", get_mapping(desk_registry(spark, d))) \
        .select("query_id", "rewritten", "n")


_ASKED = ["Client_C", "Client_27", "Client_100"]


@query(f"WITH {ALIASES} SELECT c_custkey, c_name FROM customer JOIN clients ON norm = lower(trim(c_name)) "
       "WHERE alias IN ('Client_C', 'Client_27', 'Client_100')")
def customers_by_alias(spark: SparkSession, d: str) -> DataFrame:
    """The analyst filters on aliases, the data holds names."""
    return filter_by_alias(table(spark, d, "customer").select("c_custkey", "c_name"), "c_name", _ASKED,
                           desk_registry(spark, d))


@query(f"WITH {ALIASES} SELECT alias AS c_name, COUNT(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey "
       "JOIN clients ON norm = lower(trim(c_name)) WHERE alias IN ('Client_C', 'Client_27', 'Client_100') GROUP BY 1")
def order_counts_by_alias(spark: SparkSession, d: str) -> DataFrame:
    """Round trip: alias filter in, aliases out, one lazy plan in between."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    asked = filter_and_mask(customers, "c_name", _ASKED, desk_registry(spark, d))
    return table(spark, d, "orders").join(asked, "o_custkey").groupBy("c_name").agg(F.count("*").alias("orders"))


# --- saved mappings ----------------------------------------------------------------

def session_store(spark: SparkSession, d: str) -> MappingStore:
    """One saved session per nation, created when its last order came in."""
    store = MappingStore(spark, f"{scratch_root(spark)}/maskmetrics/sessions-{uuid.uuid4().hex}", 100)
    session = F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string"))
    customers = table(spark, d, "customer").select("c_custkey", "c_name", session.alias("session_id"))
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    stats = customers.join(orders, "c_custkey").groupBy("session_id").agg(
        F.max("o_orderdate").cast("timestamp").alias("created"), F.count_distinct("c_custkey").alias("registry_entities"),
        F.lit(0).cast("long").alias("detections"), F.lit(False).alias("degraded"))
    mapping = customers.select(F.concat(F.lit("Client_"), F.col("c_custkey").cast("string")).alias("alias"),
                               F.col("c_name").alias("value"), "session_id", F.lit("2001-01-01").cast("timestamp").alias("created"))
    store.save_all(mapping, stats)
    return store


_SESSIONS = """sessions AS (SELECT 'nation-' || c_nationkey AS session_id, MAX(o_orderdate) AS created
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1)"""


@query("SELECT 'Client_' || c_custkey AS alias, c_name AS value, 'nation-' || c_nationkey AS session_id FROM customer "
       "WHERE c_nationkey = 7")
def session_mapping(spark: SparkSession, d: str) -> DataFrame:
    """One session; only its partition is read."""
    return session_store(spark, d).load("nation-7").select("alias", "value", "session_id")


@query(f"WITH {_SESSIONS} SELECT 'Client_' || c_custkey AS alias, c_name AS value, 'nation-' || c_nationkey AS session_id "
       "FROM customer WHERE 'nation-' || c_nationkey = (SELECT session_id FROM sessions ORDER BY created DESC, session_id DESC LIMIT 1)")
def latest_session_mapping(spark: SparkSession, d: str) -> DataFrame:
    return session_store(spark, d).load_latest().select("alias", "value", "session_id")


@query(f"WITH {_SESSIONS} SELECT session_id FROM sessions WHERE session_id = 'nation-3' OR "
       "created >= TIMESTAMP '2001-11-09' - INTERVAL 100 DAY")
def sessions_after_expiry(spark: SparkSession, d: str) -> DataFrame:
    """Sessions past the retention time go, the current one stays."""
    store = session_store(spark, d)
    store.expire("nation-3", F.lit("2001-11-09").cast("timestamp"))
    return store.stats().select("session_id")


@query(f"WITH {_SESSIONS} SELECT 'Client_' || c_custkey AS alias, c_name AS value, 'nation-' || c_nationkey AS session_id FROM customer "
       "WHERE 'nation-' || c_nationkey = (SELECT session_id FROM sessions ORDER BY created DESC, session_id DESC LIMIT 1)")
def latest_mapping_beside_torn_saves(spark: SparkSession, d: str) -> DataFrame:
    """Saves that ended before they were whole are not seen: neither a new session nor a replaced one."""
    store = session_store(spark, d)
    latest = store.latest_session()
    late = F.lit("2099-01-01").cast("timestamp").alias("created")
    other = table(spark, d, "supplier").select(F.lit("Client_0").alias("alias"), F.col("s_name").alias("value"), late, F.explode(F.array(F.lit("torn"), F.lit(latest))).alias("session_id"))
    stats = other.select(F.lit(1).cast("long").alias("registry_entities"), F.lit(0).cast("long").alias("detections"), F.lit(False).alias("degraded"), late, "session_id").distinct()
    store.write(other, stats)
    return store.load_latest().select("alias", "value", "session_id")


@query("SELECT 'Client_' || c_custkey AS alias, c_name AS value FROM customer")
def mapping_read_from_json(spark: SparkSession, d: str) -> DataFrame:
    """Mapping files come flat or wrapped; one JSON text per customer here."""
    one = F.create_map(F.concat(F.lit("Client_"), F.col("c_custkey").cast("string")), F.col("c_name"))
    text = F.when(F.col("c_custkey") % 2 == 0, F.to_json(one)) \
        .otherwise(F.to_json(F.struct(one.alias("mappings"), F.lit("x").alias("session_id"))))
    return mapping_from_json(table(spark, d, "customer").select(text.alias("json")), "json")


# --- one matching rule, whatever the size of the dictionary ----------------------------

# A word in two spellings that only simple case folding makes equal.
_SPELLED, _WRITTEN = "\u0130stan\u03a3bul\u212a", "\u0131\u017fTAN\u03c2bulk"
_FOREIGN = ("WITH lands AS (SELECT n_nationkey AS k, 'Nation_' || row_number() OVER (ORDER BY lower(n_name)) AS alias FROM nation) "
            "SELECT c_custkey, 'at ' || alias || '; ' || alias || '.x (' || alias || ') x\u0131\u017fTAN' AS text FROM customer JOIN lands ON k = c_nationkey")


def _foreign_texts(spark: SparkSession, d: str, plan: str) -> DataFrame:
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey") \
        .withColumn("name", F.concat(F.lit(_SPELLED + " "), "n_name"))
    registry = build_registry(spark, [SensitiveColumn("nation", "nation", "name")], {"nation": nation})
    written = F.concat(F.lit(_WRITTEN + " "), F.lower("n_name"))
    text = F.concat(F.lit("at "), written, F.lit("; "), "name", F.lit(".x ("), F.upper("name"), F.lit(") x\u0131\u017fTAN"))
    rows = table(spark, d, "customer").join(nation, "c_nationkey").select("c_custkey", text.alias("text"))
    return mask_text(rows, "text", registry, plan)


@query(_FOREIGN)
def masked_foreign_texts_small(spark: SparkSession, d: str) -> DataFrame:
    """Letters whose case depends on language or place, in JVM regex replacements."""
    return _foreign_texts(spark, d, "small")


@query(_FOREIGN)
def masked_foreign_texts_medium(spark: SparkSession, d: str) -> DataFrame:
    """The same texts and values with the broadcast dictionary."""
    return _foreign_texts(spark, d, "medium")


@query(_FOREIGN)
def masked_foreign_texts_large(spark: SparkSession, d: str) -> DataFrame:
    """The same texts and values with the joined dictionary."""
    return _foreign_texts(spark, d, "large")


# --- files ----------------------------------------------------------------------------

@query(f"WITH {ALIASES}, sums AS (SELECT c_nationkey AS k, COUNT(*) AS n FROM customer GROUP BY 1) "
       "SELECT '<p>_' || value || '_ and QBR_' || value || '.html: ' || n || '</p>' AS html FROM sums JOIN clients ON rn = k + 1")
def restored_report_files(spark: SparkSession, d: str) -> DataFrame:
    """A folder with one masked report per nation, restored into another folder."""
    run = f"{scratch_root(spark)}/maskmetrics/report-files-{uuid.uuid4().hex}"
    alias = default_alias(F.lit("client"), F.col("c_nationkey"))
    html = F.concat(F.lit("<p>_"), alias, F.lit("_ and QBR_"), alias, F.lit(".html: "), F.col("n").cast("string"), F.lit("</p>"))
    sums = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    sums.select("c_nationkey", html.alias("value")).write.partitionBy("c_nationkey").text(f"{run}/in")
    restore_files(spark, f"{run}/in/*", get_mapping(desk_registry(spark, d)), f"{run}/out")
    # A text file ends with a line break.
    return spark.read.parquet(f"{run}/out").select(F.rtrim(F.col("html"), F.lit("\n")).alias("html"))
