"""Stray personal data in the driver's documents and conversations."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskmetrics.functions.pii_rules import PATTERN_DETECTORS, is_false_positive
from maskmetrics.operators.pii import (
    PluginDetector, anonymize, assign_tokens, detect_pii, explode_spans, full_mapping, pii_summary, replace_spans)
from maskmetrics.operators.registry import registry_stats
from maskmetrics.operators.restoring import restore_text
from maskmetrics.operators.sessions import anonymize_and_save
from maskmetrics.plans.alias_queries import ALIASES, desk_registry
from maskmetrics.plans.facts import table
from maskmetrics.plans.registered import query
from maskmetrics.session import scratch_root
from maskmetrics.sources.mapping_store import MappingStore, new_session

_LUHN = ("list_sum(list_transform(range(1, length(n) + 1), lambda i: CASE WHEN (length(n) - i) % 2 = 0 THEN TRY_CAST(n[i] AS INTEGER) "
         "ELSE (TRY_CAST(n[i] AS INTEGER) * 2) // 10 + (TRY_CAST(n[i] AS INTEGER) * 2) % 10 END)) % 10 = 0")


_DEA = ("((CAST(value[3] AS INT) + CAST(value[5] AS INT) + CAST(value[7] AS INT) + 2 * (CAST(value[4] AS INT) + CAST(value[6] AS INT) "
        "+ CAST(value[8] AS INT))) % 10 = CAST(value[9] AS INT))")


def _spans_sql(source: str = "SELECT doc_id, source, text FROM documents") -> str:
    """Spans per pattern from the lengths of matches and gaps; a span that a better one
    overlaps is dropped (no chains of overlaps occur in the data)."""
    parts = []
    for d in PATTERN_DETECTORS:
        if d.entity_type in ("IBAN_CODE", "CRYPTO") or d.context:
            continue  # no such value in the documents; they have a query and fixtures of their own
        p = d.pattern.replace("'", "''")
        parts.append(f"SELECT doc_id, source, '{d.entity_type}' AS entity_type, {d.score} AS score, "
                     f"regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g FROM docs "
                     f"WHERE regexp_matches(text, '{p}')")
    every = " UNION ALL ".join(parts)
    return f"""docs AS ({source}), matches AS ({every}),
  placed AS (SELECT doc_id, source, entity_type, score, unnest(range(1, len(m) + 1)) AS i, m, g FROM matches),
  spans AS (SELECT doc_id, source, entity_type, score, m[i] AS value,
      CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS INTEGER) AS start
    FROM placed),
  valid AS (SELECT *, start + length(value) AS stop, replace(replace(value, ' ', ''), '-', '') AS n FROM spans
    WHERE (entity_type <> 'CREDIT_CARD' OR (SELECT {_LUHN} FROM (SELECT replace(replace(value, ' ', ''), '-', '') AS n)))
    AND CASE WHEN entity_type = 'MEDICAL_LICENSE' THEN {_DEA} ELSE true END),
  kept AS (SELECT * FROM valid a WHERE NOT EXISTS (SELECT 1 FROM valid b WHERE b.doc_id = a.doc_id AND b.start < a.stop
    AND a.start < b.stop AND (b.score > a.score OR (b.score = a.score AND b.stop - b.start > a.stop - a.start)))),
  firsts AS (SELECT norm, entity_type, value, doc_id, start, row_number() OVER (PARTITION BY entity_type ORDER BY doc_id, start DESC, norm) AS n
    FROM (SELECT lower(trim(value)) AS norm, entity_type, value, doc_id, start,
        row_number() OVER (PARTITION BY lower(trim(value)) ORDER BY doc_id, start DESC) AS r FROM kept) WHERE r = 1)"""


@query(f"WITH {_spans_sql()} SELECT doc_id, entity_type, start, stop AS \"end\", CAST(score AS DOUBLE) AS score, value AS text FROM kept")
def detected_spans(spark: SparkSession, d: str) -> DataFrame:
    """Every stray value with its place, over whole texts."""
    return explode_spans(detect_pii(table(spark, d, "documents"), "text"), "doc_id") \
        .select("doc_id", "s.entity_type", "s.start", "s.end", "s.score", "s.text")


@query(f"WITH {_spans_sql()} SELECT source, entity_type, COUNT(*) AS detections, COUNT(DISTINCT lower(trim(value))) AS distinct_values "
       "FROM kept GROUP BY 1, 2")
def detections_by_source(spark: SparkSession, d: str) -> DataFrame:
    return pii_summary(detect_pii(table(spark, d, "documents"), "text"), ["source"])


@query(f"WITH {_spans_sql()} SELECT entity_type, COUNT(*) AS detections, COUNT(DISTINCT lower(trim(value))) AS distinct_values "
       "FROM kept WHERE entity_type IN ('EMAIL_ADDRESS', 'IP_ADDRESS') GROUP BY 1")
def detections_of_chosen_types(spark: SparkSession, d: str) -> DataFrame:
    """An explicit list of types replaces the default one."""
    return pii_summary(detect_pii(table(spark, d, "documents"), "text",
                                  types=["EMAIL_ADDRESS", "IP_ADDRESS", "DATE_TIME"]))


@query(f"WITH {_spans_sql()} SELECT '<' || entity_type || '_' || n || '>' AS alias, value, entity_type, n, norm, "
       "(SELECT COUNT(*) FROM kept k WHERE lower(trim(k.value)) = norm) AS sightings FROM firsts")
def detection_tokens(spark: SparkSession, d: str) -> DataFrame:
    """One token per value, numbered by its first sighting."""
    return assign_tokens(detect_pii(table(spark, d, "documents"), "text"), "doc_id").df


@query(f"""WITH {_spans_sql()}, named AS (SELECT k.doc_id, k.start, k.stop, '<' || f.entity_type || '_' || f.n || '>' AS alias
    FROM kept k JOIN firsts f ON f.norm = lower(trim(k.value))),
  per_doc AS (SELECT doc_id, list(start ORDER BY start) AS b, list(stop ORDER BY start) AS e, list(alias ORDER BY start) AS a FROM named GROUP BY 1)
  SELECT documents.doc_id, CASE WHEN a IS NULL THEN text ELSE array_to_string(list_transform(range(1, len(a) + 1), lambda i:
      substring(text, CAST(CASE WHEN i = 1 THEN 1 ELSE e[i-1] + 1 END AS BIGINT), CAST(b[i] - CASE WHEN i = 1 THEN 0 ELSE e[i-1] END AS BIGINT)) || a[i]), '')
      || substring(text, CAST(e[-1] + 1 AS BIGINT)) END AS text
  FROM documents LEFT JOIN per_doc ON per_doc.doc_id = documents.doc_id""")
def replaced_documents(spark: SparkSession, d: str) -> DataFrame:
    detected = detect_pii(table(spark, d, "documents").select("doc_id", "text"), "text")
    return replace_spans(detected, "text", assign_tokens(detected, "doc_id"))


@query("SELECT doc_id, text FROM documents")
def restored_documents(spark: SparkSession, d: str) -> DataFrame:
    """Tokens put in and taken out again give the text back.

    Values that share a token differ at most in case; none of the documents has such.
    """
    detected = detect_pii(table(spark, d, "documents").select("doc_id", "text"), "text")
    tokens = assign_tokens(detected, "doc_id")
    return restore_text(replace_spans(detected, "text", tokens), "text", tokens.df.select("alias", "value"))


_NOTES = ("SELECT o_orderkey AS doc_id, 'none' AS source, 'Note by ' || clients.alias || ': mail user' || o_custkey || '@corp.example.com, ' || "
          "'host 10.0.' || (o_orderkey % 250) || '.7, id ba67bb89' AS text FROM orders JOIN customer ON c_custkey = o_custkey "
          "JOIN clients ON norm = lower(c_name)")


@query(f"""WITH {ALIASES}, {_spans_sql(_NOTES)}, mails AS (SELECT * FROM firsts WHERE entity_type = 'EMAIL_ADDRESS'),
  hosts AS (SELECT * FROM firsts WHERE entity_type = 'IP_ADDRESS')
  SELECT o_orderkey AS doc_id, 'Note by ' || clients.alias || ': mail <EMAIL_ADDRESS_' || mails.n || '>, host <IP_ADDRESS_' || hosts.n || '>, id ba67bb89' AS text
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN clients ON clients.norm = lower(c_name)
  JOIN mails ON mails.norm = 'user' || o_custkey || '@corp.example.com' JOIN hosts ON hosts.norm = '10.0.' || (o_orderkey % 250) || '.7'""")
def anonymized_notes(spark: SparkSession, d: str) -> DataFrame:
    """Both passes over ticket notes: dictionary names first, then stray values."""
    return anonymize(_notes(spark, d), "text", "doc_id", desk_registry(spark, d)).df


@query(f"WITH {ALIASES}, {_spans_sql(_NOTES)} SELECT alias, value, 'registry' AS source FROM registry UNION ALL "
       "SELECT '<' || entity_type || '_' || n || '>', value, 'detection' FROM firsts")
def mapping_saved_with_masking(spark: SparkSession, d: str) -> DataFrame:
    """The mapping that masking left behind, read back from its session."""
    store = MappingStore(spark, f"{scratch_root(spark)}/maskmetrics/sessions-{uuid.uuid4().hex}")
    session = new_session()
    anonymize_and_save(_notes(spark, d), "text", "doc_id", desk_registry(spark, d), store, session)
    return store.load(session).select("alias", "value", "source")


def _notes(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    text = F.concat(F.lit("Note by "), "c_name", F.lit(": mail user"), F.col("o_custkey").cast("string"),
                    F.lit("@corp.example.com, host 10.0."), (F.col("o_orderkey") % 250).cast("string"), F.lit(".7, id ba67bb89"))
    return table(spark, d, "orders").join(customers, "o_custkey").select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))


@query(f"WITH {ALIASES}, {_spans_sql()} SELECT alias, value, 'registry' AS source FROM registry UNION ALL "
       "SELECT '<' || entity_type || '_' || n || '>', value, 'detection' FROM firsts")
def full_alias_mapping(spark: SparkSession, d: str) -> DataFrame:
    tokens = assign_tokens(detect_pii(table(spark, d, "documents"), "text"), "doc_id")
    return full_mapping(desk_registry(spark, d), tokens)


@query(f"WITH {ALIASES}, {_spans_sql()} SELECT true AS enabled, (SELECT COUNT(*) FROM registry) AS registry_entities, "
       "(SELECT COUNT(*) FROM firsts) AS detections, false AS degraded")
def anonymization_status(spark: SparkSession, d: str) -> DataFrame:
    tokens = assign_tokens(detect_pii(table(spark, d, "documents"), "text"), "doc_id")
    return registry_stats(desk_registry(spark, d), tokens.df).drop("warnings")


@query("""SELECT item, kind, (trim(item) = '' OR lower(trim(item)) IN ('urgent', 'high', 'medium', 'low', 'ticket', 'may')
    OR regexp_matches(item, '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$')
    OR (regexp_matches(item, '^[0-9a-fA-F]{8,}$') AND regexp_matches(item, '[a-fA-F]'))
    OR (kind <> 'PHONE_NUMBER' AND regexp_matches(item, '^[0-9][0-9T.,:/ -]*$')) OR regexp_matches(item, '^[pP][1-4]-')) AS false_positive
  FROM (SELECT unnest([CAST(o_orderkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), substr(o_orderpriority, 3), 'P' || substr(o_orderpriority, 1, 1) || '-x',
      substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 12), ' May ', 'Project ' || o_orderkey]) AS item,
    CASE WHEN o_orderkey % 2 = 0 THEN 'PHONE_NUMBER' ELSE 'PERSON' END AS kind FROM orders)""")
def screened_detections(spark: SparkSession, d: str) -> DataFrame:
    """Values that a detector may report, and whether they are clearly not personal."""
    order = F.col("o_orderkey").cast("string")
    items = F.array(order, F.date_format("o_orderdate", "yyyy-MM-dd"), F.substring("o_orderpriority", 3, 20),
                    F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1), F.lit("-x")),
                    F.substring(F.md5(order.cast("binary")), 1, 12), F.lit(" May "), F.concat(F.lit("Project "), order))
    kind = F.when(F.col("o_orderkey") % 2 == 0, "PHONE_NUMBER").otherwise("PERSON")
    rows = table(spark, d, "orders").select(F.explode(items).alias("item"), kind.alias("kind"))
    return rows.select("item", "kind", is_false_positive("item", "kind").alias("false_positive"))


def _find_quoted(texts: list[str]) -> list[list[tuple[int, int, str, float]]]:
    """A plug-in for the query below: names in guillemets; one kind of text breaks it."""
    import re
    if any("broken" in t for t in texts):
        raise ValueError("cannot read this text")
    return [[(m.start(), m.end(), "PERSON", 0.9) for m in re.finditer("«[^»]+»", t)] for t in texts]


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS persons, CASE WHEN c_custkey % 7 = 0 "
       "THEN 'ValueError: cannot read this text' END AS error FROM customer")
def plugin_detections(spark: SparkSession, d: str) -> DataFrame:
    """A detector outside Spark: a text that it cannot read loses only its own spans."""
    broken = F.when(F.col("c_custkey") % 7 == 0, " broken").otherwise("")
    notes = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("by «"), "c_name", F.lit("»"), broken).alias("note"))
    found = detect_pii(notes, "note", plugin=PluginDetector("quoted", _find_quoted), errors="error")
    return found.select("c_custkey", F.size("spans").alias("persons"), "error")


# Published addresses with valid checksums; with their last character changed they have none.
ADDRESSES = ("1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "3J98t1WpEZ73CNmQviecrnyiWrnqRhWNLy", "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4",
             "bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj0")
# Text before and behind a value of an order, and the type and score that are found there, if any.
_CASES = (("pay to ", "address", "", "CRYPTO", 1.0), ("pay to ", "wrong", "", None, 0.0), ("from the account with number ", "number", " today", "US_BANK_NUMBER", 0.75),
          ("on the counter with number ", "number", " today", None, 0.0), ("Passport: ", "passport", ", seen", "US_PASSPORT", 0.75),
          ("Part ", "passport", ", seen", None, 0.0), ("driver's license (CA) ", "licence", "", "US_DRIVER_LICENSE", 0.75),
          ("account, as you said when we met, ", "number", "", None, 0.0))


def _cased_values(key: Column) -> dict[str, Column]:
    text, address = key.cast("string"), F.get(F.array(*map(F.lit, ADDRESSES)), (F.floor(key / 8) % len(ADDRESSES)).cast("int"))
    return {"address": address, "wrong": F.concat(F.substring(address, F.lit(1), F.char_length(address) - 1), F.lit("z")),
            "number": F.concat(F.lit("9"), F.lpad(text, 9, "0")), "passport": F.concat(F.lit("X"), F.lpad(text, 8, "0")),
            "licence": F.concat(F.lit("Y"), F.lpad(text, 7, "0"))}


def _context_notes(orders: DataFrame) -> DataFrame:
    values = _cased_values(F.col("o_orderkey"))
    said = F.array(*(F.concat(F.lit(a), values[v], F.lit(b)) for a, v, b, _, _ in _CASES))
    return orders.select("o_orderkey", F.get(said, (F.col("o_orderkey") % len(_CASES)).cast("int")).alias("text"))


def _context_sql() -> str:
    address = "[" + ", ".join(f"'{a}'" for a in ADDRESSES) + f"][CAST(o_orderkey // 8 % {len(ADDRESSES)} AS INTEGER) + 1]"
    values = {"address": address, "wrong": "''", "number": "'9' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')", "passport": "'X' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0')",
              "licence": "'Y' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0')"}
    return " UNION ALL ".join(
        f"SELECT o_orderkey, '{kind}' AS entity_type, CAST({len(a)} AS INTEGER) AS start, CAST({len(a)} + length({values[v]}) AS INTEGER) AS \"end\", "
        f"CAST({score} AS DOUBLE) AS score, {values[v]} AS text FROM orders WHERE o_orderkey % {len(_CASES)} = {i}"
        for i, (a, v, b, kind, score) in enumerate(_CASES) if kind)


@query(_context_sql())
def values_with_checksum_or_context(spark: SparkSession, d: str) -> DataFrame:
    """Wallet addresses by their checksums; bank, passport and licence numbers only where the words before them say so."""
    spans = explode_spans(detect_pii(_context_notes(table(spark, d, "orders")), "text"), "o_orderkey")
    return spans.select("o_orderkey", "s.entity_type", "s.start", "s.end", "s.score", "s.text")
