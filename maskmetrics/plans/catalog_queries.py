"""Column classification, model definitions and line search on the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskmetrics.functions.columns import classify_column, classify_unprotected_column, normalize_column_name
from maskmetrics.operators.catalog import (
    coverage_missing, decode_parts, definition_text, detect_sensitive_columns, detect_unprotected_columns, list_catalog, list_named,
    part_text, schema_columns, search_with_context, unprotected_warnings)
from maskmetrics.operators.registry import SensitiveColumn, build_registry
from maskmetrics.plans.facts import table
from maskmetrics.plans.registered import query

# Column names are put together from two words that depend on the row.
_FIRST = ("company", "Resource", "primary_contact", "email", "job", "ticket", "Account", "technician")
_SECOND = ("Name", "_address", "_id", "_title", "Notes", "_phone", "_role", "_description", "")


def _pick(words: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (number % len(words) + 1).cast("int"))


def _column_name(number: Column) -> Column:
    return F.concat(_pick(_FIRST, number), _pick(_SECOND, F.floor(number / 3)))


def _sql_pick(words: tuple[str, ...], number: str) -> str:
    return f"list_extract([{', '.join(repr(w) for w in words)}], CAST(({number}) % {len(words)} + 1 AS INTEGER))"


_NAME = f"{_sql_pick(_FIRST, 'p_partkey')} || {_sql_pick(_SECOND, 'p_partkey // 3')}"
_WORDS = ("trim(regexp_replace(lower(regexp_replace({c}, '([a-z0-9])([A-Z])', '\\1 \\2', 'g')), '[^a-z0-9]+', ' ', 'g'))")


def _has(words: str, *wanted: str) -> str:
    return f"list_has_any(string_split({words}, ' '), [{', '.join(repr(w) for w in wanted)}])"


_CLASS = (f"CASE WHEN {_has('w', 'name', 'email', 'phone', 'address')} THEN CASE WHEN {_has('w', 'company', 'account')} "
          f"THEN 'client' WHEN {_has('w', 'resource', 'technician', 'employee')} THEN 'resource' "
          f"WHEN {_has('w', 'contact', 'email', 'phone', 'address')} OR contains(' ' || w || ' ', ' first name ') "
          "OR contains(' ' || w || ' ', ' last name ') OR contains(' ' || w || ' ', ' full name ') THEN 'contact' END END")
_FAMILY = (f"CASE WHEN {_has('w', 'role', 'specialty', 'speciality', 'jobtitle', 'department', 'sector', 'industry')} "
           "OR contains(w, 'job title') THEN 'descriptive' "
           f"WHEN {_has('w', 'description', 'desc', 'note', 'notes', 'comment', 'summary', 'subject', 'title', 'body', 'detail', 'details', 'resolution')} "
           "THEN 'free_text' END")
_NAMED = f"(SELECT *, {_WORDS.format(c='name')} AS w FROM (SELECT p_partkey, p_brand, {_NAME} AS name FROM part))"


@query(f"SELECT p_partkey, name, w AS words, {_CLASS} AS category, {_FAMILY} AS family FROM {_NAMED}")
def classified_columns(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "part").select("p_partkey", _column_name(F.col("p_partkey")).alias("name"))
    return named.select("p_partkey", "name", normalize_column_name("name").alias("words"),
                        classify_column("name").alias("category"),
                        classify_unprotected_column("name").alias("family"))


def model_parts(spark: SparkSession, d: str) -> DataFrame:
    """One part per row of ``part``: its table, two columns and two measures, as base64.

    Some payloads are of another type, empty or not base64 at all.
    """
    k = F.col("p_partkey")
    name = F.concat(_pick(("BI_", "Dim_", "Fact_"), k), F.regexp_replace("p_brand", "#", ""))
    path = F.concat(F.lit("definition/tables/"), name, F.when(k % 2 == 0, ".tmdl").otherwise("/columns.tmdl"))
    text = F.concat(F.lit("table x\n\tcolumn '"), _column_name(k), F.lit("'\n  column "), _column_name(k + 5),
                    F.lit("\n\tmeasure 'Total "), "p_type", F.lit("' = 1\n  Measure m_"), "p_brand", F.lit(" = 2\n"))
    payload = F.when(k % 11 == 0, F.lit("")).when(k % 13 == 0, F.lit("a")) \
        .otherwise(F.base64(F.encode(text, "UTF-8")))
    kind = F.when(k % 7 == 0, F.lit("Reference")).otherwise(F.lit("InlineBase64"))
    return table(spark, d, "part").select(k.alias("part_no"), path.alias("path"), payload.alias("payload"),
                                          kind.alias("payload_type"))


_PARTS = f"""parts AS (SELECT p_partkey AS part_no, {_sql_pick(('BI_', 'Dim_', 'Fact_'), 'p_partkey')} || replace(p_brand, '#', '') AS tab,
  'definition/tables/' || {_sql_pick(('BI_', 'Dim_', 'Fact_'), 'p_partkey')} || replace(p_brand, '#', '')
    || CASE WHEN p_partkey % 2 = 0 THEN '.tmdl' ELSE '/columns.tmdl' END AS path,
  {_NAME} AS c1, {_NAME.replace('p_partkey', '(p_partkey + 5)')} AS c2, p_type, p_brand
  FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 7 <> 0)"""
_LISTED = "(SELECT part_no, tab, c1 AS col FROM parts UNION ALL SELECT part_no, tab, c2 FROM parts)"


@query(f"WITH {_PARTS} SELECT part_no, '--- ' || path || ' ---' || chr(10) || 'table x' || chr(10) || chr(9) || 'column ''' || c1 || '''' || chr(10) "
       "|| '  column ' || c2 || chr(10) || chr(9) || 'measure ''Total ' || p_type || ''' = 1' || chr(10) || '  Measure m_' || p_brand "
       "|| ' = 2' || chr(10) AS text FROM parts")
def decoded_parts(spark: SparkSession, d: str) -> DataFrame:
    return decode_parts(model_parts(spark, d)).select("part_no", part_text().alias("text"))


@query(f"WITH {_PARTS} SELECT part_no, tab AS \"table\", col AS \"column\" FROM {_LISTED}")
def model_columns(spark: SparkSession, d: str) -> DataFrame:
    return schema_columns(decode_parts(model_parts(spark, d)))


@query(f"WITH {_PARTS} SELECT DISTINCT {_CLASS} AS category, tab AS \"table\", col AS \"column\" FROM "
       f"(SELECT *, {_WORDS.format(c='col')} AS w FROM {_LISTED}) WHERE tab NOT LIKE 'Fact%' AND ({_CLASS}) IS NOT NULL")
def sensitive_columns(spark: SparkSession, d: str) -> DataFrame:
    return detect_sensitive_columns(model_columns(spark, d))


@query(f"WITH {_PARTS} SELECT DISTINCT {_FAMILY} AS family, tab AS \"table\", col AS \"column\" FROM "
       f"(SELECT *, {_WORDS.format(c='col')} AS w FROM {_LISTED}) WHERE ({_FAMILY}) IS NOT NULL")
def unprotected_columns(spark: SparkSession, d: str) -> DataFrame:
    return unprotected_warnings(detect_unprotected_columns(model_columns(spark, d))).drop("warning")


@query(f"WITH {_PARTS} SELECT 'Total ' || p_type AS name FROM parts UNION SELECT 'm_' || p_brand FROM parts")
def model_measures(spark: SparkSession, d: str) -> DataFrame:
    return list_named(decode_parts(model_parts(spark, d)))


@query("""WITH RECURSIVE docs AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE contains(lower(text), 'the')),
  hits AS (SELECT doc_id, lines, list_filter(list_transform(range(1, len(lines) + 1), lambda i: CASE WHEN contains(lower(lines[i]), 'the') THEN i END),
    lambda i: i IS NOT NULL) AS h FROM docs),
  sweep AS (SELECT doc_id, lines, h, h[1] AS line_number, 1 AS no FROM hits
    UNION ALL SELECT doc_id, lines, h, list_filter(h, lambda i: i - line_number > 4)[1], no + 1 FROM sweep
    WHERE len(list_filter(h, lambda i: i - line_number > 4)) > 0),
  found AS (SELECT doc_id, COUNT(*) AS found FROM sweep GROUP BY 1)
  SELECT doc_id, no AS match_no, line_number, found, trim(lines[line_number], ' ') AS match_line,
    array_to_string(lines[greatest(line_number - 2, 1):line_number + 2], chr(10)) AS context
  FROM sweep JOIN found USING (doc_id) WHERE no <= 3""")
def searched_documents(spark: SparkSession, d: str) -> DataFrame:
    """Term search by line with two lines around each hit, three hits per document."""
    return search_with_context(table(spark, d, "documents"), "doc_id", "text", "THE", context=2, limit=3)


@query("SELECT 'Dataset_' || n.rn AS name, p_partkey AS id, 'Contact_' || o.rn AS owner FROM part "
       "JOIN (SELECT DISTINCT p_name, dense_rank() OVER (ORDER BY p_name) AS rn FROM part) n USING (p_name) "
       "JOIN (SELECT DISTINCT p_brand, dense_rank() OVER (ORDER BY lower(p_brand)) AS rn FROM part) o USING (p_brand)")
def masked_catalog_listing(spark: SparkSession, d: str) -> DataFrame:
    """Names and owners of a listing are registered and aliased, ids are not."""
    registry = build_registry(spark, [SensitiveColumn("client", "customer", "c_name")],
                              {"customer": table(spark, d, "customer")})
    listing = table(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id"),
                                             F.col("p_brand").alias("owner"))
    return list_catalog(listing, registry, "dataset", "name", "owner")[0]


@query("SELECT conv_id, string_agg('--- turn/' || turn || ' ---' || chr(10) || text, chr(10) || chr(10) ORDER BY turn) AS text "
       "FROM conversations GROUP BY 1")
def definition_texts(spark: SparkSession, d: str) -> DataFrame:
    """Parts put together to one text per model; a conversation's turns are the parts."""
    parts = table(spark, d, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("turn/"), F.col("turn").cast("string")).alias("path"),
        F.base64(F.encode("text", "UTF-8")).alias("payload"), F.lit("InlineBase64").alias("payload_type"))
    return definition_text(decode_parts(parts), "conv_id", "turn")


# Which columns of a table are configured as names.
_CONFIGURED = {"customer": ("c_name",), "supplier": ("s_name",), "part": (), "orders": ()}


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, {'true' if not c else 'false'} AS unprotected, COUNT(*) AS rows FROM {t}" for t, c in _CONFIGURED.items()))
def tables_without_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Tables that would leave with their real names, for nothing is configured for them, and the rows that this concerns."""
    counts = None
    for name, columns in _CONFIGURED.items():
        missing = coverage_missing([SensitiveColumn("client", name, c) for c in columns])
        one = table(spark, d, name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), F.lit(missing).alias("unprotected"), "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts
