"""Names of the dictionary in layouts that exact matching does not know."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from maskmetrics.operators.broken_names import find_broken, mask_broken
from maskmetrics.operators.masking import mask_text
from maskmetrics.operators.registry import Registry, SensitiveColumn, build_registry
from maskmetrics.plans.facts import table
from maskmetrics.plans.registered import query

# A name for every customer key: a syllable for each digit. Any two differ in two letters at least.
SYLLABLES = ("bax", "del", "fin", "gos", "hut", "jam", "kep", "lir", "mon", "nud")


def _syllables(digits: Column) -> Column:
    for digit, syllable in enumerate(SYLLABLES):
        digits = F.replace(digits, F.lit(str(digit)), F.lit(syllable))
    return F.initcap(digits)


def _named(df: DataFrame, key: str) -> DataFrame:
    """Add ``first`` and ``last``, the two words of the name that belongs to a customer key."""
    digits = F.lpad(F.col(key).cast("string"), 6, "0")
    return df.withColumn("first", _syllables(F.substring(digits, 1, 3))).withColumn("last", _syllables(F.substring(digits, 4, 3)))


def name_registry(spark: SparkSession, d: str) -> Registry:
    names = _named(table(spark, d, "customer"), "c_custkey").select(F.concat_ws(" ", "first", "last").alias("name"))
    return build_registry(spark, [SensitiveColumn("client", "names", "name")], {"names": names})


def _broken_notes(spark: SparkSession, d: str) -> DataFrame:
    """One note per order, its customer's name in one of eight layouts."""
    rows = _named(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey")
    head, tail = F.substring("last", 1, 3), F.substring("last", 4, 6)
    forms = F.array(
        F.concat("first", F.lit("\n"), "last"), F.concat("first", F.lit(" "), head, F.lit("-\n"), tail), F.concat_ws("-", "first", "last"),
        F.concat(F.lower("first"), F.lit("."), F.lower("last"), F.lit("@example.com")), F.concat(F.lit("srv-"), F.upper(F.concat("first", "last")), F.lit("-01")),
        F.concat("first", F.lit(" "), F.substring("last", 1, 4), F.lit("z"), F.substring("last", 6, 4)), F.concat("first", F.lit(" "), F.substring("last", 2, 8)),
        F.concat_ws(" ", "first", "last"))
    return rows.select("o_orderkey", F.concat(F.lit("Seen: "), F.get(forms, (F.col("o_orderkey") % 8).cast("int")), F.lit(" in order "),
                                              F.col("o_orderkey").cast("string"), F.lit(".")).alias("text"))


def _syllables_sql(digits: str) -> str:
    for digit, syllable in enumerate(SYLLABLES):
        digits = f"replace({digits}, '{digit}', '{syllable}')"
    return f"upper(({digits})[1]) || ({digits})[2:]"


_BROKEN = f"""named AS (SELECT c_custkey, {_syllables_sql("lpad(CAST(c_custkey AS VARCHAR), 6, '0')[1:3]")} AS f,
    {_syllables_sql("lpad(CAST(c_custkey AS VARCHAR), 6, '0')[4:6]")} AS l FROM customer),
  clients AS (SELECT c_custkey, f, l, CASE WHEN n <= 26 THEN 'Client_' || chr(CAST(64 + n AS INTEGER)) ELSE 'Client_' || n END AS alias
    FROM (SELECT *, row_number() OVER (ORDER BY lower(f || ' ' || l)) AS n FROM named)),
  notes AS (SELECT o_orderkey, alias, f || ' ' || l AS name, CASE o_orderkey % 8 WHEN 0 THEN f || chr(10) || l WHEN 1 THEN f || ' ' || l[1:3] || '-' || chr(10) || l[4:9]
      WHEN 2 THEN f || '-' || l WHEN 3 THEN lower(f) || '.' || lower(l) WHEN 4 THEN upper(f || l) WHEN 5 THEN f || ' ' || l[1:4] || 'z' || l[6:9]
      WHEN 6 THEN f || ' ' || l[2:9] ELSE f || ' ' || l END AS form,
    CASE o_orderkey % 8 WHEN 4 THEN 'srv-' ELSE '' END AS before, CASE o_orderkey % 8 WHEN 3 THEN '@example.com' WHEN 4 THEN '-01' ELSE '' END AS behind
    FROM orders JOIN clients ON c_custkey = o_custkey)"""


@query(f"WITH {_BROKEN} SELECT o_orderkey, CAST(6 + length(before) AS INTEGER) AS start, CAST(6 + length(before) + length(form) AS INTEGER) AS \"end\", alias, form AS text, "
       "CAST(levenshtein(regexp_replace(lower(form), '[^a-z]', '', 'g'), regexp_replace(lower(name), '[^a-z]', '', 'g')) AS INTEGER) AS edits FROM notes")
def broken_names_found(spark: SparkSession, d: str) -> DataFrame:
    """Wrapped, hyphenated, run together, in an address or a host name, one letter wrong or missing: all are found."""
    found = find_broken(_broken_notes(spark, d), "text", name_registry(spark, d), "s")
    return found.select("o_orderkey", F.explode("s").alias("s")).select("o_orderkey", "s.start", "s.end", "s.alias", "s.text", "s.edits")


@query(f"WITH {_BROKEN} SELECT o_orderkey, 'Seen: ' || before || alias || behind || ' in order ' || o_orderkey || '.' AS text FROM notes")
def broken_names_masked(spark: SparkSession, d: str) -> DataFrame:
    """The registered form by the dictionary, what a layout has broken by the pass behind it."""
    registry = name_registry(spark, d)
    return mask_broken(mask_text(_broken_notes(spark, d), "text", registry), "text", registry)


@query(f"WITH {_BROKEN} SELECT COUNT(*) AS documents, 0 AS finds FROM documents")
def broken_names_in_documents(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents, in which no client is named, through the same search: nothing is found in them."""
    found = find_broken(table(spark, d, "documents").select("doc_id", "text"), "text", name_registry(spark, d), "s")
    return found.agg(F.count("*").alias("documents"), F.coalesce(F.sum(F.size("s")), F.lit(0)).alias("finds"))
