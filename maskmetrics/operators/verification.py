"""Checking the numbers a report states against the results of its queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T, Window

from maskmetrics.functions.claims import at_precision, format_claim, numeric_cell, parse_numbers
from maskmetrics.functions.panels import read_panels
from maskmetrics.functions.text import bind, strip
from maskmetrics.operators.lookup import hot_join
from maskmetrics.operators.restoring import rewrite_alias_literals
from maskmetrics.session import settle, ship, spread_small

# How result comments and statements start.
RESULT_LINE = r"(?iU)^\s*--\s*(?:Result|Resultaat)\s*:\s*(.*)$"
STATEMENT_LINE = r"(?iU)^\s*(DEFINE|EVALUATE)(?![\w])"

RESULT_SCHEMA = "query_id string, row_no long, col_no int, col string, value double"
ERROR_SCHEMA = "query_id string, message string"


# --- from reports to panels with claims ----------------------------------------------

def extract_panels(reports: DataFrame, key: str = "report_id", html: str = "html") -> DataFrame:
    """(key, panel_no, family, label, body): one row per query panel of a report."""
    ship(reports.sparkSession)
    key_type = reports.schema[key].dataType.simpleString()

    def parse(batches):
        for batch in batches:
            rows = [(k, i, *panel) for k, text in zip(batch[key], batch[html])
                    for i, panel in enumerate(read_panels(text))]
            yield pd.DataFrame(rows, columns=[key, "panel_no", "family", "label", "body"])

    candidates = reports.select(key, html).where(F.col(html).rlike("(?i)<pre"))
    return spread_small(candidates).mapInPandas(
        parse, f"{key} {key_type}, panel_no int, family string, label string, body string")


def split_statements(body: Column | str) -> Column:
    """One text per statement of a panel, as array<string>.

    A DEFINE starts a statement; an EVALUATE does unless the keyword line before it is a
    DEFINE. Lines before the first keyword go with it, comments with the line they follow.
    """
    body = F.col(body) if isinstance(body, str) else body

    def keyword_lines(lines: Column) -> Column:
        return F.filter(F.transform(lines, lambda line, i: F.struct(
            i.alias("at"), F.upper(F.regexp_extract(line, STATEMENT_LINE, 1)).alias("word"))),
            lambda k: k["word"] != "")

    def starts(words: Column) -> Column:
        before = F.concat(F.array(F.lit("EVALUATE")), F.transform(words, lambda k: k["word"]))
        marked = F.zip_with(words, before, lambda k, b: F.when(
            (k["word"] == "DEFINE") | ((k["word"] == "EVALUATE") & (b == "EVALUATE")), k["at"]))
        return F.filter(marked, lambda at: at.isNotNull())

    def cut(lines: Column, at: Column) -> Column:
        later = F.slice(at, F.lit(2), F.size(at))
        begins, ends = F.concat(F.array(F.lit(0)), later), F.concat(later, F.array(F.size(lines)))
        parts = F.zip_with(begins, ends, lambda b, e: F.array_join(F.slice(lines, b + 1, e - b), "\n"))
        return F.when(F.size(at) <= 1, F.array(body)).otherwise(parts)

    return bind(F.split(body, "\n"), lambda lines: bind(
        bind(keyword_lines(lines), starts), lambda at: cut(lines, at)))


def statement_panels(panels: DataFrame, key: str = "report_id") -> DataFrame:
    """(key, panel_no, statement_no, section, family, query, expected) per statement."""
    # The outer form: the planner adds a test to the other one, which works out the parts twice more. There is a part always.
    split = panels.select(key, "panel_no", "family", "label", split_statements("body").alias("parts"))
    each = split.select(key, "panel_no", "family", "label", F.size("parts").alias("n"),
                        F.posexplode_outer("parts").alias("statement_no", "part"))
    lines = F.split("part", "\n")
    stated = F.filter(lines, lambda x: x.rlike(RESULT_LINE))
    claims = F.flatten(F.transform(stated, lambda x: parse_numbers(F.regexp_extract(x, RESULT_LINE, 1))))
    query = strip(F.array_join(F.filter(lines, lambda x: ~x.rlike(RESULT_LINE)), "\n"))
    place = F.concat(F.lit(" ("), (F.col("statement_no") + 1).cast("string"), F.lit("/"),
                     F.col("n").cast("string"), F.lit(")"))
    section = F.concat("label", F.when(F.col("n") > 1, place).otherwise(""))
    return each.select(key, "panel_no", "statement_no", section.alias("section"), "family",
                       query.alias("query"), claims.alias("expected")).where("query != ''")


def report_panels(reports: DataFrame, key: str = "report_id", html: str = "html") -> DataFrame:
    return statement_panels(extract_panels(reports, key, html), key)


def rewrite_panel_aliases(panels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Panels whose query literals hold real values, with the count of aliases replaced."""
    done = rewrite_alias_literals(panels, "query", mapping, rewritten="_query", count="aliases_rewritten")
    return done.drop("query").withColumnRenamed("_query", "query")


# --- results in long form --------------------------------------------------------------

def flatten_results(df: DataFrame, query_id: Column | str, row_no: Column | str,
                    columns: list[str] | None = None) -> DataFrame:
    """Every numeric cell of a result: null counts as 0, booleans are left out, numeric
    texts are read."""
    columns = columns or df.columns
    cells = []
    for i, name in enumerate(columns):
        c, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, T.NumericType):
            value = F.coalesce(c.cast("double"), F.lit(0.0))
        elif isinstance(kind, T.StringType):
            value = numeric_cell(c)
        else:
            value = F.when(c.isNull(), 0.0)
        cells.append(F.struct(F.lit(i).alias("col_no"), F.lit(name).alias("col"), value.alias("value")))
    query_id = F.col(query_id) if isinstance(query_id, str) else query_id
    row_no = F.col(row_no) if isinstance(row_no, str) else row_no
    return df.select(query_id.cast("string").alias("query_id"), row_no.cast("long").alias("row_no"),
                     F.explode(F.array(*cells)).alias("c")) \
        .select("query_id", "row_no", "c.col_no", "c.col", "c.value").where(F.col("value").isNotNull())


def column_totals(results: DataFrame) -> DataFrame:
    """(query_id, col, total): what a report may state as the sum of a column."""
    return results.groupBy("query_id", "col").agg(F.sum("value").alias("total"))


def run_panels(spark: SparkSession, named: Mapping[str, Callable[[SparkSession], DataFrame]]
               ) -> tuple[DataFrame, DataFrame]:
    """Run each named query once; its name is the query id of the panels that carry it.

    A query that fails becomes an error row. The loop is over the queries someone wrote
    down, not over data.
    """
    results = spark.createDataFrame([], RESULT_SCHEMA)
    errors = []
    for name, build in named.items():
        try:
            df = build(spark)
            rows = df.withColumn("_row", F.monotonically_increasing_id())
            results = results.unionByName(settle(flatten_results(rows, F.lit(name), "_row", df.columns), "result"))
        except Exception as e:
            errors.append((name, str(e).splitlines()[0]))
    return results, spark.createDataFrame(errors, ERROR_SCHEMA)


# --- matching --------------------------------------------------------------------------

def matched_claims(claims: DataFrame, results: DataFrame, out: str = "matched") -> DataFrame:
    """Flag claims that a returned value of their query equals at the shown precision.

    Values meet claims on (query, decimals, rounded value), so no claim is compared with
    all values of its query. A percentage also matches the fraction it stands for.
    """
    # Claims come out of parsed HTML: they are read twice and made once.
    return _matched(settle(claims, "claims"), settle(results.select("query_id", "value"), "values"), out)


def _matched(claims: DataFrame, results: DataFrame, out: str = "matched") -> DataFrame:
    """``matched_claims`` of tables that are cheap to read again."""
    shown = F.collect_set(F.struct("decimals", "is_percent"))
    wanted = claims.groupBy("query_id").agg(shown.alias("_shown"))
    values = results.select("query_id", "value").distinct()
    at_all = hot_join(values, wanted, ["query_id"], F.col("value"), "inner", results) \
        .select("query_id", "value", F.explode("_shown").alias("_as")).select("query_id", "value", "_as.*")
    forms = F.when(F.col("is_percent"), F.array("value", F.col("value") * 100)).otherwise(F.array("value"))
    keys = at_all.select("query_id", "decimals", "is_percent", F.explode(forms).alias("v")) \
        .select("query_id", "decimals", "is_percent", at_precision(F.col("v"), F.col("decimals")).alias("_unit")) \
        .distinct().withColumn(out, F.lit(True))
    keyed = claims.withColumn("_unit", at_precision(F.col("value"), F.col("decimals")))
    # Unique on the right; adaptive execution splits a claim that very many reports make.
    joined = keyed.join(keys, ["query_id", "decimals", "is_percent", "_unit"], "left")
    return joined.select(*claims.columns, F.coalesce(out, F.lit(False)).alias(out))


def derivable_claims(claims: DataFrame, totals: DataFrame) -> DataFrame:
    """Distinct (query_id, value, decimals) that are a column total of their query or the
    difference of two.

    For a claim v and a total a the other total lies near a - v or a + v; it is looked up
    by its rounded value, so pairs of totals are never listed.
    """
    # Both are read several times and made once.
    asked = settle(claims.select("query_id", "value", "decimals").distinct(), "asked")
    totals = settle(totals.select("query_id", "col", "total"), "totals")
    unit = at_precision(F.col("value"), F.col("decimals"))
    # A query that very many reports quote is one key: its claims are dealt over copies of its totals.
    with_total = hot_join(asked, totals.withColumnRenamed("col", "_col"), ["query_id"], F.struct("value", "decimals"), "inner")
    scale = F.pow(F.lit(10.0), F.col("decimals"))
    direct = with_total.where(at_precision(F.col("total"), F.col("decimals")) == unit)

    def slot(unit: Column) -> Column:
        # Four units share a slot: what lies one unit to either side is in one or two of them.
        return F.shiftright(unit, 2)

    near = F.explode(F.array_distinct(F.array(*(slot(F.floor((F.col("total") + side * F.col("value")) * scale) + step)
                                                for side in (-1, 1) for step in (-1, 1)))))
    probes = with_total.select("query_id", "value", "decimals", "total", "_col", near.alias("_slot"))
    precisions = asked.groupBy("query_id").agg(F.collect_set("decimals").alias("_decimals"))
    slots = hot_join(totals, precisions, ["query_id"], F.col("col"), "inner") \
        .select("query_id", "col", "total", F.explode("_decimals").alias("decimals")).select(
        "query_id", "decimals", F.col("col").alias("_other"), F.col("total").alias("_total"),
        slot(F.floor(F.col("total") * scale)).alias("_slot"))
    pairs = probes.join(slots, ["query_id", "decimals", "_slot"]).where(
        (F.col("_col") != F.col("_other"))
        & (at_precision(F.abs(F.col("total") - F.col("_total")), F.col("decimals")) == unit))
    columns = ["query_id", "value", "decimals"]
    return direct.select(*columns).unionByName(pairs.select(*columns)).distinct()


def diff_expected(claims: DataFrame, results: DataFrame) -> DataFrame:
    """Claims that no returned value matches."""
    return matched_claims(claims, results).where(~F.col("matched")).drop("matched")


def claim_rows(panels: DataFrame, key: list[str]) -> DataFrame:
    """One row per claim: (key.., query_id, claim_no, value, decimals, is_percent)."""
    # The outer form: the planner adds a test to the other one, which parses the claims twice more.
    return panels.select(*key, "query_id", F.posexplode_outer("expected").alias("claim_no", "c")) \
        .where(F.col("claim_no").isNotNull()).select(*key, "query_id", "claim_no", "c.value", "c.decimals", "c.is_percent")


def verify(panels: DataFrame, results: DataFrame, errors: DataFrame, key: list[str],
           strict_percent: bool = False, shown_values: int = 12) -> DataFrame:
    """PASS, FAIL or ERROR per panel.

    ``panels`` has ``key`` columns, query_id, section, family and expected (claims); other
    columns are carried along. A claim that is missing fails its panel, unless it is
    derivable; an unmatched percentage counts as derived unless ``strict_percent``. The
    message of a failed panel shows the first ``shown_values`` values of its query; the
    verdict rests on all of them.
    """
    # Panels come out of parsed HTML and results out of queries: both are needed several
    # times below and must not be computed again.
    panels, results = settle(panels, "panels"), settle(results, "results")
    claims = claim_rows(panels, key)
    flagged = settle(_matched(claims, results), "claims")
    open_claims = flagged.where(~F.col("matched") & ~F.col("is_percent"))
    # Summed first: partial sums leave one row per column, however large a result is.
    totals = column_totals(results).join(open_claims.select("query_id").distinct(), "query_id", "left_semi")
    derivable = derivable_claims(open_claims, totals).withColumn("_derivable", F.lit(True))
    judged = flagged.join(derivable, ["query_id", "value", "decimals"], "left")
    free_percent = F.lit(False) if strict_percent else F.col("is_percent")
    derived = ~F.col("matched") & (free_percent | (~F.col("is_percent") & F.coalesce("_derivable", F.lit(False))))
    text = format_claim(F.col("value"), F.col("decimals"), F.col("is_percent"))
    state = F.when(F.col("matched"), "matched").when(derived, "derived").otherwise("missing")

    def texts_of(name: str) -> Column:
        kept = F.filter("_claims", lambda c: c["state"] == name)
        return F.transform(kept, lambda c: c["text"])

    # The claims of one panel come from one text, so they fit in one row again.
    per_panel = judged.groupBy(*key).agg(F.array_sort(F.collect_list(
        F.struct("claim_no", text.alias("text"), state.alias("state")))).alias("_claims"))
    per_panel = per_panel.select(*key, F.transform("_claims", lambda c: c["text"]).alias("_expected"),
                                 texts_of("missing").alias("_missing"), texts_of("derived").alias("_derived"),
                                 F.size(texts_of("matched")).alias("_checked"))
    failing = panels.join(per_panel.where(F.size("_missing") > 0), key, "left_semi").select("query_id").distinct()
    # Cut to the values that can be shown before they meet the failing queries.
    shown = _first_values(results, shown_values).join(failing, "query_id", "left_semi")
    messages = errors.groupBy("query_id").agg(F.min("message").alias("_error"))
    notes = messages.join(shown, "query_id", "full")
    joined = hot_join(panels.join(per_panel, key, "left"), notes, ["query_id"], F.struct(*key), counted=panels)
    error, missing = F.col("_error").isNotNull(), F.size(F.coalesce("_missing", F.array())) > 0
    none = F.size("expected") == 0
    empty = F.array().cast("array<string>")
    # The texts of messages.
    counted = F.concat(F.col("_checked").cast("string"), F.lit(" value(s) match"), F.when(
        F.size("_derived") > 0, F.concat(
            F.lit("; "), F.size("_derived").cast("string"), F.lit(" derived, not directly queryable ("),
            F.array_join("_derived", ", "), F.lit(")"))).otherwise(""))
    # The texts of messages.
    failed = F.concat(F.lit("expected "), F.array_join("_missing", ", "), F.lit(" not in returned values ["),
                      F.coalesce(F.col("_shown"), F.lit("")), F.lit("]"))
    carried = [c for c in panels.columns if c != "expected"]
    return joined.select(
        *carried, F.coalesce("_expected", empty).alias("expected"),
        F.when(error, "ERROR").when(missing, "FAIL").otherwise("PASS").alias("status"),
        F.when(error, F.col("_error")).when(none, "ran, no expected values").when(missing, failed)
        .otherwise(counted).alias("detail"),
        F.when(error, F.lit(None).cast("boolean")).when(none, F.lit(False)).when(missing, F.lit(True))
        .otherwise(F.col("_checked") > 0).alias("value_checked"),
        F.when(~error, F.coalesce("_derived", empty)).alias("derived"))


def _first_values(results: DataFrame, n: int) -> DataFrame:
    """The first values of a result as text, for the message of a failed panel. Spark
    keeps at most ``n`` rows per query and partition before the shuffle."""
    order = Window.partitionBy("query_id").orderBy("row_no", "col_no")
    top = results.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n)
    values = F.array_sort(F.collect_list(F.struct("_rn", F.round("value", 4).cast("string").alias("v"))))
    return top.groupBy("query_id").agg(
        F.array_join(F.transform(values, lambda x: x["v"]), ", ").alias("_shown"))


def verification_summary(verified: DataFrame) -> DataFrame:
    """One row: total, passed, value_checked, execute_only and failed."""
    status, checked = F.col("status"), F.coalesce("value_checked", F.lit(False))
    return verified.agg(
        F.count("*").alias("total"), F.count_if(status == "PASS").alias("passed"),
        F.count_if(checked).alias("value_checked"),
        F.count_if((status == "PASS") & ~checked).alias("execute_only"),
        F.count_if(status.isin("FAIL", "ERROR")).alias("failed"))
