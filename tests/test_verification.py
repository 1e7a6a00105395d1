import itertools
import random

from pyspark.sql import functions as F

from maskmetrics.functions.claims import at_precision, numeric_cell, parse_numbers
from maskmetrics.operators import lookup
from maskmetrics.operators.verification import (
    ERROR_SCHEMA, RESULT_SCHEMA, claim_rows, column_totals, derivable_claims, flatten_results, matched_claims, report_panels,
    rewrite_panel_aliases, run_panels, split_statements, verification_summary, verify)

HTML = """<html><head><title>Depot of the north</title></head><body><pre>SELECT 0</pre>
<main><div class="dax-query"><header><span class="dax-title">A. Open orders</span></header>
<section><pre>EVALUATE FILTER(O, O[buyer] = "&lt;PERSON_7&gt;")</pre></section></div>
<section data-screen-label="Fleet"><p>Lorries</p><details class="dax-proof"><summary>how</summary><pre>// lorries by depot
EVALUATE SUMMARIZECOLUMNS(L[depot])
-- Result: North 41; South 17; West 8 (all 66)

// mean age
EVALUATE ROW("Age", AVERAGE(L[age]))
-- Result: mean = 12.25
</pre></details></section>
<h2>Punctuality</h2><div class="dax-toggle"><em><span>View DAX Query</span></em><code><pre>EVALUATE P
-- Resultaat: on time = 88&nbsp;%</pre></code></div>
<h2>Storage</h2><article><div class="dax-toggle"><div><div><span>View DAX Query — Pallets stored</span></div></div><div><pre>EVALUATE ROW("p", COUNTROWS(FILTER(P, P[kg] &gt; 3 &amp;&amp; P[kg] &lt; 40)))
-- Result: pallets = 7,316; loss = -€&nbsp;1.234,56 on 21&nbsp;Jan&nbsp;2026</pre></div></div></article></main></body></html>"""


def test_panels_of_all_families(spark):
    df = spark.createDataFrame([(1, HTML), (2, "<html><pre>SELECT 1</pre></html>"), (3, None)], "report_id int, html string")
    rows = report_panels(df).orderBy("panel_no", "statement_no").collect()
    assert [(r["family"], r["section"]) for r in rows] == [
        ("dax-query", "A. Open orders"), ("dax-proof", "Fleet (1/2)"), ("dax-proof", "Fleet (2/2)"),
        ("dax-toggle", "Punctuality"), ("dax-toggle", "Pallets stored")]
    assert "P[kg] > 3 && P[kg] < 40" in rows[4]["query"] and "Result" not in rows[4]["query"]
    assert '"<PERSON_7>"' in rows[0]["query"]
    # No-break spaces stand before signs of per cent, in amounts and in dates.
    assert [[tuple(c) for c in r["expected"]] for r in rows] == [
        [], [(41.0, 0, False), (17.0, 0, False), (8.0, 0, False), (66.0, 0, False)], [(12.25, 2, False)],
        [(88.0, 0, True)], [(7316.0, 0, False), (-1234.56, 2, False)]]


TIES = [(2.675, 2), (0.125, 2), (2.5, 0), (3.5, 0), (-2.5, 0), (1.005, 2), (0.285, 2), (1e15 + 0.5, 0), (4.7143, 1), (0.0, 3), (-0.375, 2),
        (8.345, 2), (1.115, 2), (1e-9, 3), (123456.785, 2)]


def test_rounding_is_that_of_the_exact_value(spark):
    rng = random.Random(5)
    cases = TIES + [(round(rng.uniform(-500, 500), 3), 2) for _ in range(400)] + [(rng.randrange(-4000, 4000) / 8, 2) for _ in range(200)]
    df = spark.createDataFrame([(i, v, d) for i, (v, d) in enumerate(cases)], "i int, v double, d int")
    got = df.select(at_precision(F.col("v"), F.col("d")).alias("u")).collect()
    assert [r["u"] / 10 ** d for r, (_, d) in zip(got, cases)] == [round(v, d) for v, d in cases]


STATEMENTS = [
    ("EVALUATE A\n-- Result: 1", ["EVALUATE A\n-- Result: 1"]),
    ("// c\nEVALUATE A\n-- x\nevaluate B", ["// c\nEVALUATE A\n-- x", "evaluate B"]),
    ("DEFINE VAR x = 1\nEVALUATE A\nEVALUATE B", ["DEFINE VAR x = 1\nEVALUATE A", "EVALUATE B"]),
    ("EVALUATE A\nDEFINE M\nDEFINE N\nEVALUATE B", ["EVALUATE A", "DEFINE M", "DEFINE N\nEVALUATE B"]),
    ("no keyword", ["no keyword"]), ("EVALUATED x", ["EVALUATED x"]),
]


def test_split_statements(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(STATEMENTS)], "i int, body string")
    got = df.select("i", split_statements("body").alias("s")).orderBy("i").collect()
    assert [r["s"] for r in got] == [s for _, s in STATEMENTS]


NUMBERS = [
    ("1,284", [(1284.0, 0, False)]), ("1,234,567", [(1234567.0, 0, False)]), ("4.7", [(4.7, 1, False)]), ("93%", [(93.0, 0, True)]),
    ("€ 1.234,56", [(1234.56, 2, False)]), ("$1,234.56", [(1234.56, 2, False)]), ("-12.5", [(-12.5, 1, False)]),
    ("no per-company M365 data (0)", [(0.0, 0, False)]), ("Q2 2026 created = 305", [(305.0, 0, False)]),
    ("Microsoft 365", []), ("Office 365 users: 5", [(5.0, 0, False)]), ("last create date = 21 Jan 2026", []),
    ("window Aug 2025 to Jan 2026, 3 mei 26", []), ("iso 2026-01-21 total 7", [(7.0, 0, False)]),
    ("1.234 1,234 4,7 1.234.567", [(1.234, 3, False), (1234.0, 0, False), (4.7, 1, False), (1234567.0, 0, False)]),
    ("1,2,34.5,6 x 12.5 %", [(12.5, 1, True)]), ("", []), (None, []),
]


def test_parse_numbers(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NUMBERS)], "i int, t string")
    got = df.select("i", parse_numbers("t").alias("n")).orderBy("i").collect()
    assert [[tuple(c) for c in r["n"]] for r in got] == [n for _, n in NUMBERS]


def test_numeric_cells(spark):
    cells = ["5", " -1.5e2 ", "1_000", "1d", "NaN", "x", "", None, ".5", "5."]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, t string").select("i", numeric_cell("t").alias("v"))
    assert [r["v"] for r in df.orderBy("i").collect()] == [5.0, -150.0, 1000.0, None, None, None, None, 0.0, 0.5, 5.0]
    rows = spark.createDataFrame([("q", 0, 5, None, True), ("q", 1, None, "7", None)], "q string, n int, a int, b string, c boolean")
    flat = flatten_results(rows, "q", "n", ["a", "b", "c"])
    assert sorted((r["row_no"], r["col"], r["value"]) for r in flat.collect()) == [
        (0, "a", 5.0), (0, "b", 0.0), (1, "a", 0.0), (1, "b", 7.0), (1, "c", 0.0)]


def checked(spark, cells, claims, errors=(), **options):
    """Verify one panel: cells are (row, col_no, col, value)."""
    results = spark.createDataFrame([("q", r, n, c, float(v)) for r, n, c, v in cells], RESULT_SCHEMA)
    panels = spark.createDataFrame([("r", 0, "q", "s", "f", claims)],
                                   "report_id string, panel_no int, query_id string, section string, family string, "
                                   "expected array<struct<value:double,decimals:int,is_percent:boolean>>")
    return verify(panels, results, spark.createDataFrame(list(errors), ERROR_SCHEMA), ["report_id", "panel_no"], **options).first()


def test_verify_panels(spark):
    one = [(0, 0, "Total", 218), (0, 1, "Managed", 166)]
    r = checked(spark, one, [(218.0, 0, False), (166.0, 0, False), (76.0, 0, True), (52.0, 0, False)])
    assert (r["status"], r["derived"], r["value_checked"]) == ("PASS", ["76%", "52"], True)
    assert r["detail"] == "2 value(s) match; 2 derived, not directly queryable (76%, 52)"
    r = checked(spark, one, [(76.0, 0, True)], strict_percent=True)
    assert r["status"] == "FAIL"
    r = checked(spark, [(0, 0, "avg", 9.9)], [(4.7, 1, False)])
    assert (r["status"], r["detail"]) == ("FAIL", "expected 4.7 not in returned values [9.9]")
    r = checked(spark, [(0, 0, "avg", 4.7143), (0, 1, "sla", 0.9331)], [(4.7, 1, False), (93.0, 0, True)])
    assert (r["status"], r["detail"]) == ("PASS", "2 value(s) match")
    r = checked(spark, [(i, 0, "n", v) for i, v in enumerate((953, 103, 2))], [(1058.0, 0, False)])
    assert (r["status"], r["derived"], r["value_checked"]) == ("PASS", ["1058"], False)
    r = checked(spark, one, [])
    assert (r["status"], r["detail"], r["value_checked"]) == ("PASS", "ran, no expected values", False)
    r = checked(spark, [], [(1.0, 0, False)], [("q", "boom")])
    assert (r["status"], r["detail"], r["value_checked"]) == ("ERROR", "boom", None)


def test_derivable_claims_agree_with_all_pairs(spark):
    rng = random.Random(11)
    totals = [(f"q{q}", f"c{c}", rng.choice([rng.randint(0, 40), round(rng.uniform(0, 40), 3)]) * 1.0)
              for q in range(12) for c in range(rng.randint(1, 7))]
    claims = [(f"q{q}", round(rng.uniform(-3, 40), d), d) for q in range(12) for d in (0, 1, 2) for _ in range(25)]
    got = {tuple(r) for r in derivable_claims(
        spark.createDataFrame(claims, "query_id string, value double, decimals int"),
        spark.createDataFrame(totals, "query_id string, col string, total double")).collect()}
    want = set()
    for q, v, d in claims:
        own = [t for p, _, t in totals if p == q]
        pool = own + [abs(a - b) for a, b in itertools.combinations(own, 2)]
        if any(abs(round(x * 10 ** d) - v * 10 ** d) < 1e-6 for x in pool):
            want.add((q, v, d))
    assert got == want and want


def test_alias_literals_of_panels(spark):
    df = spark.createDataFrame([(1, '<details class="dax-proof"><pre>EVALUATE X("Client_A")</pre></details>')], "report_id int, html string")
    mapping = spark.createDataFrame([("Client_A", "Acme")], "alias string, value string")
    r = rewrite_panel_aliases(report_panels(df), mapping).first()
    assert (r["query"], r["aliases_rewritten"]) == ('EVALUATE X("Acme")', 1)


def test_run_panels_and_summary(spark):
    results, errors = run_panels(spark, {
        "good": lambda s: s.range(3).agg(F.sum("id").alias("n")), "bad": lambda s: s.range(1).select("nope"),
        "late": lambda s: s.range(1).select(F.raise_error(F.lit("late failure")).alias("n"))})
    assert [(r["query_id"], r["value"]) for r in results.collect()] == [("good", 3.0)]
    assert {r["query_id"] for r in errors.collect()} == {"bad", "late"}
    verified = spark.createDataFrame([("PASS", True), ("PASS", False), ("FAIL", True), ("ERROR", None)], "status string, value_checked boolean")
    assert verification_summary(verified).first().asDict() == {
        "total": 4, "passed": 2, "value_checked": 2, "execute_only": 1, "failed": 2}


def test_reports_are_parsed_once(spark):
    df = spark.createDataFrame([(1, HTML)], "report_id int, html string")
    claims = claim_rows(report_panels(df).withColumn("query_id", F.lit("q")), ["report_id", "panel_no", "statement_no"])

    def plan(d):
        return d._jdf.queryExecution().optimizedPlan().toString()

    assert plan(claims).count("regexp_extract_all") == 1
    results = spark.createDataFrame([("q", 0, 0, "n", 41.0), ("q", 1, 0, "n", 17.0), ("q", 0, 1, "m", 7.25)], RESULT_SCHEMA)
    matched = matched_claims(claims, results)
    assert "MapInPandas" not in plan(matched)
    assert {r["value"] for r in matched.where("matched").collect()} == {41.0, 17.0}
    derived = derivable_claims(claims, column_totals(results))
    assert "MapInPandas" not in plan(derived)
    # 58 and 7.25 are the totals, no claim is one of them or their difference.
    assert derived.count() == 0


def test_only_hot_keys_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_ROWS", 50)
    rows = spark.createDataFrame([(f"k{min(i // 3, 5)}", i) for i in range(200)] + [(None, 0)], "k string, i int")
    table = spark.createDataFrame([(f"k{j}", v) for j in range(8) for v in "ab"], "k string, v string")
    for how in ("inner", "left"):
        joined = lookup.hot_join(rows, table, ["k"], F.col("i"), how)
        assert sorted(map(str, joined.collect())) == sorted(map(str, rows.join(table, ["k"], how).collect()))
