import base64
import json

from pyspark.sql import functions as F

from maskmetrics.functions.columns import classify_column, classify_unprotected_column
from maskmetrics.operators.catalog import (
    coverage_missing, decode_parts, definition_text, detect_sensitive_columns, detect_unprotected_columns, frame_columns,
    list_catalog, list_named, schema_columns, search_with_context, unprotected_warnings)
from maskmetrics.operators.metrics import gauges, kpis, masked_table, monthly, ranked_table, slug
from maskmetrics.plans.dashboards import DASHBOARDS
from maskmetrics.sources.dashboard_spec import read_dashboard_spec

CLASSES = {
    "company_name": "client", "account_name": "client", "owner_resource_name": "resource", "created_by_resource_name": "resource",
    "creator_resource_name": "resource", "primary_contact_name": "contact", "contact_name": "contact", "email_address": "contact",
    "first_name": "contact", "last_name": "contact", "Company Name": "client", "CompanyName": "client", "Full Name": "contact",
    "FullName": "contact", "Email": "contact", "Phone": "contact", "technicianEmail": "resource",
    "company_id": None, "resource_id": None, "contact_id": None, "account_id": None, "id": None, "ticket_number": None,
    "created_date": None, "month_name": None, "status_name": None, "queue_name": None, "revenue": None,
}
FAMILIES = {
    "description": "free_text", "contract_description": "free_text", "desc": "free_text", "internal_notes": "free_text",
    "summary": "free_text", "ticket_title": "free_text", "body": "free_text", "resolution_details": "free_text",
    "role_name": "descriptive", "specialty": "descriptive", "job_title": "descriptive", "jobtitle": "descriptive",
    "JobTitle": "descriptive", "department": "descriptive", "industry": "descriptive",
    "company_id": None, "revenue": None, "company_name": None, "email_address": None, "queue_name": None,
}


def test_column_classes(spark):
    df = spark.createDataFrame([(n,) for n in {**CLASSES, **FAMILIES}], "n string")
    rows = df.select("n", classify_column("n").alias("c"), classify_unprotected_column("n").alias("f")).collect()
    assert {r["n"]: r["c"] for r in rows if r["n"] in CLASSES} == CLASSES
    assert {r["n"]: r["f"] for r in rows if r["n"] in FAMILIES} == FAMILIES


def parts(spark):
    def code(text):
        return base64.b64encode(text.encode()).decode()
    rows = [
        ("m", 0, "definition/tables/BI_Companies.tmdl", code("table\n\tcolumn company_name\n\tcolumn 'Job Title'\n\tmeasure 'Total É' = 1"), "InlineBase64"),
        ("m", 1, "definition/tables/Facts/columns.tmdl", code("column contact_name\nmeasure Bare = 2\n  MEASURE Bare = 2"), "InlineBase64"),
        ("m", 2, "definition/model.tmdl", code("column email"), "InlineBase64"),
        ("m", 3, "definition/tables/Bad.tmdl", base64.b64encode(b"\xff\xfe").decode(), "InlineBase64"),
        ("m", 4, "definition/tables/Other.tmdl", code("column email"), "Reference"), ("m", 5, "definition/tables/Empty.tmdl", "", "InlineBase64"),
    ]
    return spark.createDataFrame(rows, "model string, no int, path string, payload string, payload_type string")


def test_model_definition(spark):
    decoded = decode_parts(parts(spark))
    assert sorted(r["no"] for r in decoded.collect()) == [0, 1, 2]
    text = definition_text(decoded, "model", "no").first()["text"]
    assert text.startswith("--- definition/tables/BI_Companies.tmdl ---\ntable") and text.count("\n\n---") == 2
    columns = schema_columns(decoded)
    assert {(r["table"], r["column"]) for r in columns.collect()} == {
        ("BI_Companies", "company_name"), ("BI_Companies", "Job Title"), ("Facts", "contact_name")}
    assert [tuple(r) for r in detect_sensitive_columns(columns).collect()] == [("client", "BI_Companies", "company_name")]
    warned = unprotected_warnings(detect_unprotected_columns(columns)).first()
    assert warned["family"] == "descriptive" and "'BI_Companies'[Job Title] is NOT auto-anonymized" in warned["warning"]
    assert [r["name"] for r in list_named(decoded).collect()] == ["Bare", "Total É"]
    assert frame_columns(spark, {"t": parts(spark)}).count() == 5
    assert coverage_missing([]) and not coverage_missing([object()])


def greedy(lines, term, context):
    kept = []
    for i, line in enumerate(lines, 1):
        if term.lower() in line.lower() and (not kept or i - kept[-1] > 2 * context):
            kept.append(i)
    return kept


def test_search_with_context(spark):
    docs = {1: ["x"] * 3 + ["HIT"] * 30 + ["y"] * 5, 2: [f"hit {i}" if i % 4 == 0 else "-" for i in range(200)], 3: ["none"]}
    df = spark.createDataFrame([(k, "\n".join(v)) for k, v in docs.items()], "id int, text string")
    got = {}
    for r in search_with_context(df, "id", "text", "hit", context=3, limit=5).collect():
        lines = docs[r["id"]]
        got.setdefault(r["id"], []).append(r["line_number"])
        n = r["line_number"]
        assert r["context"] == "\n".join(lines[max(0, n - 4):n + 3])
        assert r["found"] == len(greedy(lines, "hit", 3))
    assert {k: sorted(v) for k, v in got.items()} == {k: greedy(docs[k], "hit", 3)[:5] for k in (1, 2)}


def test_catalog_listing(spark, registry_of):
    listing = spark.createDataFrame([("QBR Acme", "id1", "jan@x"), ("Sales", "id2", None)], "name string, id string, owner string")
    shown, grown = list_catalog(listing, registry_of(contact=["piet@x"]), "item", owner="owner")
    assert sorted((r["name"], r["id"], r["owner"]) for r in shown.collect()) == [("Item_1", "id1", "Contact_2"), ("Item_2", "id2", None)]
    assert grown.size.rows == 4


def fact(spark):
    rows = [("A", "2026-01-05 10:00:00", 10, 2), ("B", "2026-01-06 10:00:00", 30, 0), ("A", "2026-02-01 00:00:00", 5, 3), ("C", "2026-02-02 00:00:00", 15, 0)]
    return spark.createDataFrame(rows, "name string, ts string, rev int, hrs int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_dashboard_from_json(spark, tmp_path, registry_of):
    spec = {
        "title": "T", "filters": ["company"],
        "kpi_rows": [[{"label": "Rev", "metric": "sum:rev", "format": "eur"}], [{"label": "Rate", "metric": "ratio:rev:hrs"}]],
        "gauges": [{"label": "G", "metric": "ratio:hrs:rev", "target": 0.05, "max": 0.2}, {"label": "H", "metric": "wavg:rev:hrs", "max": 5}],
        "charts": [{"title": "C", "series": [{"label": "Rev", "field": "rev"}, {"label": "Rate %", "compute": "ratio", "numerator": "rev", "denominator": "hrs"}]}],
        "table": {"columns": [{"label": "#", "type": "rank"}, {"label": "Company", "type": "name"}, {"label": "Rev", "field": "rev"},
                              {"label": "Rate", "type": "derived", "calc": "rev/hrs", "format": "eur"}], "sort": "rev", "order": "desc", "limit": 2}}
    path = tmp_path / "board.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    board = read_dashboard_spec(path)
    assert {r["label"]: r["value"] for r in kpis(fact(spark), board).collect()} == {"Rev": 60.0, "Rate": 12.0}
    g, h = gauges(fact(spark), board).collect()
    assert (g["on_target"], round(g["fill"], 6), h["on_target"], h["fill"]) == (True, round(5 / 60 / 0.2, 6), None, 1.0)
    months = {str(r["month"]): (r["rev"], r["rate_pct"]) for r in monthly(fact(spark), board.charts["C"]).collect()}
    assert months == {"2026-01-01": (40.0, 20.0), "2026-02-01": (20.0, 20 / 3)}
    table = ranked_table(fact(spark), board, "name")
    assert [tuple(r) for r in table.collect()] == [(1, "B", 30.0, None), (2, "A", 15.0, 3.0)]
    masked = masked_table(table, registry_of(client=["A", "B", "C"]))
    assert sorted(r["name"] for r in masked.collect()) == ["Client_A", "Client_B"]


def test_all_dashboards_are_well_formed():
    assert len(DASHBOARDS) == 8 and slug("FR SLA %") == "fr_sla_pct"
    for board in DASHBOARDS.values():
        names = [slug(c.label) for c in board.columns]
        assert len(set(names)) == len(names) and board.limit in (15, 20)
