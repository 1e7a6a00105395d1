"""Reading a dashboard from its JSON description, a file of a few kilobytes."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import SparkSession

from maskmetrics.operators.metrics import Dashboard, Gauge, Kpi, Series, TableColumn


def _as_metric(entry: dict) -> str:
    if "field" in entry:
        return f"sum:{entry['field']}"
    if entry.get("compute") == "ratio":
        return f"ratio:{entry['numerator']}:{entry['denominator']}"
    return "ratio:" + entry["calc"].replace("/", ":")


def read_dashboard_spec(path: str | Path, spark: SparkSession | None = None) -> Dashboard:
    """The dashboard that a file describes: a file of the driver or, with ``spark``, of any store that Spark reads."""
    if spark is None:
        return dashboard_of(Path(path).read_text(encoding="utf-8"))
    return dashboard_of(spark.read.text(str(path), wholetext=True).first()[0])


def dashboard_of(text: str) -> Dashboard:
    spec = json.loads(text)
    table = spec["table"]
    shown = [c for c in table["columns"] if c.get("type") not in ("rank", "name")]
    named = [c["label"] for c in table["columns"] if c.get("type") == "name"]
    return Dashboard(
        title=spec["title"],
        kpis=tuple(Kpi(k["label"], k["metric"], k.get("format", "num"))
                   for row in spec["kpi_rows"] for k in row),
        gauges=tuple(Gauge(g["label"], g["metric"], g.get("target"), g.get("max", 1))
                     for g in spec.get("gauges", ())),
        charts={c["title"]: tuple(Series(s["label"], _as_metric(s)) for s in c["series"])
                for c in spec.get("charts", ())},
        entity=named[0] if named else "Name",
        columns=tuple(TableColumn(c["label"], _as_metric(c), c.get("format", "num")) for c in shown),
        sort=table["sort"], limit=table.get("limit", 15), filters=tuple(spec.get("filters", ())),
        descending=table.get("order", "desc") == "desc")
