"""The eight dashboards: which sums, ratios, series and columns each one shows."""

from __future__ import annotations

from maskmetrics.operators.metrics import Dashboard, Gauge, Kpi, Series, TableColumn

# Labels, metrics, formats, targets, sort fields and limits.
DASHBOARDS = {
    "satisfaction": Dashboard(
        title="CSAT & Satisfaction Dashboard",
        kpis=(Kpi("Avg CSAT Score", "wavg:csat_sum:csat_n", "rating"),
              Kpi("Response Rate", "ratio:csat_n:t_total", "pct"),
              Kpi("Surveys Sent", "sum:t_total"), Kpi("Responses", "sum:csat_n")),
        gauges=(Gauge("CSAT", "wavg:csat_sum:csat_n", None, 5.0),),
        charts={"CSAT Trend by Month": (Series("Avg CSAT", "ratio:csat_sum:csat_n"),
                                        Series("Responses", "sum:csat_n"))},
        entity="Company",
        columns=(TableColumn("Avg CSAT", "ratio:csat_sum:csat_n", "rating"),
                 TableColumn("Responses", "sum:csat_n"),
                 TableColumn("Response Rate", "ratio:csat_n:t_total", "pct")),
        sort="csat_n"),
    "endpoint_health": Dashboard(
        title="Endpoint Health Dashboard",
        kpis=(Kpi("Online %", "ratio:online:total_devices", "pct"), Kpi("Active Alerts", "sum:alerts"),
              Kpi("Total Devices", "sum:total_devices"), Kpi("Related Tickets", "sum:tickets")),
        gauges=(Gauge("Online", "ratio:online:total_devices", 0.98),),
        charts={"Device Health Trend": (Series("Online", "sum:online"), Series("Offline", "sum:offline"),
                                        Series("Alerts", "sum:alerts"))},
        entity="Company",
        columns=(TableColumn("Devices", "sum:total_devices"),
                 TableColumn("Online %", "ratio:online:total_devices", "pct"),
                 TableColumn("Alerts", "sum:alerts"), TableColumn("Tickets", "sum:tickets")),
        sort="total_devices"),
    "patch_compliance": Dashboard(
        title="Patch Compliance Dashboard",
        kpis=(Kpi("Patched %", "ratio:patched:total_endpoints", "pct"),
              Kpi("Critical Outstanding", "sum:critical"),
              Kpi("Total Endpoints", "sum:total_endpoints"), Kpi("Overdue Patches", "sum:overdue")),
        gauges=(Gauge("Compliance", "ratio:patched:total_endpoints", 0.95),),
        charts={"Patch Compliance Trend": (Series("Patched", "sum:patched"),
                                           Series("Unpatched", "sum:unpatched"),
                                           Series("Compliance %", "ratio:patched:total_endpoints"))},
        entity="Company",
        columns=(TableColumn("Endpoints", "sum:total_endpoints"),
                 TableColumn("Patched %", "ratio:patched:total_endpoints", "pct"),
                 TableColumn("Critical", "sum:critical"), TableColumn("Overdue", "sum:overdue")),
        sort="total_endpoints"),
    "project_performance": Dashboard(
        title="Project Performance Dashboard",
        kpis=(Kpi("Budget Used", "ratio:actual_hrs:budget_hrs", "pct"),
              Kpi("Actual Hours", "sum:actual_hrs", "hrs"), Kpi("Budget Hours", "sum:budget_hrs", "hrs"),
              Kpi("Milestones Complete", "sum:milestones_done")),
        gauges=(Gauge("Budget", "ratio:actual_hrs:budget_hrs", 1.0, 1.5),),
        charts={"Hours: Actual vs Budget by Month": (
            Series("Actual Hours", "sum:actual_hrs"), Series("Budget Hours", "sum:budget_hrs"),
            Series("Milestones", "sum:milestones_done"))},
        entity="Project",
        columns=(TableColumn("Actual Hrs", "sum:actual_hrs", "hrs"),
                 TableColumn("Budget Hrs", "sum:budget_hrs", "hrs"),
                 TableColumn("Budget %", "ratio:actual_hrs:budget_hrs", "pct"),
                 TableColumn("Milestones", "sum:milestones_done")),
        sort="actual_hrs"),
    "resource_utilization": Dashboard(
        title="Resource Utilization Dashboard",
        kpis=(Kpi("Billable %", "ratio:bill_hrs:total_hrs", "pct"), Kpi("Total Hours", "sum:total_hrs", "hrs"),
              Kpi("Billable Hours", "sum:bill_hrs", "hrs"), Kpi("Non-Billable", "sum:nonbill_hrs", "hrs")),
        gauges=(Gauge("Utilization", "ratio:bill_hrs:total_hrs", 0.70),),
        charts={"Utilization Trend by Month": (
            Series("Billable", "sum:bill_hrs"), Series("Non-Billable", "sum:nonbill_hrs"),
            Series("Util %", "ratio:bill_hrs:total_hrs"))},
        entity="Resource",
        columns=(TableColumn("Total Hours", "sum:total_hrs", "hrs"),
                 TableColumn("Billable", "sum:bill_hrs", "hrs"),
                 TableColumn("Util %", "ratio:bill_hrs:total_hrs", "pct")),
        sort="total_hrs", limit=20, filters=("resource", "time")),
    "revenue_billing": Dashboard(
        title="Revenue & Billing Dashboard",
        kpis=(Kpi("Total Revenue", "sum:rev", "eur"), Kpi("Billable Hours", "sum:hrs", "hrs"),
              Kpi("Avg Hourly Rate", "ratio:rev:hrs", "eur"), Kpi("Margin", "ratio:profit:rev", "pct")),
        gauges=(),
        charts={"Revenue vs Hours by Month": (Series("Revenue", "sum:rev"), Series("Hours", "sum:hrs"))},
        entity="Company",
        columns=(TableColumn("Revenue", "sum:rev", "eur"), TableColumn("Hours", "sum:hrs", "hrs"),
                 TableColumn("Avg Rate", "ratio:rev:hrs", "eur"),
                 TableColumn("Margin", "ratio:profit:rev", "pct")),
        sort="rev"),
    "sla_performance": Dashboard(
        title="SLA Performance Dashboard",
        kpis=(Kpi("First Response SLA", "ratio:fr_met:t_total", "pct"),
              Kpi("Resolution SLA", "ratio:res_met:t_total", "pct"),
              Kpi("Total Tickets", "sum:t_total"), Kpi("Overdue Tickets", "sum:overdue")),
        gauges=(Gauge("FR SLA", "ratio:fr_met:t_total", 0.85),
                Gauge("Resolution SLA", "ratio:res_met:t_total", 0.90)),
        charts={"SLA Trend by Month": (Series("FR SLA %", "ratio:fr_met:t_total"),
                                       Series("Resolution SLA %", "ratio:res_met:t_total"))},
        entity="Company",
        columns=(TableColumn("Tickets", "sum:t_total"), TableColumn("FR SLA", "ratio:fr_met:t_total", "pct"),
                 TableColumn("Res SLA", "ratio:res_met:t_total", "pct"),
                 TableColumn("Overdue", "sum:overdue")),
        sort="t_total", filters=("company", "queue", "time")),
    "ticket_volume": Dashboard(
        title="Ticket Volume Dashboard",
        kpis=(Kpi("Tickets Created", "sum:t_cr"), Kpi("Tickets Resolved", "sum:t_res"),
              Kpi("Open Tickets", "sum:t_open"), Kpi("Backlog", "sum:t_backlog")),
        gauges=(),
        charts={"Ticket Volume by Month": (Series("Created", "sum:t_cr"), Series("Resolved", "sum:t_res")),
                "Open vs Backlog Trend": (Series("Open", "sum:t_open"), Series("Backlog", "sum:t_backlog"))},
        entity="Company",
        columns=(TableColumn("Created", "sum:t_cr"), TableColumn("Resolved", "sum:t_res"),
                 TableColumn("Open", "sum:t_open")),
        sort="t_cr", filters=("company", "queue", "time")),
}
