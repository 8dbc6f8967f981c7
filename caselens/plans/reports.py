"""Every report of the batch run that is neither a rollup nor one of the ten answers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame

from caselens.operators import crosstabs, measures, priority, quality
from caselens.operators.enrich import FRACTIONAL, enrich
from caselens.params import UNSPECIFIED, Params
from caselens.plans import dashboard, escalation, workbook
from caselens.sources.calendar import attach_calendar, dim_date_covering, requests_per_day
from caselens.sources.sla import SlaTargets

# The boroughs of the grid and of the crosstabs.
BOROUGHS = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")


def gate(
    requests: DataFrame, counts: DataFrame, made: dict[str, DataFrame], params: Params,
) -> dict[str, DataFrame]:
    """Data quality and totals; ``counts`` compares landed slices with expected ones, ``made`` are the
    rollups."""
    return {
        "dq_checks": quality.dq_checks(requests, params),
        "slice_reconciliation": counts,
        "totals_reconciliation": quality.reconcile_totals(
            {
                name: made[f"kpi_by_{name}"] for name in ("agency", "complaint_type", "borough")
            }
        ),
    }


def escalations(
    requests: DataFrame, fact: DataFrame, made: dict[str, DataFrame], sla: SlaTargets,
    params: Params,
) -> dict[str, DataFrame]:
    """All documented rules; the new entrants are measured against four weeks before."""
    scores = made["priority_scores"]
    artifacts = escalation.artifact_candidates(made["kpi_by_complaint_type"], params)
    earlier = params.snapshot_date - timedelta(weeks=4)
    return {
        "escalate_missing_targets": escalation.missing_targets(scores),
        "escalate_growing_backlog": escalation.growing_backlog(fact, params),
        "aged_open_by_week": escalation.backlog_by_snapshot(requests, params),
        "escalate_past_limit": escalation.past_limit(fact, params),
        "escalate_unspecified_share": escalation.unspecified_share(requests),
        "new_hotspots": escalation.new_entrants(requests, sla, params, earlier),
        "artifact_candidates": artifacts,
        "separate_lines": escalation.separate_lines(fact, artifacts),
    }


def workbook_tables(
    sample: DataFrame, sla: SlaTargets, params: Params, factor: Column
) -> dict[str, DataFrame]:
    """The analyst workbook over the sample; estimates use the sample's own factor."""
    sheet = enrich(sample, sla, params, variant=FRACTIONAL)
    grid = workbook.priority_grid(sheet, params, BOROUGHS)
    return {
        "sla_overall": workbook.sla_overall(sheet, factor),
        "backlog_overall": workbook.backlog_overall(sheet, params, factor),
        "sla_block_agency": workbook.sla_block(sheet, "agency", top_n=12),
        "sla_block_borough": workbook.sla_block(sheet, "borough", values=(*BOROUGHS, UNSPECIFIED)),
        "sla_block_type": workbook.sla_block(sheet, "complaint_type", top_n=15),
        "aging_by_borough": crosstabs.aging_by_borough(sheet, (*BOROUGHS, UNSPECIFIED)),
        "oldest_open": workbook.oldest_open(sheet),
        "priority_grid": grid,
        "action_list": workbook.action_list(grid),
        "headline_kpis": workbook.headline(sheet, params),
    }


def dashboard_tables(fact: DataFrame, made: dict[str, DataFrame]) -> dict[str, DataFrame]:
    scores = made["priority_scores"]
    with_days = attach_calendar(fact, dim_date_covering(fact))
    return {
        "requests_per_day": requests_per_day(with_days),
        "weekly_by_borough": crosstabs.weekly_by(with_days, "borough"),
        "weekly_top_types": crosstabs.weekly_top_types(with_days),
        "closure_histogram": crosstabs.closure_histogram(fact),
        "score_matrix": crosstabs.score_matrix(scores, BOROUGHS),
        "high_risk_backlog": dashboard.high_risk(fact),
        "hotspot_table": dashboard.hotspot_table(scores),
        "month_over_month": measures.month_over_month(fact),
        "weight_sensitivity": priority.sensitivity(scores),
    }
