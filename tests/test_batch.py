"""The batch run writes every report whole; registered queries lose no rows at any size."""

import os
import sys

import pytest

from caselens import __main__ as batch
from caselens.sources import raw, schemas
from checks.queries import QUERIES
from test_preparation import raw_row, write_extract

SMALL = "/root/testdata/sf0.001"
FOLDERS = {
    "processed": {"service_requests", "sample", "raw_preview", "extract_metadata"},
    "quality": {"dq_checks", "slice_reconciliation", "totals_reconciliation"},
    "escalation": {
        "escalate_missing_targets", "escalate_growing_backlog", "escalate_past_limit",
        "escalate_unspecified_share", "new_hotspots", "artifact_candidates", "separate_lines",
        "aged_open_by_week",
    },
    "workbook": {
        "sla_overall", "backlog_overall", "sla_block_agency", "sla_block_borough",
        "sla_block_type", "aging_by_borough", "oldest_open", "priority_grid", "action_list",
        "headline_kpis",
    },
    "dashboard": {
        "requests_per_day", "weekly_by_borough", "weekly_top_types", "closure_histogram",
        "score_matrix", "high_risk_backlog", "hotspot_table", "month_over_month",
        "weight_sensitivity",
    },
}


def test_batch_run_writes_all_tables(spark, tmp_path, monkeypatch):
    rows = [
        raw_row(str(i), closed_date="2026-04-09T08:00:00.000" if i % 2 else None, agency=f"A{i % 30}",
                agency_name="Parks", complaint_type=f"Type {i % 50}", borough="QUEENS",
                status="Closed" if i % 2 else "Open", open_data_channel_type="PHONE")
        for i in range(400)
    ]
    activity = write_extract(tmp_path / "a.csv", rows)
    backlog = write_extract(tmp_path / "b.csv", [
        (*r[:1], "2026-01-05T09:00:00.000", *r[2:]) for r in rows[:7]])
    out = str(tmp_path / "out")
    monkeypatch.setattr(sys, "argv", [
        "caselens", "--activity", activity, "--backlog", backlog, "--out", out,
        "--expected", "activity_q2_2026=401", "--expected", "unknown=3"])
    batch.main()
    for folder, names in FOLDERS.items():
        assert set(os.listdir(f"{out}/{folder}")) == names
    answers = os.listdir(f"{out}/answers")
    assert len(answers) == 10 and all(a.startswith("n") for a in answers)
    assert set(os.listdir(f"{out}/exports")) >= {"fact_service_requests", "manifest"}
    assert "_profile" not in os.listdir(f"{out}/exports")
    states = {
        r["slice"]: r["state"]
        for r in spark.read.csv(f"{out}/quality/slice_reconciliation", header=True).collect()
    }
    assert states == {"activity_q2_2026": "short", "aged_open_backlog": "unexpected", "unknown": "short"}
    assert spark.read.csv(f"{out}/processed/raw_preview", header=True).count() == 400
    assert raw.read_raw_csv(spark, activity).columns == list(schemas.RAW_COLUMNS)


def test_weeks_hold_every_request(spark, data):
    rows = QUERIES["measures_by_week"](spark, data).collect()
    orders = spark.read.parquet(f"{data}/orders.parquet").count()
    assert sum(r["total_requests"] for r in rows) == orders
    days = QUERIES["requests_per_day"](spark, data).collect()
    assert sum(r["requests"] for r in days) == orders


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {
    "priority_scores_min_100", "n06_worst_sla_floor_590"}))
def test_every_query_has_rows_at_the_smallest_size(spark, name):
    if not os.path.isdir(SMALL):
        pytest.skip(f"no tables in {SMALL}")
    assert not QUERIES[name](spark, SMALL).isEmpty()
