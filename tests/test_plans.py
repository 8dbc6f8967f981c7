"""Physical plans: pruning, push-down, no Python, no cross products, no stray single-task stages."""

import contextlib
import io

import pytest

from checks.queries import QUERIES

WRITES = {
    "closure_quantiles_fractional", "csv_ingest", "csv_ingest_torn_lines", "csv_torn_lines",
    "csv_reconciliation_torn_lines",
    "export_manifest", "exported_fact", "exported_kpi_by_agency",
    "requests_enriched_from_file", "requests_in_chosen_weeks",
}


def plan_of(frame):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan(spark, data, name):
    plan = plan_of(QUERIES[name](spark, data))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "BatchEvalPython",
                      "MapInPandas", "FlatMapGroups"):
        assert forbidden not in plan
    # Columns that no report uses never leave the files.
    for unread in ("o_totalprice", "l_extendedprice", "l_quantity", "c_acctbal", "c_name"):
        assert unread not in plan


def test_unused_joins_are_dropped(spark, data):
    """Counts that need no closing date do not read order lines."""
    assert "l_shipdate" not in plan_of(QUERIES["top_agencies"](spark, data))


def test_filters_reach_the_scan(spark, data):
    plan = plan_of(QUERIES["daily_requests"](spark, data))
    assert "lineitem" not in plan
    clean = plan_of(QUERIES["slice_activity"](spark, data))
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in clean


def executed(frame):
    """Node names of the plan as it ran, each reused exchange left out."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    return [line.strip(" +-:*()0123456789") for line in final.splitlines()]


def count_of(nodes, word):
    return sum(word in node for node in nodes)


SCANS = {
    # query: (scans of orders or lineitem lines, whichever is the driving table)
    "dq_checks": ("o_orderkey", 1), "dq_checks_raw_lines": ("l_linenumber", 1),
    "kpi_by_borough": ("o_orderkey", 1), "priority_grid": ("o_orderkey", 1),
    "new_hotspots": ("o_orderkey", 1), "escalate_growing_backlog": ("o_orderkey", 1),
    "weight_sensitivity": ("o_orderkey", 1), "raw_preview": ("l_linenumber", 1),
    "sample_requests": ("o_orderkey", 2),
}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_scans_of_the_executed_plan(spark, data, name):
    column, wanted = SCANS[name]
    nodes = [n for n in executed(QUERIES[name](spark, data)) if n.startswith("FileScan")]
    assert sum(column in n.split("]")[0] for n in nodes) == wanted


def test_unrepeated_keys_are_not_sorted(spark, data):
    """Only the copies go through a sorting aggregate."""
    rows = QUERIES["clean_requests"](spark, data)
    nodes = executed(rows)
    assert count_of(nodes, "SortAggregate") <= 2
    assert count_of(nodes, "HashAggregate") >= 2


def test_torn_lines_are_counted_without_the_source(spark, data):
    """The slices are stored once; neither the cut lines nor the counts join the order tables again."""
    nodes = executed(QUERIES["csv_reconciliation_torn_lines"](spark, data))
    scans = [n for n in nodes if n.startswith("FileScan")]
    assert scans and not any("l_orderkey" in n or "o_orderkey" in n for n in scans)


def test_no_median_no_second_shuffle(spark, data):
    with_median = executed(QUERIES["kpi_by_agency"](spark, data))
    without = executed(QUERIES["kpi_by_borough"](spark, data))
    assert count_of(without, "Aggregate(") < count_of(with_median, "Aggregate(")


def test_month_partitions_are_pruned(spark, tmp_path):
    from caselens.plans.export import write_fact
    from fixtures import PARAMS, at, frame, row, targets

    requests = frame(spark, [row("a", at("05-01")), row("b", at("06-01")), row("c", None)])
    fact = write_fact(requests, targets(spark), PARAMS, str(tmp_path))
    assert fact.count() == 3
    plan = plan_of(fact.filter("created_month = DATE '2026-05-01'"))
    assert "PartitionFilters: [isnotnull(created_month" in plan
