"""Every report as ``(spark, folder) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselens.operators import (
    cleaning, crosstabs, enrich as derive, measures, priority, quality, quantiles, ranking, rollups,
)
from caselens.params import ACTIVITY, BACKLOG, Weights
from caselens.plans import analysis, dashboard, escalation, export, workbook
from caselens.session import shared_folder
from caselens.sources import calendar, orders, raw, schemas, sla, tables

P = orders.PARAMS
BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
ALL_BOROUGHS = (*BOROUGHS, "Unspecified")
MONTHS = (date(2001, 5, 1), date(2001, 6, 1), date(2001, 7, 1))
CHOSEN_WEEKS = (date(2001, 5, 14), date(2001, 5, 21))
FIRST_WEEK, LAST_WEEK = date(2001, 4, 30), date(2001, 7, 30)
SAMPLE_ROWS, SEED = 1_000, 42
OTHER_WEIGHTS = Weights(volume=0.10, backlog=0.40, miss=0.05, aged=0.60)
EARLIER = date(2001, 5, 1)
# A type whose closures are left out below, as if its recording never closed a request.
NEVER_CLOSED = "4-NOT SPECIFIED / FURNITURE"
# Thresholds that cut cells and types at every size of the given tables but the largest.
HIGH = replace(P, min_cell=100, volume_floor=590)
SLICERS = {
    "borough": ["ASIA", "EUROPE", "Unspecified"],
    "open_data_channel_type": ["PHONE", "MOBILE"],
    "aging_bucket": [None, "91-180 days", "180+ days"],
}
ONE_SCAN = (
    "kpi_by_agency", "kpi_by_complaint_type", "kpi_by_borough", "kpi_weekly", "backlog_aging",
    "priority_scores",
)
ALL_MEASURES = (
    "total_requests", "closed_requests", "open_requests", "backlog_count", "closure_rate",
    "avg_closure_days", "median_closure_days", "sla_missed", "sla_outcomes_known",
    "sla_miss_rate", "aging_backlog_count", "aged_share_of_backlog",
)


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return orders.requests(spark, folder)


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return derive.enrich(requests(spark, folder), orders.sla_targets(spark), P)


def fractional(spark: SparkSession, folder: str) -> DataFrame:
    return derive.enrich(
        requests(spark, folder), orders.sla_targets(spark), P, variant=derive.FRACTIONAL
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return priority.priority_scores(enriched(spark, folder), P)


def stacked_raw(spark: SparkSession, folder: str) -> DataFrame:
    return raw.label_slices(orders.raw_line_source(spark, folder), P)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(stacked_raw(spark, folder))


def with_calendar(spark: SparkSession, folder: str) -> DataFrame:
    fact = enriched(spark, folder)
    return calendar.attach_calendar(fact, calendar.dim_date_covering(requests(spark, folder)))


def artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """The enriched requests with one type that is never closed."""
    frozen = F.col("complaint_type") == NEVER_CLOSED
    rows = requests(spark, folder).withColumn(
        "closed_date", F.when(~F.coalesce(frozen, F.lit(False)), F.col("closed_date"))
    )
    return derive.enrich(rows, orders.sla_targets(spark), P)


def candidates(fact: DataFrame) -> DataFrame:
    return escalation.artifact_candidates(rollups.kpi_by_complaint_type(fact), P)


def sample(spark: SparkSession, folder: str) -> tuple[DataFrame, Column]:
    """An enriched sample of the cleaned requests, and what grosses it up to all of them."""
    rows = requests(spark, folder)
    drawn = ranking.sample_exact(rows, "unique_key", SAMPLE_ROWS, SEED)
    metadata = cleaning.extract_metadata(raw.slice_counts(rows), rows, SAMPLE_ROWS, P)
    factor = metadata.filter("item = 'scaling_factor'").select("value").scalar()
    return derive.enrich(drawn, orders.sla_targets(spark), P, variant=derive.FRACTIONAL), factor


def sla_overall(spark: SparkSession, folder: str) -> DataFrame:
    sheet, factor = sample(spark, folder)
    return workbook.sla_overall(sheet, factor)


def backlog_overall(spark: SparkSession, folder: str) -> DataFrame:
    sheet, factor = sample(spark, folder)
    return workbook.backlog_overall(sheet, P, factor)


def closure_quantiles_fractional(spark: SparkSession, folder: str) -> DataFrame:
    """Median and ninth decile of fractional closure days per type, by refinement."""
    found = quantiles.exact_quantiles(
        fractional(spark, folder), ["complaint_type"], "closure_days",
        {"median_closure_days": 0.5, "p90_closure_days": 0.9},
    )
    return found.withColumns(
        {c: F.round(c, 6) for c in ("median_closure_days", "p90_closure_days")}
    )


def enriched_from_file(spark: SparkSession, folder: str) -> DataFrame:
    """Requests against SLA targets that were written to a file and read again."""
    path = tables.write_csv(orders.sla_targets(spark).frame, f"{shared_folder(spark)}/targets")
    targets = sla.read_targets(spark, path, P.default_sla_days)
    return derive.enrich(requests(spark, folder), targets, P)


# --- reports that need more than one line --------------------------------------------------------


def slice_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Landed slices against counts asked of the source tables directly."""
    lines, heads = orders.table(spark, folder, "lineitem"), orders.table(spark, folder, "orders")
    both = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    created = F.col("o_orderdate")
    older = (created >= F.lit(P.backlog_start)) & (created < F.lit(P.window_start))
    expected = (
        both.select(
            F.when(raw.in_activity_window(created, P), ACTIVITY)
            .when(older & F.col("o_orderstatus").isin("O", "P"), BACKLOG)
            .alias("slice")
        )
        .filter(F.col("slice").isNotNull())
        .groupBy("slice")
        .agg(F.count(F.lit(1)).alias("expected_rows"))
    )
    return raw.reconcile_counts(raw.slice_counts(stacked_raw(spark, folder)), expected)


def slice_reconciliation_torn(spark: SparkSession, folder: str) -> DataFrame:
    """The same landed slices against a source that has one row more in one slice, names a slice
    that did not land, and does not know the other."""
    counts = raw.slice_counts(stacked_raw(spark, folder))
    more = counts.filter(F.col("slice") == ACTIVITY).select(
        "slice", (F.col("landed_rows") + 1).alias("expected_rows")
    )
    lost = counts.filter(F.col("slice") == ACTIVITY).select(
        F.lit("lost slice"), F.col("landed_rows")
    )
    return raw.reconcile_counts(counts, more.union(lost))


def sent_lines(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """The lines of both slices with their slice, from one pass over the source: they are stored, since
    each slice is written and counted from them."""
    return spark.read.parquet(tables.write_parquet(stacked_raw(spark, folder), f"{out}/sent"))


def written_slices(sent: DataFrame, out: str) -> list[str]:
    """Paths of the activity and the backlog slice, written as compressed CSV, a file a task."""
    return [
        tables.write_csv(
            raw.prune(sent.filter(F.col("slice") == label)), f"{out}/{name}", compression="gzip"
        )
        for label, name in ((ACTIVITY, "activity"), (BACKLOG, "backlog"))
    ]


def csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Both slices written as CSV, scanned back as text, cleaned and de-duplicated."""
    out = shared_folder(spark)
    paths = written_slices(sent_lines(spark, folder, out), out)
    landed = raw.stack_slices(*(raw.read_raw_csv(spark, path) for path in paths))
    return cleaning.deduplicate(cleaning.clean(landed))


def torn_source(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both slices as CSV, scanned and landed, and how many lines of each were sent. The activity
    extract also has the lines of its three smallest keys, cut after the second field."""
    out = shared_folder(spark)
    lines = sent_lines(spark, folder, out)
    paths = written_slices(lines, out)
    activity = lines.filter(F.col("slice") == ACTIVITY)
    cut = activity.select(F.concat_ws(",", "unique_key", "created_date").alias("line"))
    cut = cut.orderBy("line").limit(3)
    header = F.lit(",".join(schemas.RAW_COLUMNS))
    text = F.concat_ws("\n", header, F.array_sort(F.collect_list("line")))
    cut.agg(text.alias("value")).write.mode("append").text(paths[0])
    scanned = raw.stack_slices(*(raw.read_extract(spark, path) for path in paths))
    landed = spark.read.parquet(tables.write_parquet(scanned, f"{out}/scanned"))
    sent = raw.slice_counts(
        lines.select("slice").unionByName(cut.select(F.lit(ACTIVITY).alias("slice")))
    )
    return landed, sent.withColumnRenamed("landed_rows", "expected_rows")


def csv_torn_lines(spark: SparkSession, folder: str) -> DataFrame:
    landed, _ = torn_source(spark, folder)
    return raw.torn_lines(landed).drop("source_file")


def csv_reconciliation_torn_lines(spark: SparkSession, folder: str) -> DataFrame:
    landed, sent = torn_source(spark, folder)
    return raw.reconcile_counts(
        raw.slice_counts(raw.sound(landed)), sent, raw.torn_lines(landed)
    )


def csv_ingest_torn_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What is kept of an extract with torn lines: the requests of all other lines."""
    landed, _ = torn_source(spark, folder)
    return cleaning.deduplicate(cleaning.clean(raw.sound(landed)))


def extract_metadata(spark: SparkSession, folder: str) -> DataFrame:
    stacked = stacked_raw(spark, folder)
    unique = cleaning.deduplicate(cleaning.clean(stacked))
    return cleaning.extract_metadata(raw.slice_counts(stacked), unique, SAMPLE_ROWS, P)


def export_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return export.export(
        requests(spark, folder), orders.sla_targets(spark), P, shared_folder(spark)
    )


def exported_fact(spark: SparkSession, folder: str) -> DataFrame:
    return export.write_fact(
        requests(spark, folder), orders.sla_targets(spark), P, shared_folder(spark)
    )


def exported_kpi_by_agency(spark: SparkSession, folder: str) -> DataFrame:
    """The agency rollup written as CSV and loaded again with its declared types."""
    out = shared_folder(spark)
    path = tables.write_csv(rollups.kpi_by_agency(enriched(spark, folder)), f"{out}/agency")
    return tables.read_csv(spark, path, schemas.KPI_BY_AGENCY)


def in_chosen_weeks(spark: SparkSession, folder: str) -> DataFrame:
    """Requests by borough and weekday of two weeks, over the written fact: the weeks are chosen in
    the calendar, which names the month folders to read."""
    fact = exported_fact(spark, folder)
    days = calendar.dim_date(spark, P.backlog_start, P.window_end)
    chosen = calendar.in_calendar(fact, days, F.col("week_start").isin(*CHOSEN_WEEKS))
    return chosen.groupBy("borough", "weekday").agg(F.count(F.lit(1)).alias("requests"))


def stored(spark: SparkSession, folder: str) -> measures.Measures:
    """Measures over the stored profile of the requests; no query reads the requests again."""
    return measures.Measures.store(enriched(spark, folder), shared_folder(spark))


def _from_one_scan(name: str) -> Callable:
    return _on(enriched, lambda e: rollups.from_one_scan(e, P)[name])


def _on(source: Callable, report: Callable[[DataFrame], DataFrame]) -> Callable:
    """A report over one of the frames above."""
    return lambda spark, folder: report(source(spark, folder))


def _by_type(report: Callable[[DataFrame], DataFrame]) -> Callable:
    return _on(enriched, lambda e: report(rollups.kpi_by_complaint_type(e)))


def _grid(e: DataFrame) -> DataFrame:
    return workbook.priority_grid(e, P, BOROUGHS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # Sources, slices, preparation
    "slice_activity": lambda s, d: raw.activity_slice(orders.raw_line_source(s, d), P),
    "slice_backlog": lambda s, d: raw.backlog_slice(orders.raw_line_source(s, d), P),
    "slice_reconciliation": slice_reconciliation,
    "slice_reconciliation_torn": slice_reconciliation_torn,
    "clean_requests": _on(cleaned, cleaning.deduplicate),
    "csv_ingest": csv_ingest,
    "csv_ingest_torn_lines": csv_ingest_torn_lines,
    "csv_torn_lines": csv_torn_lines,
    "csv_reconciliation_torn_lines": csv_reconciliation_torn_lines,
    "extract_metadata": extract_metadata,
    "raw_preview": lambda s, d: ranking.preview(
        raw.activity_slice(orders.raw_line_source(s, d), P)
    ),
    "sample_requests": _on(
        requests, lambda r: ranking.sample_exact(r, "unique_key", SAMPLE_ROWS, SEED)
    ),
    "closure_quantiles_fractional": closure_quantiles_fractional,
    "dim_date": _on(requests, calendar.dim_date_covering),
    "requests_with_calendar": _on(
        with_calendar,
        lambda f: f.select(
            "unique_key", "created_date_only", "date", "week_start", "month_start", "weekday"
        ),
    ),
    # Quality gate
    "dq_checks": _on(requests, lambda r: quality.dq_checks(r, P)),
    "dq_checks_raw_lines": _on(cleaned, lambda r: quality.dq_checks(r, P)),
    # Derivations
    "requests_enriched": enriched,
    "requests_enriched_fractional": fractional,
    "requests_enriched_from_file": enriched_from_file,
    # Rollups
    "kpi_by_agency": _on(enriched, rollups.kpi_by_agency),
    "kpi_by_complaint_type": _on(enriched, rollups.kpi_by_complaint_type),
    "kpi_by_borough": _on(enriched, rollups.kpi_by_borough),
    "kpi_weekly": _on(enriched, rollups.kpi_weekly),
    "backlog_aging": _on(enriched, rollups.backlog_aging),
    "priority_scores": scores,
    "priority_scores_min_100": _on(enriched, lambda e: priority.priority_scores(e, HIGH)),
    # Analysis questions
    "n01_demand_concentration": _by_type(analysis.demand_concentration),
    "n02_agency_pace": _on(enriched, lambda e: analysis.agency_pace(rollups.kpi_by_agency(e))),
    "n03_borough_pressure": _on(
        enriched, lambda e: analysis.borough_pressure(rollups.kpi_by_borough(e))
    ),
    "n04_weekly_rhythm": _on(enriched, lambda e: analysis.weekly_rhythm(rollups.kpi_weekly(e))),
    "n05_aging_backlog": _on(enriched, lambda e: analysis.aging_backlog(rollups.backlog_aging(e))),
    "n06_worst_sla": _by_type(lambda t: analysis.worst_sla(t, P)),
    "n06_worst_sla_floor_590": _by_type(lambda t: analysis.worst_sla(t, HIGH)),
    "n07_hotspots": _on(scores, analysis.hotspot_list),
    "n08_oldest_in_hotspots": _on(
        enriched, lambda e: analysis.oldest_in_hotspots(e, priority.priority_scores(e, P))
    ),
    "n09_channel_mix": _on(enriched, analysis.channel_mix),
    "n10_monthly_change": _on(enriched, analysis.monthly_change),
    # Workbook
    "sla_block_agency": _on(fractional, lambda e: workbook.sla_block(e, "agency", top_n=12)),
    "sla_block_borough": _on(
        fractional, lambda e: workbook.sla_block(e, "borough", values=ALL_BOROUGHS)
    ),
    "sla_block_type": _on(fractional, lambda e: workbook.sla_block(e, "complaint_type", top_n=15)),
    "sla_block_month": _on(
        fractional, lambda e: workbook.sla_block(e, "created_month", values=MONTHS)
    ),
    "sla_overall": sla_overall,
    "backlog_overall": backlog_overall,
    "aging_by_borough": _on(fractional, lambda e: crosstabs.aging_by_borough(e, ALL_BOROUGHS)),
    "weekly_flow": _on(fractional, lambda e: crosstabs.weekly_flow(e, FIRST_WEEK, LAST_WEEK)),
    "oldest_open": _on(fractional, workbook.oldest_open),
    "priority_grid": _on(fractional, _grid),
    "action_list": _on(fractional, lambda e: workbook.action_list(_grid(e))),
    "headline_kpis": _on(fractional, lambda e: workbook.headline(e, P)),
    "pivot_agency": _on(fractional, lambda e: crosstabs.pivot_report(e, "agency", avg_closure=True)),
    "pivot_type_top15": _on(
        fractional,
        lambda e: crosstabs.pivot_report(e, "complaint_type", top_n=15, avg_closure=True),
    ),
    "pivot_borough": _on(
        fractional, lambda e: crosstabs.pivot_report(e, "borough", avg_closure=True)
    ),
    "pivot_month": _on(fractional, lambda e: crosstabs.pivot_report(e, "created_month")),
    "pivot_week": _on(fractional, lambda e: crosstabs.pivot_report(e, "created_week", share=False)),
    "pivot_sla_status": _on(fractional, lambda e: crosstabs.pivot_report(e, "sla_status")),
    "top_agencies": _on(requests, lambda r: ranking.value_counts(r, "agency", 12)),
    # Dashboard tables
    "requests_per_day": _on(with_calendar, calendar.requests_per_day),
    "daily_requests": _on(enriched, crosstabs.daily_requests),
    "weekly_by_borough": _on(with_calendar, lambda f: crosstabs.weekly_by(f, "borough")),
    "weekly_top_types": _on(with_calendar, crosstabs.weekly_top_types),
    "closure_histogram": _on(enriched, crosstabs.closure_histogram),
    "closed_by_5_day_bins": _on(enriched, crosstabs.closed_by_day_bins),
    "score_matrix": _on(scores, lambda p: crosstabs.score_matrix(p, BOROUGHS)),
    "open_by_bucket": _on(
        enriched, lambda e: crosstabs.open_by_bucket(rollups.backlog_aging(e))
    ),
    "high_risk_backlog": _on(enriched, dashboard.high_risk),
    "hotspot_labels": _on(scores, dashboard.hotspot_labels),
    "hotspot_table": _on(scores, lambda p: dashboard.hotspot_table(p, OTHER_WEIGHTS)),
    "static_score_by_type": _on(scores, dashboard.static_scores),
    "score_components": _on(scores, dashboard.score_components),
    "busiest_agencies_by_miss_rate": _on(
        enriched, lambda e: dashboard.busiest_agencies_by_miss_rate(rollups.kpi_by_agency(e))
    ),
    "worst_types": _by_type(lambda t: dashboard.worst_types(t, P)),
    "placed_boroughs": _on(
        enriched, lambda e: dashboard.placed_boroughs(rollups.kpi_by_borough(e))
    ),
    # Measures under dimensions and slicers
    "measures_overall": _on(enriched, lambda e: measures.measure_query(e, [], ALL_MEASURES)),
    "measures_by_type": _on(
        enriched, lambda e: measures.measure_query(e, ["complaint_type"], ALL_MEASURES)
    ),
    "measures_top_types": _on(
        enriched,
        lambda e: measures.measure_query(
            e, ["complaint_type"], ["total_requests", "median_closure_days", "sla_miss_rate"],
            top=("total_requests", 15),
        ),
    ),
    "measures_by_agency_sliced": _on(
        enriched, lambda e: measures.measure_query(e, ["agency"], ALL_MEASURES, SLICERS)
    ),
    "measures_by_week": _on(
        with_calendar,
        lambda f: measures.measure_query(
            f, ["week_start"], ["total_requests", "closed_requests"],
        ),
    ),
    "share_by_borough": _on(
        enriched, lambda e: measures.share_of_total_requests(e, ["borough"])
    ),
    "share_by_channel_sliced": _on(
        enriched,
        lambda e: measures.share_of_total_requests(e, ["open_data_channel_type"], SLICERS),
    ),
    "month_over_month": _on(enriched, measures.month_over_month),
    "month_over_month_by_type": _on(
        enriched, lambda e: measures.month_over_month(e, ["complaint_type"])
    ),
    # What-if
    "whatif_default": _on(scores, priority.whatif),
    "whatif_other_weights": _on(scores, lambda p: priority.whatif(p, OTHER_WEIGHTS)),
    "whatif_by_type": _on(
        scores, lambda p: priority.whatif(p, OTHER_WEIGHTS, ["complaint_type"])
    ),
    "weight_sensitivity": _on(scores, priority.sensitivity),
    # Escalation and reconciliation
    "escalate_missing_targets": _on(scores, escalation.missing_targets),
    "escalate_growing_backlog": _on(enriched, lambda e: escalation.growing_backlog(e, P)),
    "aged_open_history": _on(requests, lambda r: escalation.aged_open_history(r, P)),
    "escalate_past_limit": _on(enriched, lambda e: escalation.past_limit(e, P)),
    "escalate_unspecified_share": _on(requests, escalation.unspecified_share),
    "new_hotspots": _on(
        requests,
        lambda r: escalation.new_entrants(r, orders.sla_targets(r.sparkSession), P, EARLIER),
    ),
    "artifact_candidates": _on(artifacts, candidates),
    "separate_lines": _on(
        artifacts, lambda e: escalation.separate_lines(e, candidates(e))
    ),
    "aged_open_by_week": _on(requests, lambda r: escalation.backlog_by_snapshot(r, P)),
    "totals_reconciliation": _on(
        enriched,
        lambda e: quality.reconcile_groupings(e, ["agency", "complaint_type", "borough"]),
    ),
    # All rollups from one scan
    **{f"one_scan_{name}": _from_one_scan(name) for name in ONE_SCAN},
    # Measures from a stored profile, calendar slices of the written fact
    "measures_overall_stored": _on(stored, lambda m: m.query([], ALL_MEASURES)),
    "measures_by_agency_sliced_stored": _on(
        stored, lambda m: m.query(["agency"], ALL_MEASURES, SLICERS)
    ),
    "share_by_channel_sliced_stored": _on(
        stored, lambda m: m.share_of_total_requests(["open_data_channel_type"], SLICERS)
    ),
    "month_over_month_by_type_stored": _on(
        stored, lambda m: m.month_over_month(["complaint_type"])
    ),
    "requests_in_chosen_weeks": in_chosen_weeks,
    # Exports
    "export_manifest": export_manifest,
    "exported_kpi_by_agency": exported_kpi_by_agency,
    "exported_fact": exported_fact,
}
