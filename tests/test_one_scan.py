"""Reports that share a scan, a stored profile, a sweep over events, and counts of writes."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from caselens.operators import measures, profile, quality, rollups
from caselens.operators.priority import priority_scores
from caselens.plans import escalation, export
from caselens.sources import calendar, orders, tables
from checks import queries
from fixtures import PARAMS, at, frame, row, targets
from test_plans import executed, plan_of

P = orders.PARAMS


def scans(spark_frame):
    return [n for n in executed(spark_frame) if n.startswith("FileScan")]


@pytest.fixture(scope="module")
def fact(spark, data, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("fact"))
    return export.write_fact(queries.requests(spark, data), orders.sla_targets(spark), P, folder)


def as_bag(spark_frame):
    return sorted(map(repr, spark_frame.select(*sorted(spark_frame.columns)).collect()))


def test_all_rollups_come_from_one_scan(fact):
    _, ids, made = profile.grouped(fact, rollups.GROUPINGS)
    assert len(ids) == 5 and len(scans(made)) == 1
    nodes = executed(made)
    assert sum(n.startswith("Exchange") for n in nodes) == 1
    assert sum(n.startswith("Expand") for n in nodes) == 1
    for name, rollup in rollups.from_one_scan(fact, P).items():
        alone = (
            priority_scores(fact, P) if name == "priority_scores" else getattr(rollups, name)(fact)
        )
        assert as_bag(rollup) == as_bag(alone), name
        assert not any("created_month" in n for n in scans(rollup))


def test_groupings_with_equal_columns_are_refused(fact):
    same = {"a": profile.Grouping(("agency",)), "b": profile.Grouping(("agency",))}
    with pytest.raises(ValueError, match="same columns"):
        profile.grouped(fact, same)


def test_groups_of_no_value_are_not_those_of_other_groupings(spark):
    """A NULL agency is a group of its own, apart from the rows that other groupings expand to."""
    rows = [row("a", at("05-01"), agency=None), row("b", at("05-01"), borough=None)]
    made = rollups.from_one_scan(
        export.enrich(frame(spark, rows), targets(spark), PARAMS), PARAMS
    )
    found = {r.agency: r.total_requests for r in made["kpi_by_agency"].collect()}
    assert found[None] == 1 and sum(found.values()) == 2
    assert sum(r.total_requests for r in made["kpi_by_borough"].collect()) == 2


def test_no_requests_give_no_rollups(spark):
    empty = export.enrich(frame(spark, [row("a", None)]).limit(0), targets(spark), PARAMS)
    assert all(f.isEmpty() for f in rollups.from_one_scan(empty, PARAMS).values())


def test_no_request_is_sorted_for_the_counts(spark, fact):
    """The smallest label of a group must not turn the hash aggregate into one that sorts."""
    nodes = executed(profile.grouped(fact, rollups.GROUPINGS)[2])
    assert any(n.startswith("HashAggregate") for n in nodes)
    assert not any(n.startswith(("SortAggregate", "Sort ")) for n in nodes)


def test_labels_are_the_smallest_of_their_group(spark):
    """Several labels in a group, none at all, NULL groups, and labels that no other set has."""
    rows = [
        row("a", at("05-01"), agency="B", agency_name="y"), row("b", at("05-01"), agency="A"),
        row("c", at("05-01"), agency="B", agency_name="x"), row("d", at("05-01"), agency="B", agency_name="z"),
        row("e", at("05-01"), agency=None, agency_name=None, complaint_type=None),
        row("f", at("05-01"), agency="C", agency_name=None),
        row("g", at("05-01"), agency="B", agency_name="x", closed_date=at("05-03"), borough=None),
    ]
    fact = export.enrich(frame(spark, rows), targets(spark), PARAMS)
    for name, made in rollups.from_one_scan(fact, PARAMS).items():
        alone = (
            priority_scores(fact, PARAMS) if name == "priority_scores"
            else getattr(rollups, name)(fact)
        )
        assert as_bag(made) == as_bag(alone), name
    both = {
        "named": profile.Grouping(("agency",), False, {"name": "agency_name"}),
        "pairs": profile.Grouping(("agency", "agency_name")),
        "all": profile.Grouping((), True, {"first": "agency"}),
    }
    made = profile.profiles(fact, both)
    assert all(f.agg(F.sum("n")).first()[0] == len(rows) for f in made.values())
    assert {r["first"] for r in made["all"].collect()} == {"A"}
    least = made["named"].groupBy("agency").agg(F.min("name").alias("name"))
    names = {r.agency: r.name for r in least.collect()}
    assert names["B"] == "x" and names[None] is None and names["C"] is None


def test_totals_from_one_scan(fact):
    found = quality.reconcile_groupings(fact, ["agency", "complaint_type", "borough"])
    assert len(scans(found)) == 1
    rows = {tuple(r) for r in found.collect()}
    total = fact.count()
    assert rows == {(d, total, True) for d in ("agency", "complaint_type", "borough")}


# --- events --------------------------------------------------------------------------------------


def test_sweep_equals_the_counts_of_each_snapshot(spark, data):
    requests = queries.requests(spark, data)
    wide = escalation.aged_open_history(requests, P, weeks=3)
    wanted = {
        (r.complaint_type, r.borough, P.snapshot_date - timedelta(weeks=w), r[f"weeks_ago_{w}"])
        for r in wide.collect() for w in range(3)
    }
    for snapshots in (3, 52):
        found = escalation.backlog_by_snapshot(requests, P, snapshots)
        rows = {tuple(r) for r in found.collect()}
        assert len(rows) == found.count() and wanted <= rows
        assert snapshots > 3 or rows == wanted


@pytest.mark.parametrize("every", [1, 7, 30])
def test_sweep_by_brute_force(spark, every):
    days = ["01-05", "03-01", "04-04", "05-03", "05-04", "06-03", "06-04", "06-05", "07-01"]
    rows, number = [], 0
    for created in [None, *days]:
        for closed in [None, *days]:
            number += 1
            rows.append(row(str(number), at(created) if created else None,
                            closed_date=at(closed) if closed else None))
    requests = frame(spark, rows)
    found = {r.snapshot: r.aged_open
             for r in escalation.backlog_by_snapshot(requests, PARAMS, 9, every).collect()}
    pairs = [(r.created_date, r.closed_date) for r in requests.collect()]
    for back in range(9):
        day = PARAMS.snapshot_date - timedelta(days=every * back)
        assert found.pop(day) == sum(
            created is not None and (day - created.date()).days > PARAMS.bucket_bounds[1]
            and (closed is None or closed < created or closed.date() > day)
            for created, closed in pairs
        )
    assert not found


def test_plan_of_a_sweep_does_not_grow_with_its_snapshots(fact):
    few, many = (executed(escalation.backlog_by_snapshot(fact, P, n)) for n in (3, 500))
    assert len(few) == len(many)
    assert sum(n.startswith("FileScan") for n in many) == 1


# --- stored measures -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(fact, tmp_path_factory):
    return measures.Measures.store(fact, str(tmp_path_factory.mktemp("measures")))


QUESTIONS = {
    "overall": lambda m: m.query([], queries.ALL_MEASURES),
    "sliced": lambda m: m.query(["agency"], queries.ALL_MEASURES, queries.SLICERS),
    "by state": lambda m: m.query(["sla_status"], ["total_requests", "median_closure_days"]),
    "top": lambda m: m.query(["complaint_type"], ["total_requests"], top=("total_requests", 5)),
    "share": lambda m: m.share_of_total_requests(["borough"], queries.SLICERS),
    "months": lambda m: m.month_over_month(["borough"], {"open_data_channel_type": ["PHONE"]}),
}


@pytest.mark.parametrize("name", sorted(QUESTIONS))
def test_stored_measures_equal_those_of_the_fact(fact, stored, name):
    ask = QUESTIONS[name]
    found = ask(stored)
    assert as_bag(found) == as_bag(ask(measures.Measures(fact)))
    assert all("fact_service_requests" not in n for n in scans(found))


def test_other_columns_are_asked_of_the_fact(fact, stored):
    rows, counted = stored.source(["created_week"], {"borough": ["ASIA"]})
    assert rows is fact and not counted
    assert stored.source(["n"])[1] is False
    found = stored.query(["created_week"], ["total_requests"])
    assert any("fact_service_requests" in n for n in scans(found))
    assert sum(r.total_requests for r in found.collect()) == fact.count()


# --- calendar ------------------------------------------------------------------------------------


def test_chosen_weeks_prune_the_months_of_the_fact(spark, fact):
    days = calendar.dim_date(spark, P.backlog_start, P.window_end)
    chosen = calendar.in_calendar(fact, days, F.col("week_start") == F.lit("2001-05-14").cast("date"))
    assert "dynamicpruning" in plan_of(chosen)
    chosen.collect()
    scan = chosen._jdf.queryExecution().executedPlan()
    read = {r[0] for r in chosen.select(F.col("created_month")).distinct().collect()}
    assert {str(m) for m in read} == {"2001-05-01"}
    text = scan.toString()
    assert "dynamicpruning" in text
    files = chosen.select(F.input_file_name().alias("f")).distinct().count()
    assert files < len(fact.inputFiles())


def test_requests_without_a_day_keep_their_row(spark):
    requests = frame(spark, [row("a", at("05-01")), row("b", None)])
    made = export.enrich(requests, targets(spark), PARAMS)
    joined = calendar.attach_calendar(made, calendar.dim_date_covering(requests))
    found = {r.unique_key: r.date for r in joined.collect()}
    assert found["b"] is None and found["a"] is not None


# --- counts of writes ----------------------------------------------------------------------------


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    many = spark.range(10_000).repartition(7)
    for number, source in enumerate((many, many.limit(0), many.filter("id < 3"))):
        rows = tables.Rows()
        tables.write_csv(source, str(tmp_path / f"c{number}"), rows)
        assert rows.number() == source.count()
        rows = tables.Rows()
        path = tables.write_parquet(
            source.withColumn("k", F.col("id") % 5), str(tmp_path / f"p{number}"), "k", rows
        )
        assert rows.number() == source.count()
        assert path.endswith(f"p{number}")


def test_manifest_counts_no_table_again(spark, data, tmp_path):
    done = export.export_all(
        queries.requests(spark, data), orders.sla_targets(spark), P, str(tmp_path)
    )
    assert scans(done.manifest) == []
    for r in done.manifest.collect():
        assert export.read_export(spark, str(tmp_path), r.table_name).count() == r.row_count
