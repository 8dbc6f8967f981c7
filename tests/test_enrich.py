"""Edge rows of the derived columns."""

from datetime import date, datetime

import pytest

from caselens.operators import rollups
from caselens.operators.enrich import FRACTIONAL, enrich, rewind
from caselens.plans import analysis
from fixtures import PARAMS, at, by_key, days_before, frame, row, targets

COLUMNS = ("is_closed", "closure_days", "age_days", "sla_status", "aging_bucket")

CASES = {
    "sla edge": (at("06-01 23:00"), at("06-15 01:00"), (True, 14, None, "Met", None)),
    "one day late": (at("06-01"), at("06-16"), (True, 15, None, "Missed", None)),
    "across midnight": (at("06-01 23:00"), at("06-02 01:00"), (True, 1, None, "Met", None)),
    "open": (at("06-25"), None, (False, None, 10, "Open Within SLA", "8-30 days")),
    "reversed": (at("06-10"), at("06-09"), (False, None, 25, "Open Past SLA", "8-30 days")),
    "snapshot day": (at("07-01"), at("07-05 23:59"), (True, 4, None, "Met", None)),
    "snapshot + 1": (at("07-01"), at("07-06"), (False, 5, None, "Met", None)),
    "later": (at("07-01"), at("07-07"), (False, 6, None, "Met", None)),
    "no dates": (None, None, (False, None, None, "Open Past SLA", "180+ days")),
    "only closed": (None, at("06-01"), (None, None, None, "Open Past SLA", None)),
    "only closed late": (None, at("07-09"), (False, None, None, "Open Past SLA", None)),
    **{
        f"age {n}": (days_before(n), None, (False, None, n, status, bucket))
        for n, status, bucket in [
            (7, "Open Within SLA", "0-7 days"), (8, "Open Within SLA", "8-30 days"),
            (14, "Open Within SLA", "8-30 days"), (15, "Open Past SLA", "8-30 days"),
            (30, "Open Past SLA", "8-30 days"), (31, "Open Past SLA", "31-90 days"),
            (90, "Open Past SLA", "31-90 days"), (91, "Open Past SLA", "91-180 days"),
            (180, "Open Past SLA", "91-180 days"), (181, "Open Past SLA", "180+ days"),
        ]
    },
}


@pytest.fixture(scope="module")
def requests(spark):
    return frame(spark, [row(key, created, closed) for key, (created, closed, _) in CASES.items()])


def test_edge_rows(spark, requests):
    result = by_key(enrich(requests, targets(spark), PARAMS), *COLUMNS)
    assert result == {key: wanted for key, (_, _, wanted) in CASES.items()}


def test_result_does_not_depend_on_session_time_zone(spark, requests):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        result = by_key(enrich(requests, targets(spark), PARAMS), *COLUMNS, "created_week")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {k: v[:5] for k, v in result.items()} == {k: w for k, (_, _, w) in CASES.items()}
    assert result["sla edge"][5] == date(2026, 6, 1)


def test_schema_and_sla_lookup(spark):
    from caselens.sources import schemas

    rows = [row("a", at("06-01"), complaint_type="Rodent"), row("b", at("06-01")),
            row("c", at("06-01"), complaint_type=None)]
    result = enrich(frame(spark, rows), targets(spark, ("Rodent", 60, "")), PARAMS)
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in schemas.ENRICHED
    ]
    assert by_key(result, "sla_days", "sla_status") == {
        "a": (60, "Open Within SLA"), "b": (14, "Open Past SLA"), "c": (14, "Open Past SLA")
    }


def test_lookup_without_broadcast_gives_the_same_rows(spark, requests):
    lookup = targets(spark, ("Unlisted", 3, ""))
    first = sorted(enrich(requests, lookup, PARAMS).collect(), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        second = sorted(enrich(requests, lookup, PARAMS).collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert first == second


def test_duplicate_targets_are_refused(spark):
    with pytest.raises(ValueError):
        targets(spark, ("Rodent", 1, ""), ("Rodent", 2, ""))


def test_late_closures_in_backlog(spark, requests):
    """Open only because of the snapshot bound: a NULL bucket that sorts with the oldest."""
    aging = rollups.backlog_aging(enrich(requests, targets(spark), PARAMS))
    result = [tuple(r) for r in analysis.aging_backlog(aging).collect()]
    assert [r[0] for r in result] == [
        "0-7 days", "8-30 days", "31-90 days", "91-180 days", "180+ days", None
    ]
    assert result[-1][1] == 3


def test_unknown_closure_counts_nowhere(spark, requests):
    total, closed, open_ = (
        rollups.kpi_by_borough(enrich(requests, targets(spark), PARAMS))
        .select("total_requests", "closed_requests", "open_requests").first()
    )
    assert total == len(CASES) and closed + open_ == len(CASES) - 1


def test_miss_rate_is_null_without_known_outcomes(spark):
    result = enrich(frame(spark, [row("a", days_before(2))]), targets(spark), PARAMS)
    assert rollups.kpi_by_borough(result).first()["sla_miss_rate"] is None


def test_fractional_variant(spark):
    rows = [
        row("half", at("06-01 12:00"), at("06-02")),
        row("over", at("06-01 01:00"), at("06-15 02:00")),
        row("late", at("07-01"), at("07-07")),
        row("micro", datetime(2026, 6, 1, 0, 0, 0, 250_000), datetime(2026, 6, 1, 0, 0, 0, 500_000)),
        row("blank", None, at("06-01")),
    ]
    result = by_key(
        enrich(frame(spark, rows), targets(spark), PARAMS, variant=FRACTIONAL),
        "is_closed", "closure_days", "sla_status",
    )
    assert result["half"] == (True, 0.5, "Met")
    assert result["over"] == (True, 14 + 1 / 24, "Missed")
    assert result["late"] == (True, 6.0, "Met")
    assert result["micro"][1] == 0.25 / 86_400
    assert result["blank"][0] is False


def test_rewind(spark):
    rows = [
        row("closed since", at("06-01"), at("06-20")),
        row("closed then", at("06-01"), at("06-10 23:00")),
        row("not yet created", at("06-12")),
    ]
    result = by_key(rewind(frame(spark, rows), PARAMS.at(date(2026, 6, 10))), "closed_date")
    assert result == {"closed since": (None,), "closed then": (at("06-10 23:00"),)}
