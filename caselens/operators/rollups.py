"""KPI rollups and backlog aging over the enriched frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.operators import profile as p
from caselens.operators.priority import CELL, priority_scores
from caselens.params import ACTIVITY, BUCKETS, Params


def core_measures(*, median: bool, accuracy: int | None = None) -> dict[str, Column]:
    """The measures of a rollup; with an ``accuracy`` the median comes from a sketch."""
    measures = {
        "total_requests": p.rows_where(),
        "closed_requests": p.rows_where(F.col("is_closed")),
        "open_requests": p.rows_where(p.is_open()),
        "avg_closure_days": p.mean_closure(1),
    }
    if median:
        measures["median_closure_days"] = (
            p.median_closure(1) if accuracy is None else p.sketched_median(accuracy, 1)
        )
    measures["sla_miss_rate"] = p.miss_rate()
    measures["aged_open_30d_plus"] = p.rows_where(p.is_aged())
    return measures


# Each rollup takes the enriched frame or, if ``counted``, a profile of it by at least its dimensions.
# An ``accuracy`` is for the enriched frame only.


def kpi_by_agency(
    rows: DataFrame, counted: bool = False, accuracy: int | None = None
) -> DataFrame:
    return p.summarise(
        rows, ["agency"], core_measures(median=True, accuracy=accuracy), median=accuracy is None,
        labels={"agency_name": "agency_name"}, counted=counted,
    )


def kpi_by_complaint_type(
    rows: DataFrame, counted: bool = False, accuracy: int | None = None
) -> DataFrame:
    label = "primary_agency" if counted else "agency"
    return p.summarise(
        rows, ["complaint_type"], core_measures(median=True, accuracy=accuracy), median=accuracy is None,
        labels={"primary_agency": label}, counted=counted,
    )


def kpi_by_borough(rows: DataFrame, counted: bool = False) -> DataFrame:
    return p.summarise(rows, ["borough"], core_measures(median=False), counted=counted)


def kpi_weekly(rows: DataFrame, counted: bool = False) -> DataFrame:
    """Weekly demand against closure, activity slice only so that both series are complete."""
    return p.summarise(
        rows.filter(F.col("slice") == ACTIVITY),
        ["created_week"],
        {
            "requests_created": p.rows_where(),
            "eventually_closed": p.rows_where(F.col("is_closed")),
            "still_open": p.rows_where(p.is_open()),
            "avg_closure_days": p.mean_closure(1),
            "sla_miss_rate": p.miss_rate(),
        },
        counted=counted,
    )


def backlog_aging(rows: DataFrame, counted: bool = False) -> DataFrame:
    """Open requests per bucket and borough. Late closures appear under a NULL bucket."""
    return p.summarise(
        rows.filter(p.is_open()),
        ["aging_bucket", "borough"],
        {"open_requests": p.rows_where(), "avg_age_days": p.mean_age(0)},
        counted=counted,
    )


# What the six rollups are made from.
GROUPINGS = {
    "agency": p.Grouping(("agency",), True, {"agency_name": "agency_name"}),
    "type": p.Grouping(("complaint_type",), True, {"primary_agency": "agency"}),
    "borough": p.Grouping(("borough",)),
    "week": p.Grouping(("slice", "created_week")),
    "cell": p.Grouping(CELL, False, {"agency": "agency"}),
}


def from_one_scan(enriched: DataFrame, params: Params) -> dict[str, DataFrame]:
    """All six rollups from one scan of the fact. Requests are counted at once by agency, by type, by
    borough, by week and by cell; each rollup is made from the counts, never from the requests."""
    made = p.profiles(enriched, GROUPINGS)
    return {
        "kpi_by_agency": kpi_by_agency(made["agency"], counted=True),
        "kpi_by_complaint_type": kpi_by_complaint_type(made["type"], counted=True),
        "kpi_by_borough": kpi_by_borough(made["borough"], counted=True),
        "kpi_weekly": kpi_weekly(made["week"], counted=True),
        "backlog_aging": backlog_aging(made["borough"], counted=True),
        "priority_scores": priority_scores(made["cell"], params, counted=True),
    }


def bucket_order(bucket: Column) -> Column:
    """Sort key 1..5; anything that is not one of the first four buckets sorts last."""
    key = F
    for position, label in enumerate(BUCKETS[:-1], 1):
        key = key.when(bucket == label, position)
    return key.otherwise(len(BUCKETS))
