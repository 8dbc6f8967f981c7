"""Measure catalogue: named aggregates evaluated under any dimensions and slicers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.functions import any_of, ratio
from caselens.operators import profile as p
from caselens.operators.ranking import largest, whole
from caselens.sources.tables import write_parquet


def catalogue() -> dict[str, Column]:
    """Measures over a request profile. Ratios are left unrounded; they are NULL over 0."""
    total, closed = p.rows_where(), p.rows_where(F.col("is_closed"))
    open_, aged = p.rows_where(p.is_open()), p.rows_where(p.is_aged())
    missed, known = p.rows_where(p.is_missed()), p.rows_where(p.is_known())
    return {
        "total_requests": total,
        "closed_requests": closed,
        "open_requests": open_,
        "backlog_count": open_,
        "closure_rate": ratio(closed, total),
        "avg_closure_days": p.mean_closure(None),
        "median_closure_days": p.median_closure(None),
        "sla_missed": missed,
        "sla_outcomes_known": known,
        "sla_miss_rate": ratio(missed, known),
        "aging_backlog_count": aged,
        "aged_share_of_backlog": ratio(aged, open_),
    }


def sliced(frame: DataFrame, slicers: Mapping[str, Sequence]) -> DataFrame:
    """Keep rows whose column value is among the chosen ones, for every slicer."""
    for name, values in slicers.items():
        frame = frame.filter(any_of(F.col(name), values))
    return frame


def measure_query(
    enriched: DataFrame,
    dims: Sequence[str],
    measures: Sequence[str],
    slicers: Mapping[str, Sequence] | None = None,
    top: tuple[str, int] | None = None,
    counted: bool = False,
) -> DataFrame:
    """Evaluate catalogue measures per dimension combination after the slicers.

    ``top=(measure, k)`` keeps the ``k`` largest groups by one of the measures, in that order.
    ``counted`` says that the rows are a profile, not requests.
    """
    known = catalogue()
    unknown = set(measures) - set(known)
    if unknown:
        raise KeyError(f"unknown measures: {sorted(unknown)}")
    result = p.summarise(
        sliced(enriched, slicers or {}), list(dims), {name: known[name] for name in measures},
        median="median_closure_days" in measures, counted=counted,
    )
    return result if top is None else largest(result, *top, *dims)


def share_of_total_requests(
    enriched: DataFrame, dims: Sequence[str], slicers: Mapping[str, Sequence] | None = None,
    counted: bool = False,
) -> DataFrame:
    """Each group's share of all requests that pass the slicers."""
    totals = measure_query(enriched, dims, ["total_requests"], slicers, counted=counted)
    whole_count = F.sum("total_requests").over(whole())
    return totals.withColumn("share_of_total", ratio(F.col("total_requests"), whole_count))


def month_over_month(
    enriched: DataFrame, dims: Sequence[str] = (), slicers: Mapping[str, Sequence] | None = None,
    counted: bool = False,
) -> DataFrame:
    """Requests against the previous calendar month; NULL when that month has no rows.

    Joins the monthly totals to themselves. A month without requests is a gap, unlike in a row lag;
    up to the last month with data, one that follows a month with requests shows them against 0.
    """
    keys = [*dims, "created_month"]
    now = measure_query(enriched, keys, ["total_requests"], slicers, counted=counted)
    before = now.filter(F.col("created_month").isNotNull()).select(
        *dims,
        F.add_months("created_month", 1).alias("created_month"),
        F.col("total_requests").alias("requests_previous_month"),
    )
    change = F.col("total_requests") - F.col("requests_previous_month")
    # Months are few: bounded by the calendar and the dimensions.
    last = F.max(F.when(F.col("total_requests").isNotNull(), F.col("created_month"))).over(whole())
    both = now.join(before, keys, "full").withColumn("_last", last)
    known = F.col("total_requests").isNotNull() | (F.col("created_month") <= F.col("_last"))
    return both.filter(known).drop("_last").fillna(0, ["total_requests"]).withColumn(
        "mom_change", ratio(change, F.col("requests_previous_month"))
    )


# What a dashboard slices by; state columns are kept in any case.
SLICER_COLUMNS = (
    "agency", "complaint_type", "borough", "open_data_channel_type", "slice", "created_month",
)


class Measures:
    """Measure queries under slicers that need not read the requests each time.

    A stored profile holds additive states, counts and sums by the slicer columns and closure_days,
    so every measure of the catalogue, the exact median too, follows from it. A query whose
    dimensions and slicers it has is answered from it, any other one from the fact.
    """

    def __init__(self, fact: DataFrame, stored: DataFrame | None = None):
        self.fact, self.stored = fact, stored

    @classmethod
    def store(
        cls, fact: DataFrame, path: str, columns: Sequence[str] = SLICER_COLUMNS
    ) -> "Measures":
        """Count the requests once, write the counts to ``path``, and answer from there."""
        made = p.profile(fact, columns, by_closure_days=True)
        write_parquet(made, path)
        return cls(fact, fact.sparkSession.read.schema(made.schema).parquet(path))

    def source(
        self, dims: Sequence[str], slicers: Mapping[str, Sequence] | None = None
    ) -> tuple[DataFrame, bool]:
        """What answers a query, and whether it is the stored profile."""
        wanted = {*dims, *(slicers or {})}
        if self.stored is not None and wanted <= set(self.stored.columns) - set(p.SUMS):
            return self.stored, True
        return self.fact, False

    def query(
        self, dims: Sequence[str], measures: Sequence[str],
        slicers: Mapping[str, Sequence] | None = None, top: tuple[str, int] | None = None,
    ) -> DataFrame:
        rows, counted = self.source(dims, slicers)
        return measure_query(rows, dims, measures, slicers, top, counted)

    def share_of_total_requests(
        self, dims: Sequence[str], slicers: Mapping[str, Sequence] | None = None
    ) -> DataFrame:
        rows, counted = self.source(dims, slicers)
        return share_of_total_requests(rows, dims, slicers, counted)

    def month_over_month(
        self, dims: Sequence[str] = (), slicers: Mapping[str, Sequence] | None = None
    ) -> DataFrame:
        rows, counted = self.source([*dims, "created_month"], slicers)
        return month_over_month(rows, dims, slicers, counted)
