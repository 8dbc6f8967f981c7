"""Crosstabs, time series, histograms and pivot-style reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselens.functions import pct, round_half
from caselens.operators import profile as p
from caselens.operators.priority import CELL
from caselens.operators.ranking import largest, whole
from caselens.operators.rollups import bucket_order
from caselens.params import ACTIVITY, BUCKETS


def _name(value: str) -> str:
    return value.lower().replace(" ", "_")


def aging_by_borough(enriched: DataFrame, boroughs: Sequence[str]) -> DataFrame:
    """Open requests per bucket (rows, all five) and borough (columns) with a row total."""
    counts = (
        enriched.filter(F.col("aging_bucket").isNotNull())
        .groupBy("aging_bucket")
        .pivot("borough", list(boroughs))
        .agg(F.count(F.lit(1)))
    )
    rows = enriched.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, BUCKETS))).alias("aging_bucket")
    )
    filled = rows.join(counts, "aging_bucket", "left")
    cells = [F.coalesce(F.col(f"`{b}`"), F.lit(0)).alias(_name(b)) for b in boroughs]
    total = sum((F.col(_name(b)) for b in boroughs[1:]), F.col(_name(boroughs[0])))
    return filled.select("aging_bucket", *cells).withColumn("total", total)


def weekly_flow(enriched: DataFrame, first_week, last_week) -> DataFrame:
    """Created, closed and open per week, over both slices; weeks without requests show zeros."""
    measures = {
        "created": p.rows_where(),
        "closed_by_snapshot": p.rows_where(F.col("is_closed")),
        "still_open": p.rows_where(p.is_open()),
    }
    inside = F.col("created_week").between(F.lit(first_week), F.lit(last_week))
    counts = p.summarise(enriched.filter(inside), ["created_week"], measures)
    every = F.sequence(F.lit(first_week), F.lit(last_week), F.expr("interval 7 days"))
    weeks = enriched.sparkSession.range(1).select(F.explode(every).alias("created_week"))
    return weeks.join(counts, "created_week", "left").fillna(0, list(measures))


def pivot_report(
    enriched: DataFrame, field: str, *, top_n: int | None = None, share: bool = True,
    avg_closure: bool = False,
) -> DataFrame:
    """Requests per value of ``field`` with share, mean closure time and a grand total row.

    With ``top_n`` only the largest values stay, and shares and totals cover just those.
    ``level`` is 0 for a value and 1 for the grand total; order by (level, requests desc, field).
    """
    per_value = p.summarise(
        enriched, [field],
        {"n": p.rows_where(), "closure_n": F.sum("closure_n"), "closure_sum": F.sum("closure_sum")},
    )
    if top_n is not None:
        per_value = largest(per_value, "n", top_n, field)
    rows = per_value.rollup(field).agg(
        F.grouping_id().cast("int").alias("level"),
        p.rows_where().alias("requests"),
        p.mean_closure(1).alias("avg_closure_days"),
    )
    total = F.max(F.when(F.col("level") == 1, F.col("requests"))).over(whole())
    columns = [F.col(field), F.col("level"), F.col("requests")]
    if share:
        columns.append(pct(F.col("requests"), total, 1).alias("pct_of_total"))
    if avg_closure:
        columns.append(F.col("avg_closure_days"))
    return rows.select(*columns)


def daily_requests(enriched: DataFrame) -> DataFrame:
    """Requests per created day of the activity slice."""
    day = F.to_date("created_date").alias("created_day")
    return (
        enriched.filter(F.col("slice") == ACTIVITY)
        .groupBy(day)
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def weekly_by(fact: DataFrame, dimension: str) -> DataFrame:
    """Requests per calendar week and one dimension; ``fact`` carries the calendar columns."""
    return fact.groupBy("week_start", dimension).agg(F.count(F.lit(1)).alias("requests"))


def weekly_top_types(fact: DataFrame, k: int = 5) -> DataFrame:
    """Weekly mix of the ``k`` largest complaint types, as a share of those types per week."""
    counts = weekly_by(fact, "complaint_type")
    totals = counts.groupBy("complaint_type").agg(F.sum("requests").alias("_total"))
    leaders = F.broadcast(largest(totals, "_total", k, "complaint_type"))
    kept = counts.join(leaders, "complaint_type", "left_semi")
    per_week = F.sum("requests").over(Window.partitionBy("week_start"))
    return kept.select(
        "week_start", "complaint_type", "requests",
        pct(F.col("requests"), per_week, 1).alias("pct_of_week"),
    )


def closure_histogram(enriched: DataFrame, cap: int = 60, bins: int = 30) -> DataFrame:
    """Equal-width bins over capped closure days, from the smallest to the largest value.

    Days are capped and counted first, so the bin edges are found on at most ``cap + 1`` rows
    (negative durations do not occur). The last bin includes its upper edge; empty bins are kept.
    """
    days = (
        enriched.filter(F.col("closure_days").isNotNull())
        .groupBy(F.least(F.col("closure_days"), F.lit(cap)).alias("days"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    low, high = F.min("days").over(whole()), F.max("days").over(whole())
    # A single value gets one day of width around it.
    spread = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    edged = days.withColumns(
        {"_low": low.cast("double") - spread, "_high": high.cast("double") + spread}
    )
    place = F.floor((F.col("days") - F.col("_low")) * bins / (F.col("_high") - F.col("_low")))
    counts = (
        edged.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
        .groupBy("_low", "_high", "bin")
        .agg(F.sum("n").alias("n"))
        .groupBy("_low", "_high")
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_counts"))
    )
    width = (F.col("_high") - F.col("_low")) / bins
    return counts.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "bin",
        round_half(F.col("_low") + width * F.col("bin"), 4).alias("from_days"),
        round_half(F.col("_low") + width * (F.col("bin") + 1), 4).alias("to_days"),
        F.coalesce(F.try_element_at("_counts", F.col("bin")), F.lit(0)).alias("requests"),
    )


def closed_by_day_bins(enriched: DataFrame, width: int = 5) -> DataFrame:
    """Closed requests in groups of ``width`` closure days."""
    start = (F.floor(F.col("closure_days") / width) * width).cast("bigint").alias("from_days")
    return (
        enriched.filter(F.col("is_closed") & F.col("closure_days").isNotNull())
        .groupBy(start)
        .agg(F.count(F.lit(1)).alias("closed_requests"))
    )


def score_matrix(scores: DataFrame, boroughs: Sequence[str], top_types: int = 10) -> DataFrame:
    """Scores of the types with the highest maximum, one column per borough."""
    best = F.max("priority_score").over(Window.partitionBy("complaint_type"))
    matrix = (
        scores.withColumn("max_score", best)
        .groupBy("complaint_type", "max_score")
        .pivot("borough", list(boroughs))
        .agg(F.avg("priority_score"))
    )
    columns = [F.col(f"`{b}`").alias(_name(b)) for b in boroughs]
    return largest(matrix, "max_score", top_types, "complaint_type").select(
        "complaint_type", "max_score", *columns
    )


def open_by_bucket(aging: DataFrame) -> DataFrame:
    """Open requests per bucket from ``backlog_aging``, with the presentation order."""
    bucket = F.col("aging_bucket")
    return (
        aging.filter(bucket.isNotNull())
        .groupBy("aging_bucket")
        .agg(F.sum("open_requests").alias("open_requests"))
        .withColumn("bucket_order", bucket_order(bucket))
    )


def dense_grid(
    cell_frame: DataFrame, boroughs: Sequence[str], top_types: int
) -> DataFrame:
    """Every top type x every borough, with zero counts where a cell has no requests.

    ``cell_frame`` holds all cells, those without a listed borough too, so types are ranked by it.
    """
    totals = cell_frame.groupBy("complaint_type").agg(F.sum("total").alias("_requests"))
    leaders = largest(totals, "_requests", top_types, "complaint_type").select("complaint_type")
    grid = leaders.withColumn("borough", F.explode(F.array(*map(F.lit, boroughs))))
    counts = [name for name in cell_frame.columns if name not in CELL]
    return grid.join(cell_frame, list(CELL), "left").fillna(0, counts)

