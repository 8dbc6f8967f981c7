"""The ten analysis questions. Results are unordered unless a limit needs the order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselens.functions import pct
from caselens.operators import ranking, rollups
from caselens.operators.priority import CELL, hotspots
from caselens.operators.profile import is_open, is_placed
from caselens.params import ACTIVITY, Params


def demand_concentration(by_type: DataFrame, k: int = 15) -> DataFrame:
    """Largest complaint types; shares are of all types, taken before the limit."""
    shares = ranking.share_of_total(by_type, "total_requests", "pct_of_all")
    top = ranking.largest(shares, "total_requests", k, "complaint_type")
    return top.select("complaint_type", "primary_agency", "total_requests", "pct_of_all")


def agency_pace(by_agency: DataFrame, k: int = 15) -> DataFrame:
    return ranking.largest(by_agency, "total_requests", k, "agency").drop("aged_open_30d_plus")


def borough_pressure(by_borough: DataFrame) -> DataFrame:
    return by_borough.orderBy(F.col("total_requests").desc(), "borough")


def weekly_rhythm(weekly: DataFrame) -> DataFrame:
    return weekly.orderBy(F.col("created_week").asc_nulls_last())


def aging_backlog(aging: DataFrame) -> DataFrame:
    """Backlog per bucket in bucket order; the NULL bucket (closed later) sorts with the oldest."""
    per_bucket = aging.groupBy("aging_bucket").agg(F.sum("open_requests").alias("open_requests"))
    shares = ranking.share_of_total(per_bucket, "open_requests", "pct_of_backlog")
    bucket = F.col("aging_bucket")
    return shares.orderBy(rollups.bucket_order(bucket), bucket.asc_nulls_last())


def worst_sla(by_type: DataFrame, params: Params, k: int = 15) -> DataFrame:
    """Highest miss rates among types at or above the volume floor."""
    busy = by_type.filter(F.col("total_requests") >= params.volume_floor)
    top = ranking.largest(busy, "sla_miss_rate", k, "complaint_type")
    return top.select(
        "complaint_type", "primary_agency", "total_requests", "sla_miss_rate", "avg_closure_days",
        "open_requests",
    )


def hotspot_list(scores: DataFrame, k: int = 20) -> DataFrame:
    return ranking.smallest(scores, "priority_rank", k).select(
        "priority_rank", *CELL, "agency", "total_requests", "open_requests", "sla_miss_rate",
        "aged_share_of_open", "priority_score",
    )


def oldest_in_hotspots(
    enriched: DataFrame, scores: DataFrame, k: int = 25, top_cells: int = 10
) -> DataFrame:
    """Oldest open requests inside the highest-ranked cells (at most ``top_cells`` rows)."""
    hot = F.broadcast(hotspots(scores, top_cells).select(*CELL))
    waiting = enriched.filter(is_open()).join(hot, list(CELL), "left_semi")
    return ranking.largest(waiting, "age_days", k, "unique_key").select(
        "unique_key", *CELL, "agency", F.to_date("created_date").alias("created"), "age_days",
        "aging_bucket", "status",
    )


def channel_mix(enriched: DataFrame) -> DataFrame:
    counts = ranking.value_counts(enriched, "open_data_channel_type")
    return ranking.share_of_total(counts, "requests", "pct")


def monthly_change(enriched: DataFrame) -> DataFrame:
    """Change against the borough's previous row of the activity window (gaps are skipped)."""
    counts = (
        enriched.filter((F.col("slice") == ACTIVITY) & is_placed())
        .groupBy("borough", "created_month")
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    before = F.lag("requests").over(Window.partitionBy("borough").orderBy("created_month"))
    return counts.withColumn("mom_change_pct", pct(F.col("requests") - before, before, 1))


def answers(
    fact: DataFrame, params: Params, made: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """All ten questions. Seven of them only need the rollups ``made`` from one scan of the fact; the
    others read the few columns of the fact that they need."""
    made = made or rollups.from_one_scan(fact, params)
    by_type, scores = made["kpi_by_complaint_type"], made["priority_scores"]
    return {
        "n01_demand_concentration": demand_concentration(by_type),
        "n02_agency_pace": agency_pace(made["kpi_by_agency"]),
        "n03_borough_pressure": borough_pressure(made["kpi_by_borough"]),
        "n04_weekly_rhythm": weekly_rhythm(made["kpi_weekly"]),
        "n05_aging_backlog": aging_backlog(made["backlog_aging"]),
        "n06_worst_sla": worst_sla(by_type, params),
        "n07_hotspots": hotspot_list(scores),
        "n08_oldest_in_hotspots": oldest_in_hotspots(fact, scores),
        "n09_channel_mix": channel_mix(fact).orderBy(F.col("requests").desc()),
        "n10_monthly_change": monthly_change(fact).orderBy("borough", "created_month"),
    }
