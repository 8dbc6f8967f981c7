"""Dashboard tables that are more than one measure under some dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.operators import profile as p
from caselens.operators import ranking
from caselens.operators.priority import CELL, whatif
from caselens.params import BUCKETS, UNSPECIFIED, Params, Weights


def high_risk(enriched: DataFrame) -> DataFrame:
    """All open requests in the oldest bucket."""
    return enriched.filter(p.is_open() & (F.col("aging_bucket") == BUCKETS[-1])).select(
        "unique_key", *CELL, "agency", "created_date", "age_days", "status"
    )


def hotspot_labels(scores: DataFrame, k: int = 5, width: int = 22) -> DataFrame:
    """Top cells with a short label "type · borough"."""
    label = F.concat_ws(" · ", F.substring("complaint_type", 1, width), "borough")
    return ranking.smallest(scores, "priority_rank", k).select(
        "priority_rank", label.alias("label"), "priority_score"
    )


def hotspot_table(scores: DataFrame, weights: Weights = Weights(), k: int = 10) -> DataFrame:
    """Cells up to dynamic rank ``k`` under the chosen weights (ties share a rank)."""
    shown = [*CELL, "agency", "total_requests", "open_requests", "sla_miss_rate"]
    return whatif(scores, weights, shown).filter(F.col("dynamic_rank") <= k)


def static_scores(scores: DataFrame, dimension: str = "complaint_type") -> DataFrame:
    """Highest base score per value of a dimension."""
    return scores.groupBy(dimension).agg(F.max("priority_score").alias("priority_score"))


def score_components(scores: DataFrame, k: int = 10) -> DataFrame:
    """Top cells with the components of their score."""
    return ranking.smallest(scores, "priority_rank", k).select(
        "priority_rank", *CELL, "open_requests", "sla_miss_rate", "volume_percentile",
        "backlog_percentile", "aged_share_of_open", "priority_score",
    )


def busiest_agencies_by_miss_rate(by_agency: DataFrame, k: int = 12) -> DataFrame:
    """Miss rate of the ``k`` largest agencies."""
    return ranking.largest(by_agency, "total_requests", k, "agency").select(
        "agency", "total_requests", "sla_miss_rate"
    )


def worst_types(by_type: DataFrame, params: Params, k: int = 10) -> DataFrame:
    """Highest miss rates among types at or above the volume floor."""
    busy = by_type.filter(F.col("total_requests") >= params.volume_floor)
    return ranking.largest(busy, "sla_miss_rate", k, "complaint_type").select(
        "complaint_type", "total_requests", "sla_miss_rate"
    )


def placed_boroughs(by_borough: DataFrame) -> DataFrame:
    return by_borough.filter(F.col("borough") != UNSPECIFIED).select("borough", "total_requests")
