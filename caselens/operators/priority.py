"""Priority model: score complaint type x borough cells, what-if weights, rank changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.functions import round_half
from caselens.operators import profile as p
from caselens.params import Params, Weights

CELL = ("complaint_type", "borough")


def cells(
    enriched: DataFrame, params: Params, by: Sequence[str] = (),
    more: Mapping[str, Column] | None = None, counted: bool = False,
) -> DataFrame:
    """Counts and rates per cell (and ``by``), without Unspecified boroughs and small cells.

    ``more`` names further measures that the same aggregation gives. ``counted`` says that the rows
    are a profile by cell, not requests.
    """
    measures = {
        "total_requests": p.rows_where(),
        "open_requests": p.rows_where(p.is_open()),
        "sla_miss_rate": p.miss_rate(),
        "aged_share_of_open": p.aged_share(),
    }
    summary = p.summarise(
        enriched.filter(p.is_placed()), [*by, *CELL], {**measures, **(more or {})},
        labels={"agency": "agency"}, counted=counted,
    )
    return summary.filter(F.col("total_requests") >= params.min_cell)


def percentile_of(measure: str, by: Sequence[str] = ()) -> Column:
    """Percent rank over all cells. Cells are bounded by types x boroughs, so one task is enough."""
    return F.percent_rank().over(Window.partitionBy(*by).orderBy(measure))


def blend(weights: Weights, volume: Column, backlog: Column, miss: Column, aged: Column) -> Column:
    return (
        F.lit(weights.volume) * volume
        + F.lit(weights.backlog) * backlog
        + F.lit(weights.miss) * miss
        + F.lit(weights.aged) * aged
    )


def score_cells(
    cell_frame: DataFrame, params: Params, by: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Scores use unrounded percentiles but rounded rates; NULL rates count as 0.

    Cells are ranked by descending score, then by cell, apart for each ``by``; columns to ``keep``
    are passed on.
    """
    zero = F.lit(0.0)
    miss = F.coalesce("sla_miss_rate", zero)
    aged = F.coalesce("aged_share_of_open", zero)
    with_percentiles = cell_frame.withColumns(
        {
            "_volume": percentile_of("total_requests", by),
            "_backlog": percentile_of("open_requests", by),
        }
    )
    score = blend(
        params.weights.require_unit_sum(), F.col("_volume"), F.col("_backlog"), miss, aged
    )
    order = Window.partitionBy(*by).orderBy(F.col("priority_score").desc(), *CELL)
    scored = with_percentiles.select(
        *by,
        *keep,
        "complaint_type",
        "borough",
        "agency",
        "total_requests",
        "open_requests",
        "sla_miss_rate",
        aged.alias("aged_share_of_open"),
        round_half(F.col("_volume"), 4).alias("volume_percentile"),
        round_half(F.col("_backlog"), 4).alias("backlog_percentile"),
        round_half(score, 4).alias("priority_score"),
    )
    return scored.withColumn("priority_rank", F.row_number().over(order).cast("bigint"))


def priority_scores(enriched: DataFrame, params: Params, counted: bool = False) -> DataFrame:
    return score_cells(cells(enriched, params, counted=counted), params)


def hotspots(scores: DataFrame, k: int) -> DataFrame:
    return scores.filter(F.col("priority_rank") <= k)


# --- what-if -------------------------------------------------------------------------------------


_COMPONENTS = ("volume_percentile", "backlog_percentile", "sla_miss_rate", "aged_share_of_open")


def _dynamic(components: Sequence[Column], weights: Sequence[Column]) -> Column:
    """Weighted mean of the components; NULL when the weights add up to 0. A blank adds nothing.

    Given to 9 digits, so that equal cells tie whatever the order of summation.
    """
    parts = [w * F.coalesce(c, F.lit(0.0)) for w, c in zip(weights, components)]
    total = weights[0] + weights[1] + weights[2] + weights[3]
    return round_half(F.try_divide(parts[0] + parts[1] + parts[2] + parts[3], total), 9)


def whatif(scores: DataFrame, weights: Weights = Weights(), dims: Sequence[str] = CELL) -> DataFrame:
    """Score and dense rank of each ``dims`` group under other weights. Never reads the fact."""
    score = _dynamic(
        [F.avg(name) for name in _COMPONENTS], [F.lit(w) for w in asdict(weights).values()]
    )
    order = Window.orderBy(F.col("_score").desc_nulls_last())
    return scores.groupBy(*dims).agg(score.alias("_score")).select(
        *dims,
        round_half(F.col("_score"), 4).alias("dynamic_score"),
        F.dense_rank().over(order).cast("bigint").alias("dynamic_rank"),
    )


# A slider has this many steps from 0 to 1.
STEPS = 20


def weight_step(step: Column) -> Column:
    """Value of a what-if parameter at a step: 0, 0.05 .. 1."""
    return step / F.lit(float(STEPS))


def sensitivity(scores: DataFrame, base: Weights = Weights()) -> DataFrame:
    """Re-rank every cell under each slider position and report the rank change against base.

    Every cell row is expanded by four sliders of 21 steps (array literals, no join) and scored in
    place; the ranking runs in 84 independent groups of cells.
    """
    defaults = asdict(base)
    expanded = scores.withColumn(
        "slider", F.explode(F.array(*map(F.lit, defaults)))
    ).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(STEPS))))
    weights = [
        F.when(F.col("slider") == name, weight_step(F.col("step"))).otherwise(F.lit(value))
        for name, value in defaults.items()
    ]
    score = _dynamic([F.col(name) for name in _COMPONENTS], weights)
    order = Window.partitionBy("slider", "step").orderBy(F.col("_score").desc_nulls_last())
    rank = F.dense_rank().over(order).cast("bigint")
    return expanded.withColumn("_score", score).withColumn("dynamic_rank", rank).select(
        "slider", "step", *CELL, round_half(F.col("_score"), 4).alias("dynamic_score"),
        "dynamic_rank", (F.col("dynamic_rank") - F.col("priority_rank")).alias("rank_change"),
    )
