"""Reports of the analyst workbook: SLA blocks, backlog KPIs, dense priority grid, action list.

They take a frame enriched with ``variant="fractional"`` to reproduce the spreadsheet definitions,
or the default variant for the full-population ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.functions import any_of, ratio, round_half
from caselens.operators import crosstabs, ranking
from caselens.operators import profile as p
from caselens.operators.priority import CELL, blend
from caselens.params import Params


def _block() -> dict[str, Column]:
    return {
        "total": p.rows_where(),
        "closed": p.rows_where(F.col("is_closed")),
        "open": p.rows_where(p.is_open()),
        "sla_missed": p.rows_where(p.is_missed()),
        "sla_known": p.rows_where(p.is_known()),
        "sla_miss_rate": p.miss_rate(4),
        "avg_closure_days": p.mean_closure(1),
    }


def sla_block(
    enriched: DataFrame, dimension: str, *, top_n: int | None = None,
    values: Sequence | None = None,
) -> DataFrame:
    """SLA figures per value of one dimension, for its ``top_n`` largest or the listed values.

    A listed value without requests has a row too: its counts are 0, its rates NULL.
    """
    if values is None:
        block = p.summarise(enriched, [dimension], _block())
        return block if top_n is None else ranking.largest(block, "total", top_n, dimension)
    block = p.summarise(enriched.filter(any_of(F.col(dimension), values)), [dimension], _block())
    kind = enriched.schema[dimension].dataType
    listed = enriched.sparkSession.range(1).select(
        F.explode(F.array(*(F.lit(v).cast(kind) for v in values))).alias("_listed")
    )
    same = F.col("_listed").eqNullSafe(F.col(dimension))
    counts = ["total", "closed", "open", "sla_missed", "sla_known"]
    return (
        listed.join(block, same, "left").fillna(0, counts)
        .select(F.col("_listed").alias(dimension), *_block())
    )


def sla_overall(enriched: DataFrame, scale: Column | float = 1.0) -> DataFrame:
    """Overall SLA figures; ``scale`` grosses a sample up to the population."""
    measures = {name: _block()[name] for name in ("total", "sla_missed", "sla_known")}
    measures["sla_miss_rate"] = p.miss_rate(4)
    measures["estimated_missed"] = round_half(
        p.rows_where(p.is_missed()).cast("double") * F.lit(scale), 0
    )
    return p.summarise(enriched, [], measures)


def backlog_overall(enriched: DataFrame, params: Params, scale: Column | float = 1.0) -> DataFrame:
    """Open requests, their share, age thresholds, mean age and the grossed-up estimate.

    The thresholds read ages, not buckets; a request closed after the snapshot has no age.
    """
    age, open_ = F.col("age_days"), p.is_open()
    _, second, third, fourth = params.bucket_bounds
    total, waiting = F.count(F.lit(1)), F.count_if(open_)
    return enriched.agg(
        waiting.alias("open_requests"),
        ratio(waiting, total, 4).alias("share_open"),
        F.count_if(open_ & (age > second)).alias("open_31_plus"),
        F.count_if(open_ & (age > third)).alias("open_91_plus"),
        F.count_if(open_ & (age > fourth)).alias("open_181_plus"),
        round_half(F.avg(F.when(open_, age)), 1).alias("avg_age_days"),
        round_half(waiting.cast("double") * F.lit(scale), 0).alias("estimated_open"),
    )


def oldest_open(enriched: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` oldest open requests, numbered; equal ages are ordered by key."""
    oldest = ranking.largest(enriched.filter(p.is_open()), "age_days", k, "unique_key").select(
        "age_days", "unique_key", "complaint_type", "borough", "agency"
    )
    order = Window.orderBy(F.col("age_days").desc_nulls_last(), "unique_key")
    return oldest.withColumn("rank", F.row_number().over(order).cast("bigint"))


def _cut_3(value: Column) -> Column:
    """Spreadsheet percent ranks keep three digits, cut off, not rounded.

    The tiny addend keeps exact thousandths such as 0.29 (stored just below) from losing a digit.
    """
    return F.floor(value * 1000 + F.lit(1e-9)) / F.lit(1000.0)


def priority_grid(
    enriched: DataFrame, params: Params, boroughs: Sequence[str], top_types: int = 15,
    cut_percentiles: bool = True,
) -> DataFrame:
    """Dense grid of the top types x boroughs; missing cells are zero, ranks are shared on ties."""
    counts = p.summarise(
        enriched, CELL,
        {
            "total": p.rows_where(),
            "open": p.rows_where(p.is_open()),
            "sla_missed": p.rows_where(p.is_missed()),
            "sla_known": p.rows_where(p.is_known()),
            "aged_open": p.rows_where(
                p.is_open() & (F.col("age_days") > params.bucket_bounds[1])
            ),
        },
    )
    zero = F.lit(0.0)
    grid = crosstabs.dense_grid(counts, boroughs, top_types).withColumns(
        {
            "_miss": F.coalesce(ratio(F.col("sla_missed"), F.col("sla_known")), zero),
            "_aged": F.coalesce(ratio(F.col("aged_open"), F.col("open")), zero),
            "_volume": F.percent_rank().over(Window.orderBy("total")),
            "_backlog": F.percent_rank().over(Window.orderBy("open")),
        }
    )
    if cut_percentiles:
        grid = grid.withColumns({name: _cut_3(F.col(name)) for name in ("_volume", "_backlog")})
    score = blend(
        params.weights.require_unit_sum(), F.col("_volume"), F.col("_backlog"), F.col("_miss"),
        F.col("_aged"),
    )
    # Ranks compare scores to 9 digits: equal cells must tie whatever the order of summation.
    scored = grid.withColumn("_score", round_half(score, 9))
    return scored.select(
        *CELL, "total", "open", "sla_missed", "sla_known",
        round_half(F.col("_miss"), 4).alias("sla_miss_rate"),
        "aged_open",
        round_half(F.col("_aged"), 4).alias("aged_share"),
        round_half(F.col("_volume"), 4).alias("volume_percentile"),
        round_half(F.col("_backlog"), 4).alias("backlog_percentile"),
        round_half(F.col("_score"), 4).alias("priority_score"),
        F.rank().over(Window.orderBy(F.col("_score").desc())).cast("bigint").alias("priority_rank"),
    )


def action_list(grid: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` cells of the grid, numbered without gaps (ties ordered by cell)."""
    order = [F.col("priority_rank"), *map(F.col, CELL)]
    position = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return ranking.top(grid, order, k).select(
        position.alias("position"), *CELL, "priority_score", "open", "sla_miss_rate"
    )


def headline(enriched: DataFrame, params: Params) -> DataFrame:
    """Headline KPIs: total, open, miss rate and open requests beyond the second age bound."""
    return enriched.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(p.is_open()).alias("open_requests"),
        ratio(F.count_if(p.is_missed()), F.count_if(p.is_known()), 4).alias("sla_miss_rate"),
        F.count_if(p.is_open() & (F.col("age_days") > params.bucket_bounds[1])).alias(
            "open_31_plus"
        ),
    )
