"""Documented escalation rules."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.functions import ratio
from caselens.operators import profile as p
from caselens.operators.enrich import enrich
from caselens.operators.priority import CELL, cells, hotspots, score_cells
from caselens.params import UNSPECIFIED, Params
from caselens.sources.sla import SlaTargets


def missing_targets(scores: DataFrame, k: int = 10, limit: float = 0.60) -> DataFrame:
    """Hotspots whose miss rate is above the limit."""
    return hotspots(scores, k).filter(F.col("sla_miss_rate") > limit).select(
        "priority_rank", *CELL, "agency", "sla_miss_rate"
    )


def _open_beyond(snapshot: date, days: int) -> Column:
    """Open at the end of ``snapshot`` and more than ``days`` days old on it."""
    created, closed = F.col("created_date"), F.col("closed_date")
    still_open = closed.isNull() | (closed < created) | (
        closed >= F.lit(snapshot + timedelta(days=1))
    )
    return still_open & (F.datediff(F.lit(snapshot), created) > days)


def _history(params: Params, weeks: int) -> dict[str, Column]:
    days = params.bucket_bounds[1]
    return {
        f"weeks_ago_{w}": F.count_if(
            _open_beyond(params.snapshot_date - timedelta(weeks=w), days)
        )
        for w in range(weeks)
    }


def aged_open_history(requests: DataFrame, params: Params, weeks: int = 3) -> DataFrame:
    """31+ day open count per cell at the snapshot and at the weeks before it.

    One conditional count per week in a single pass: the rows are never multiplied by the number of
    snapshots. Counts of earlier weeks are as complete as the extract's old closed rows are.
    """
    counts = [count.alias(name) for name, count in _history(params, weeks).items()]
    return requests.filter(p.is_placed()).groupBy(*CELL).agg(*counts)


def backlog_by_snapshot(
    requests: DataFrame, params: Params, snapshots: int = 52, every: int = 7
) -> DataFrame:
    """``(complaint_type, borough, snapshot, aged_open)``: the 31+ day open count of each cell at the
    snapshot and at ``snapshots - 1`` earlier ones, ``every`` days apart.

    A sweep over events: a request counts from the day on which it passes the age limit until the day
    before its closing day. Each adds one and takes one away, at the first snapshot that sees it;
    the events are added up per cell and snapshot before the shuffle, and a running sum over the
    snapshots of a cell gives the counts. Neither the plan nor what is read grows with ``snapshots``.
    """
    first = params.snapshot_date - timedelta(days=every * (snapshots - 1))
    created, closed = F.to_date("created_date"), F.to_date("closed_date")
    valid = F.col("closed_date") >= F.col("created_date")
    begin = F.date_add(created, params.bucket_bounds[1] + 1)
    end = F.when(valid, closed)

    def step(day: Column) -> Column:
        """The first snapshot on or after a day; those before all snapshots see the first one."""
        days = F.datediff(day, F.lit(first))
        return F.greatest(F.ceil(days / every), F.lit(0)).cast("int")

    # Undated requests, and those closed before the limit, are an event of nothing, so that their
    # cell has its row.
    counts = F.coalesce(end.isNull() | (end > begin), F.lit(False)) & begin.isNotNull()
    event = F.struct(F.col("step"), F.col("delta"))
    events = requests.filter(p.is_placed()).select(
        *CELL,
        F.explode(
            F.array(
                F.struct(
                    F.when(counts, step(begin)).otherwise(0).alias("step"),
                    counts.cast("int").alias("delta"),
                ),
                F.struct(
                    F.when(counts & end.isNotNull(), step(end)).otherwise(0).alias("step"),
                    (-F.when(counts & end.isNotNull(), 1).otherwise(0)).alias("delta"),
                ),
            )
        ).alias("event"),
    ).select(*CELL, "event.*")
    moved = events.withColumn("delta", F.when(F.col("step") < snapshots, F.col("delta")).otherwise(0))
    last = F.least("step", F.lit(snapshots - 1)).alias("step")
    sums = moved.select(*CELL, last, "delta").groupBy(*CELL, "step").agg(F.sum("delta").alias("delta"))
    cells_ = sums.groupBy(*CELL).agg(
        F.map_from_entries(F.collect_list(event)).alias("changes")
    )
    running = F.aggregate(
        F.sequence(F.lit(0), F.lit(snapshots - 1)),
        F.array().cast("array<bigint>"),
        lambda done, at: F.concat(
            done,
            F.array(
                F.coalesce(F.get(done, F.size(done) - 1), F.lit(0))
                + F.coalesce(F.try_element_at("changes", at), F.lit(0))
            ),
        ),
    )
    return cells_.select(*CELL, F.posexplode(running).alias("_at", "aged_open")).select(
        *CELL, F.date_add(F.lit(first), F.col("_at") * every).alias("snapshot"), "aged_open"
    )


def growing_backlog(enriched: DataFrame, params: Params, k: int = 10) -> DataFrame:
    """Whether a hotspot's 31+ day open count grew two weeks in a row.

    Scores and history share their key, so one aggregation of the requests gives both.
    """
    names = [f"weeks_ago_{w}" for w in (2, 1, 0)]
    cell_frame = cells(enriched, params, more=_history(params, 3))
    before, last, now = map(F.col, names)
    return hotspots(score_cells(cell_frame, params, keep=names), k).select(
        "priority_rank", *CELL, *names, ((now > last) & (last > before)).alias("escalate"),
    )


def past_limit(enriched: DataFrame, params: Params) -> DataFrame:
    """Open requests older than the last age bound."""
    old = p.is_open() & (F.col("age_days") > params.bucket_bounds[-1])
    return enriched.filter(old).select("unique_key", *CELL, "agency", "age_days", "sla_status")


def unspecified_share(requests: DataFrame, limit: float = 0.005) -> DataFrame:
    """Share of requests without a borough, and whether it is above the limit."""
    missing = F.col("borough").isNull() | (F.col("borough") == UNSPECIFIED)
    share = ratio(F.count_if(missing), F.count(F.lit(1)))
    return requests.agg(
        F.count_if(missing).alias("unspecified"),
        F.count(F.lit(1)).alias("total"),
        ratio(F.count_if(missing), F.count(F.lit(1)), 6).alias("share"),
        (share > limit).alias("escalate"),
    )


def _state(requests: DataFrame, sla: SlaTargets, at: Params, name: str) -> DataFrame:
    """Each request with a column of its derived state as it stood at a snapshot."""
    limit = F.lit(at.closed_before)
    kept = requests.withColumn("_closed_date", F.col("closed_date")).withColumn(
        "closed_date", F.when(F.col("closed_date") < limit, F.col("closed_date"))
    )
    state = F.struct(
        F.lit(name).alias("snapshot"), (F.col("created_date") < limit).alias("known"),
        "is_closed", "sla_status", "aging_bucket", "closure_days", "age_days",
    )
    return enrich(kept, sla, at).select(
        *(F.col("_closed_date").alias(c) if c == "closed_date" else F.col(c)
          for c in requests.columns),
        state.alias(name),
    )


def new_entrants(
    requests: DataFrame, sla: SlaTargets, params: Params, earlier: date, k: int = 10
) -> DataFrame:
    """Cells in today's top ``k`` that were not in the top ``k`` of an earlier snapshot.

    Each request carries its state at both snapshots; one aggregation counts the cells of both.
    """
    both = _state(_state(requests, sla, params, "now"), sla, params.at(earlier), "then")
    states = both.select(
        *CELL, "agency", F.explode(F.array("now", "then")).alias("state")
    ).select(*CELL, "agency", "state.*").filter("known")
    scores = score_cells(cells(states, params, by=["snapshot"]), params, by=["snapshot"])
    before = F.max((F.col("snapshot") == "then").cast("int")).over(Window.partitionBy(*CELL))
    return hotspots(scores, k).withColumn("_before", before).filter(
        "snapshot = 'now' AND _before = 0"
    ).select("priority_rank", *CELL, "priority_score")


def artifact_candidates(by_type: DataFrame, params: Params, closed_share: float = 0.0) -> DataFrame:
    """Types with much volume and (nearly) no closure: probably a recording artifact."""
    busy = F.col("total_requests") >= params.volume_floor
    share = ratio(F.col("closed_requests"), F.col("total_requests"))
    return by_type.filter(busy & (share <= closed_share)).select(
        "complaint_type", "primary_agency", "total_requests", "open_requests"
    )


def separate_lines(enriched: DataFrame, types: DataFrame) -> DataFrame:
    """Citywide KPIs without the types listed in ``types (complaint_type)``, such as
    :func:`artifact_candidates`, each listed type as its own line, and all together.

    Made from one profile by type, so the fact is read once.
    """
    measures = {
        "total_requests": p.rows_where(),
        "closed_requests": p.rows_where(F.col("is_closed")),
        "open_requests": p.rows_where(p.is_open()),
        "sla_miss_rate": p.miss_rate(4),
        "aged_open_30d_plus": p.rows_where(p.is_aged()),
    }
    listed = types.select(F.col("complaint_type").alias("_listed")).distinct()
    rows = p.profile(enriched, ["complaint_type"]).join(
        listed, F.col("complaint_type") == F.col("_listed"), "left"
    )
    line = F.coalesce(F.col("_listed"), F.lit("citywide excluding listed"))
    lines = F.explode(F.array(line, F.lit("citywide")))
    return p.summarise(rows.withColumn("line", lines), ["line"], measures, counted=True)
