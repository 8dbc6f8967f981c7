"""Request-level derivations: closure, age, SLA status, aging bucket, calendar keys."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.functions import calendar_days, elapsed_days, month_start, week_start
from caselens.params import BUCKETS, MET, MISSED, OPEN_PAST, OPEN_WITHIN, Params
from caselens.sources.sla import SlaTargets

CALENDAR = "calendar"
FRACTIONAL = "fractional"


def enrich(
    requests: DataFrame, sla: SlaTargets, params: Params, variant: str = CALENDAR
) -> DataFrame:
    """Add the eight derived columns. Narrow: one lookup join and projections, no shuffle.

    Only ``is_closed`` looks at the snapshot bound. A request closed after the snapshot is thus
    open, yet has closure_days and a Met/Missed status, and neither age nor bucket.

    ``variant="fractional"`` is the spreadsheet definition: ``is_closed`` without the snapshot
    bound and closure time in fractional days.
    """
    if variant not in (CALENDAR, FRACTIONAL):
        raise ValueError(f"unknown variant {variant!r}")
    created, closed = F.col("created_date"), F.col("closed_date")
    ended = closed.isNotNull() & (closed >= created)
    pending = closed.isNull() | (closed < created)
    days_old = calendar_days(F.lit(params.snapshot_date), created)
    if variant == FRACTIONAL:
        is_closed = F.coalesce(ended, F.lit(False))
        days_taken = elapsed_days(closed, created)
    else:
        is_closed = ended & (closed < F.lit(params.closed_before))
        days_taken = calendar_days(closed, created)

    target, age = F.col("sla_days"), F.col("_age")
    bucket = F.when(~F.col("_pending"), None)
    for bound, label in zip(params.bucket_bounds, BUCKETS):
        bucket = bucket.when(F.col("_pending") & (age <= bound), label)
    bucket = bucket.when(F.col("_pending"), BUCKETS[-1])

    staged = sla.attach(requests).withColumns(
        {"is_closed": is_closed, "_ended": ended, "_pending": pending, "_taken": days_taken,
         "_age": days_old}
    )
    derived = {
        "is_closed": F.col("is_closed"),
        "closure_days": F.when(F.col("_ended"), F.col("_taken")),
        "age_days": F.when(F.col("_pending"), age),
        "sla_days": target,
        "sla_status": F.when(
            F.col("_ended"), F.when(F.col("_taken") <= target, MET).otherwise(MISSED)
        ).otherwise(F.when(age <= target, OPEN_WITHIN).otherwise(OPEN_PAST)),
        "aging_bucket": bucket,
        "created_week": week_start(created),
        "created_month": month_start(created),
    }
    return staged.select(
        *requests.columns, *(column.alias(name) for name, column in derived.items())
    )


def rewind(requests: DataFrame, params: Params) -> DataFrame:
    """The requests as they stood at the snapshot: later rows gone, later closures undone.

    An extract that only kept old rows while they were open stays biased: requests closed before
    the extract was taken cannot be brought back.
    """
    limit = F.lit(params.snapshot_date + timedelta(days=1))
    closed = F.col("closed_date")
    return requests.filter(F.col("created_date") < limit).withColumn(
        "closed_date", F.when(closed < limit, closed)
    )
