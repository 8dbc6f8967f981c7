from caselens.functions.columns import (
    any_of,
    calendar_days,
    elapsed_days,
    month_start,
    pct,
    ratio,
    round_half,
    strip_text,
    title_text,
    week_start,
    weekday_name,
)

__all__ = [
    "any_of",
    "calendar_days",
    "elapsed_days",
    "month_start",
    "pct",
    "ratio",
    "round_half",
    "strip_text",
    "title_text",
    "week_start",
    "weekday_name",
]
