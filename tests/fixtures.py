"""Hand-made request rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from caselens.params import ACTIVITY, Params
from caselens.sources import schemas
from caselens.sources.sla import targets_from_rows

PARAMS = Params(min_cell=1, volume_floor=1)
SNAPSHOT = PARAMS.snapshot_date


def at(text: str | None) -> datetime | None:
    """"06-15 23:00" or "06-15" of 2026."""
    if text is None:
        return None
    return datetime.strptime(f"2026-{text}" + ("" if " " in text else " 00:00"), "%Y-%m-%d %H:%M")


def days_before(days: int) -> datetime:
    return datetime.combine(SNAPSHOT - timedelta(days=days), datetime.min.time())


def row(key, created=None, closed=None, **other):
    base = {
        "unique_key": key, "created_date": created, "closed_date": closed, "agency": "AG",
        "agency_name": "Agency", "complaint_type": "Unlisted", "descriptor": "", "location_type": "",
        "incident_zip": "", "borough": "Queens", "status": "Open",
        "open_data_channel_type": "PHONE", "slice": ACTIVITY,
    }
    base.update(other)
    return tuple(base[name] for name in schemas.REQUESTS.names)


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.REQUESTS)


def targets(spark, *rows):
    return targets_from_rows(spark, [*rows, ("DEFAULT", 14, "fallback")], 14)


def by_key(result, *columns):
    return {r["unique_key"]: tuple(r[c] for c in columns) for r in result.collect()}


__all__ = [
    "PARAMS", "SNAPSHOT", "at", "by_key", "date", "days_before", "frame", "row", "targets",
]
