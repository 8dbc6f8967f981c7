"""Explicit schemas. Nothing is inferred from data.

Timestamps carry no zone (``timestamp_ntz``): request times are local wall-clock times, and every
derived day count must not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the raw extract.
RAW_COLUMNS = (
    "unique_key", "created_date", "closed_date", "agency", "agency_name", "complaint_type",
    "descriptor", "location_type", "incident_zip", "borough", "status", "open_data_channel_type",
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_TEXT, _LONG, _INT, _REAL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_DAY, _TIME, _FLAG = T.DateType(), T.TimestampNTZType(), T.BooleanType()

RAW = _schema(**{name: _TEXT for name in RAW_COLUMNS})

# What the scan of an extract adds: the text of a torn line, and where a row lies.
RAW_OR_TORN = T.StructType(RAW.fields + _schema(torn_line=_TEXT).fields)
MARKS = _schema(torn_line=_TEXT, source_file=_TEXT, source_offset=_LONG, source_row=_LONG)

REQUESTS = _schema(
    **{name: _TIME if name.endswith("_date") else _TEXT for name in RAW_COLUMNS}, slice=_TEXT
)

SCANNED = T.StructType(REQUESTS.fields + MARKS.fields)

ENRICHED = T.StructType(
    REQUESTS.fields
    + _schema(
        is_closed=_FLAG, closure_days=_LONG, age_days=_LONG, sla_days=_INT, sla_status=_TEXT,
        aging_bucket=_TEXT, created_week=_DAY, created_month=_DAY,
    ).fields
)

SLA_TARGETS = _schema(complaint_type=_TEXT, sla_days=_INT, rationale=_TEXT)

EXTRACT_METADATA = _schema(item=_TEXT, value=_REAL)

DIM_DATE = _schema(date=_DAY, week_start=_DAY, month_start=_DAY, weekday=_TEXT)

_RATES = dict(
    total_requests=_LONG, closed_requests=_LONG, open_requests=_LONG, avg_closure_days=_REAL,
    median_closure_days=_REAL, sla_miss_rate=_REAL, aged_open_30d_plus=_LONG,
)
KPI_BY_AGENCY = _schema(agency=_TEXT, agency_name=_TEXT, **_RATES)
KPI_BY_COMPLAINT_TYPE = _schema(complaint_type=_TEXT, primary_agency=_TEXT, **_RATES)
KPI_BY_BOROUGH = _schema(
    borough=_TEXT, **{k: v for k, v in _RATES.items() if k != "median_closure_days"}
)
KPI_WEEKLY = _schema(
    created_week=_DAY, requests_created=_LONG, eventually_closed=_LONG, still_open=_LONG,
    avg_closure_days=_REAL, sla_miss_rate=_REAL,
)
BACKLOG_AGING = _schema(
    aging_bucket=_TEXT, borough=_TEXT, open_requests=_LONG, avg_age_days=_REAL
)
PRIORITY_SCORES = _schema(
    complaint_type=_TEXT, borough=_TEXT, agency=_TEXT, total_requests=_LONG, open_requests=_LONG,
    sla_miss_rate=_REAL, aged_share_of_open=_REAL, volume_percentile=_REAL,
    backlog_percentile=_REAL, priority_score=_REAL, priority_rank=_LONG,
)
