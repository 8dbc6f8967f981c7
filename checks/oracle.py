"""SQL with the same results as the registered queries, for an independent engine.

Each statement is a chain of named steps (see ``STEPS``) and a final SELECT. The steps state the
business rules once more, in plain SQL over the given tables, without any of the library's code.
"""

from __future__ import annotations

_SNAP, _AFTER = "2001-08-05", "2001-08-06"
_FROM, _TO, _OLD = "2001-05-01", "2001-08-01", "1995-01-01"
_DEFAULT_DAYS = 700
# Days for every priority within four of the five segments, 60 more each time.
_TARGET_DAYS = {
    f"{priority} / {segment}": 300 + 60 * (4 * i + j)
    for i, priority in enumerate(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
    for j, segment in enumerate(("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"))
}
_TARGETS = ", ".join(f"('{kind}', {days})" for kind, days in _TARGET_DAYS.items())
_ACTIVITY, _BACKLOG = "activity_q2_2026", "aged_open_backlog"
_BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
_BOROUGH_LIST = ", ".join(f"'{b}'" for b in _BOROUGHS)
_AGED = "('31-90 days', '91-180 days', '180+ days')"
_CHANNEL = """CASE o_custkey % 4 WHEN 0 THEN 'PHONE' WHEN 1 THEN 'ONLINE' WHEN 2 THEN 'MOBILE'
    ELSE 'UNKNOWN' END"""
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'In Progress' END"
_PEOPLE = """orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
_TAIL = "CASE WHEN l_orderkey % 9 = 0 THEN chr(9) ELSE ' ' END"
_REQUEST_COLUMNS = """unique_key, created_date, closed_date, agency, agency_name, complaint_type,
    descriptor, location_type, incident_zip, borough, status, open_data_channel_type, slice"""


def _facts(source: str, *, fractional: bool) -> str:
    """The derived columns over a request step."""
    took = "date_diff('day', created_date, closed_date)"
    if fractional:
        took = "date_diff('microsecond', created_date, closed_date) / 86400000000.0"
        closed = "ended"
    else:
        closed = f"""CASE WHEN closed_date IS NULL THEN false
            ELSE closed_date >= created_date AND closed_date < TIMESTAMP '{_AFTER}' END"""
    return f"""
  SELECT {_REQUEST_COLUMNS}, {closed} AS is_closed,
    CASE WHEN ended THEN took END AS closure_days,
    CASE WHEN pending THEN waited END AS age_days, sla_days,
    CASE WHEN ended AND took <= sla_days THEN 'Met' WHEN ended THEN 'Missed'
         WHEN waited <= sla_days THEN 'Open Within SLA' ELSE 'Open Past SLA' END AS sla_status,
    CASE WHEN NOT pending THEN NULL WHEN waited <= 7 THEN '0-7 days'
         WHEN waited <= 30 THEN '8-30 days' WHEN waited <= 90 THEN '31-90 days'
         WHEN waited <= 180 THEN '91-180 days' ELSE '180+ days' END AS aging_bucket,
    CAST(date_trunc('week', created_date) AS DATE) AS created_week,
    CAST(date_trunc('month', created_date) AS DATE) AS created_month
  FROM (
    SELECT q.*, coalesce(t.days, {_DEFAULT_DAYS}) AS sla_days, {took} AS took,
      date_diff('day', created_date, TIMESTAMP '{_SNAP}') AS waited,
      coalesce(closed_date >= created_date, false) AS ended,
      coalesce(closed_date < created_date, closed_date IS NULL) AS pending
    FROM {source} q LEFT JOIN (VALUES {_TARGETS}) t(kind, days) ON q.complaint_type = t.kind)"""


def _score_steps(facts: str, suffix: str = "", least: int = 10) -> dict[str, str]:
    """Scored cells of an enriched step: percentiles and score from one grouping."""
    by_weight = " + ".join(
        f"CAST({weight} AS DOUBLE) * {part}"
        for weight, part in (("0.30", "busy"), ("0.25", "piled"), ("0.25", "coalesce(missed, 0)"),
                             ("0.20", "aged"))
    )
    return {
        f"scores{suffix}": f"""
  SELECT complaint_type, borough, agency, n AS total_requests, waiting AS open_requests,
    missed AS sla_miss_rate, aged AS aged_share_of_open, round(busy, 4) AS volume_percentile,
    round(piled, 4) AS backlog_percentile, round({by_weight}, 4) AS priority_score,
    row_number() OVER (ORDER BY round({by_weight}, 4) DESC, complaint_type, borough)
      AS priority_rank
  FROM (
    SELECT complaint_type, borough, min(agency) AS agency, count(*) AS n,
      count_if(NOT is_closed) AS waiting,
      round(count_if(sla_status IN ('Missed', 'Open Past SLA'))
        / nullif(count_if(sla_status <> 'Open Within SLA'), 0), 4) AS missed,
      coalesce(round(count_if(NOT is_closed AND aging_bucket IN {_AGED})
        / nullif(count_if(NOT is_closed), 0), 4), 0) AS aged,
      percent_rank() OVER (ORDER BY count(*)) AS busy,
      percent_rank() OVER (ORDER BY count_if(NOT is_closed)) AS piled
    FROM {facts} WHERE borough <> 'Unspecified'
    GROUP BY complaint_type, borough HAVING count(*) >= {least})""",
    }


def _raw(where: str) -> str:
    columns = ", ".join(c for c in _REQUEST_COLUMNS.replace("\n", " ").split(", ") if c.strip() != "slice")
    return f"SELECT {columns} FROM raw_lines WHERE {where}"


_IN_WINDOW = f"CAST(created_date AS TIMESTAMP) >= '{_FROM}' AND CAST(created_date AS TIMESTAMP) < '{_TO}'"
_IN_BACKLOG = (
    f"CAST(created_date AS TIMESTAMP) >= '{_OLD}' AND CAST(created_date AS TIMESTAMP) < '{_FROM}'"
    " AND status <> 'Closed'"
)
_ISO = "'%Y-%m-%dT%H:%M:%S.%g'"

STEPS: dict[str, str] = {
    "requests": f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS unique_key, CAST(o_orderdate AS TIMESTAMP) AS created_date,
    CAST(shipped AS TIMESTAMP) AS closed_date, n_name AS agency, 'Agency ' || n_name AS agency_name,
    o_orderpriority || ' / ' || c_mktsegment AS complaint_type, o_orderpriority AS descriptor,
    c_mktsegment AS location_type,
    CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN 'ABC'
         ELSE lpad(CAST(o_custkey AS VARCHAR), 5, '0') END AS incident_zip,
    CASE WHEN c_nationkey = 0 OR r_name IS NULL THEN 'Unspecified' ELSE r_name END AS borough,
    {_STATUS} AS status, {_CHANNEL} AS open_data_channel_type,
    CASE WHEN o_orderdate >= '{_FROM}' AND o_orderdate < '{_TO}' THEN '{_ACTIVITY}'
         ELSE '{_BACKLOG}' END AS slice
  FROM {_PEOPLE}
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey)
    ON l_orderkey = o_orderkey""",
    "facts": _facts("requests", fractional=False),
    "sheet": _facts("requests", fractional=True),
    **_score_steps("facts"),
    "raw_lines": f"""
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS unique_key,
    strftime(o_orderdate, {_ISO}) AS created_date,
    CASE WHEN l_orderkey % 17 = 0 THEN 'not a date' WHEN l_linenumber = 7 THEN NULL
         ELSE strftime(l_shipdate, {_ISO}) END AS closed_date,
    ' ' || n_name AS agency, 'Agency ' || n_name || '  ' AS agency_name,
    o_orderpriority || ' / ' || c_mktsegment || {_TAIL} AS complaint_type,
    CASE WHEN l_orderkey % 5 <> 0 THEN o_orderpriority END AS descriptor,
    c_mktsegment AS location_type,
    ' ' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') || '-0001' AS incident_zip,
    CASE WHEN c_nationkey = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN ''
         WHEN l_orderkey % 19 = 0 THEN ' unspecified ' ELSE '  ' || upper(r_name) || {_TAIL} END
      AS borough,
    {_STATUS} AS status, {_CHANNEL} AS open_data_channel_type
  FROM lineitem LEFT JOIN ({_PEOPLE}) ON l_orderkey = o_orderkey""",
    "landed": f"""
  {_raw(_IN_WINDOW).replace(' FROM', f", '{_ACTIVITY}' AS slice FROM")}
  UNION ALL
  {_raw(_IN_BACKLOG).replace(' FROM', f", '{_BACKLOG}' AS slice FROM")}""",
    "tidy": """
  SELECT unique_key, try_cast(created_date AS TIMESTAMP) AS created_date,
    try_cast(closed_date AS TIMESTAMP) AS closed_date, trim(coalesce(agency, '')) AS agency,
    trim(coalesce(agency_name, '')) AS agency_name,
    trim(coalesce(complaint_type, ''), chr(9) || ' ') AS complaint_type,
    trim(coalesce(descriptor, '')) AS descriptor, trim(coalesce(location_type, '')) AS location_type,
    left(trim(coalesce(incident_zip, '')), 5) AS incident_zip,
    CASE upper(trim(coalesce(borough, ''), chr(9) || ' '))
      WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'America' WHEN 'ASIA' THEN 'Asia'
      WHEN 'EUROPE' THEN 'Europe' WHEN 'MIDDLE EAST' THEN 'Middle East' ELSE 'Unspecified' END
      AS borough,
    trim(coalesce(status, '')) AS status,
    trim(coalesce(open_data_channel_type, '')) AS open_data_channel_type, slice
  FROM landed""",
    "unique_rows": f"""
  SELECT {_REQUEST_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY slice,
      created_date NULLS LAST, closed_date NULLS FIRST, agency, agency_name, complaint_type,
      descriptor, location_type, incident_zip, borough, status, open_data_channel_type) AS copy
    FROM tidy) WHERE copy = 1""",
    "by_agency": "",
    "by_type": "",
    "by_borough": "",
    "weekly": f"""
  SELECT created_week, count(*) AS requests_created, count_if(is_closed) AS eventually_closed,
    count_if(NOT is_closed) AS still_open, round(avg(closure_days), 1) AS avg_closure_days,
    round(count_if(sla_status IN ('Missed', 'Open Past SLA'))
      / nullif(count_if(sla_status <> 'Open Within SLA'), 0), 4) AS sla_miss_rate
  FROM facts WHERE slice = '{_ACTIVITY}' GROUP BY created_week""",
    "aging": """
  SELECT aging_bucket, borough, count(*) AS open_requests, round(avg(age_days), 0) AS avg_age_days
  FROM facts WHERE NOT is_closed GROUP BY aging_bucket, borough""",
    "with_days": """
  SELECT f.*, CAST(created_date AS DATE) AS created_date_only, d.day AS date,
    CAST(date_trunc('week', d.day) AS DATE) AS week_start,
    CAST(date_trunc('month', d.day) AS DATE) AS month_start, strftime(d.day, '%a') AS weekday
  FROM facts f LEFT JOIN (
    SELECT CAST(unnest(generate_series(min(created_date), max(created_date) + INTERVAL 1 DAY,
      INTERVAL 1 DAY)) AS DATE) AS day FROM requests) d ON CAST(f.created_date AS DATE) = d.day""",
    "grid_cells": f"""
  SELECT top.complaint_type, b.borough, count(f.unique_key) AS total,
    count_if(NOT f.is_closed) AS open,
    count_if(f.sla_status IN ('Missed', 'Open Past SLA')) AS sla_missed,
    count_if(f.sla_status <> 'Open Within SLA') AS sla_known,
    count_if(NOT f.is_closed AND f.age_days > 30) AS aged_open
  FROM (SELECT complaint_type FROM sheet GROUP BY complaint_type
        ORDER BY count(*) DESC, complaint_type LIMIT 15) top
  CROSS JOIN (SELECT unnest([{_BOROUGH_LIST}]) AS borough) b
  LEFT JOIN sheet f ON f.complaint_type = top.complaint_type AND f.borough = b.borough
  GROUP BY top.complaint_type, b.borough""",
    "grid_parts": """
  SELECT *, coalesce(sla_missed / nullif(sla_known, 0), 0) AS miss,
    coalesce(aged_open / nullif(open, 0), 0) AS aged,
    floor(percent_rank() OVER (ORDER BY total) * 1000 + CAST(1e-9 AS DOUBLE)) / 1000.0 AS volume,
    floor(percent_rank() OVER (ORDER BY open) * 1000 + CAST(1e-9 AS DOUBLE)) / 1000.0 AS backlog
  FROM grid_cells""",
    "grid_scored": """
  SELECT *, round(CAST(0.30 AS DOUBLE) * volume + CAST(0.25 AS DOUBLE) * backlog
      + CAST(0.25 AS DOUBLE) * miss + CAST(0.20 AS DOUBLE) * aged, 9) AS score FROM grid_parts""",
    "grid": """
  SELECT complaint_type, borough, total, open, sla_missed, sla_known,
    round(miss, 4) AS sla_miss_rate, aged_open, round(aged, 4) AS aged_share,
    round(volume, 4) AS volume_percentile, round(backlog, 4) AS backlog_percentile,
    round(score, 4) AS priority_score, rank() OVER (ORDER BY score DESC) AS priority_rank
  FROM grid_scored""",
}


def _rollup(key: str, label: str = "", median: bool = True) -> str:
    middle = "round(median(closure_days), 1) AS median_closure_days," if median else ""
    return f"""
  SELECT {key}, {label} count(*) AS total_requests, count_if(is_closed) AS closed_requests,
    count_if(NOT is_closed) AS open_requests, round(avg(closure_days), 1) AS avg_closure_days,
    {middle}
    round(count_if(sla_status IN ('Missed', 'Open Past SLA'))
      / nullif(count_if(sla_status <> 'Open Within SLA'), 0), 4) AS sla_miss_rate,
    count_if(NOT is_closed AND aging_bucket IN {_AGED}) AS aged_open_30d_plus
  FROM facts GROUP BY {key}"""


STEPS["by_agency"] = _rollup("agency", "min(agency_name) AS agency_name,")
STEPS["by_type"] = _rollup("complaint_type", "min(agency) AS primary_agency,")
STEPS["by_borough"] = _rollup("borough", median=False)


def _needed(body: str, steps: dict[str, str]) -> list[str]:
    """Steps named in ``body``, with the steps they name, in definition order."""
    words = set(body.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    direct = [name for name in steps if name in words]
    found = {dep for name in direct for dep in _needed(steps[name], _before(name, steps))}
    return [name for name in steps if name in found or name in direct]


def _before(name: str, steps: dict[str, str]) -> dict[str, str]:
    return {key: text for key, text in steps.items() if list(steps).index(key) < list(steps).index(name)}


def _sql(body: str, **extra: str) -> str:
    steps = {**STEPS, **extra}
    names = _needed(body, steps)
    head = ",\n".join(f"{name} AS ({steps[name]})" for name in names)
    return f"WITH {head}\n{body}" if head else body


def _gate(source: str) -> str:
    """The nine checks as a list of (label, count, note) over one step."""
    # Check names and notes.
    checks = [
        ("01 duplicate unique_key", "count(*) - count(DISTINCT unique_key)",
         "each service request should appear exactly once"),
        ("02 missing created_date", "count_if(created_date IS NULL)",
         "created_date is required for every downstream metric"),
        ("03 closed status but no closed_date",
         "count_if(status = 'Closed' AND closed_date IS NULL)",
         "these rows are excluded from closure-time metrics"),
        ("04 closed_date but status not Closed",
         "count_if(closed_date IS NOT NULL AND status <> 'Closed')",
         "status/closed_date disagreement — closure logic uses closed_date"),
        ("05 closed before created (invalid sequence)", "count_if(closed_date < created_date)",
         "negative closure times are excluded from closure-time metrics"),
        ("06 closed in the future (after snapshot)",
         f"count_if(closed_date > TIMESTAMP '{_AFTER}')",
         "closure timestamps later than the extract snapshot"),
        ("07 borough missing/unspecified",
         "count_if(coalesce(borough, 'Unspecified') = 'Unspecified')",
         'kept, reported as their own "Unspecified" borough'),
        ("08 missing complaint_type", "count_if(coalesce(complaint_type, '') = '')",
         "complaint_type drives SLA mapping and priority scoring"),
        ("09 zip not 5 digits (where present)",
         "count_if(incident_zip <> '' AND NOT regexp_full_match(incident_zip, '[0-9]{5}'))",
         "zip is descriptive only and not used in KPI logic"),
    ]
    one = "\nUNION ALL ".join(
        f"SELECT '{name}' AS check_name, {count} AS records_flagged, count(*) AS n, "
        f"'{note}' AS note FROM {source}"
        for name, count, note in checks
    )
    return (
        "SELECT check_name, records_flagged, "
        f"round(100.0 * records_flagged / nullif(n, 0), 3) AS pct_of_total, note FROM ({one})"
    )


def _block(key: str, where: str = "", tail: str = "") -> str:
    return f"""SELECT {key}, count(*) AS total, count_if(is_closed) AS closed,
  count_if(NOT is_closed) AS open, count_if(sla_status IN ('Missed', 'Open Past SLA')) AS sla_missed,
  count_if(sla_status <> 'Open Within SLA') AS sla_known,
  round(count_if(sla_status IN ('Missed', 'Open Past SLA'))
    / nullif(count_if(sla_status <> 'Open Within SLA'), 0), 4) AS sla_miss_rate,
  round(avg(closure_days), 1) AS avg_closure_days FROM sheet {where} GROUP BY {key} {tail}"""


def _listed(key: str, values: list[str]) -> str:
    counts = ", ".join(
        f"coalesce({c}, 0) AS {c}" for c in ("total", "closed", "open", "sla_missed", "sla_known")
    )
    return f"""SELECT value AS {key}, {counts}, sla_miss_rate, avg_closure_days
FROM (SELECT unnest([{", ".join(values)}]) AS value) LEFT JOIN ({_block(key)}) ON {key} = value"""


def _pivot(key: str, columns: str, top: int | None = None) -> str:
    keep = ""
    if top:
        keep = f"""WHERE {key} IN (SELECT {key} FROM sheet GROUP BY {key}
          ORDER BY count(*) DESC, {key} LIMIT {top})"""
    return f"""SELECT {key}, level, requests {columns} FROM (
  SELECT {key}, 0 AS level, count(*) AS requests, sum(count(*)) OVER () AS everything,
    avg(closure_days) AS took FROM sheet {keep} GROUP BY {key}
  UNION ALL SELECT NULL, 1, count(*), count(*), avg(closure_days) FROM sheet {keep})"""


_SHARE = ", round(100.0 * requests / everything, 1) AS pct_of_total"
_MEAN = ", round(took, 1) AS avg_closure_days"

_MEASURES = f"""count(*) AS total_requests, count_if(is_closed) AS closed_requests,
  count_if(NOT is_closed) AS open_requests, count_if(NOT is_closed) AS backlog_count,
  count_if(is_closed) / nullif(count(*), 0) AS closure_rate, avg(closure_days) AS avg_closure_days,
  median(closure_days) AS median_closure_days,
  count_if(sla_status IN ('Missed', 'Open Past SLA')) AS sla_missed,
  count_if(sla_status <> 'Open Within SLA') AS sla_outcomes_known,
  count_if(sla_status IN ('Missed', 'Open Past SLA'))
    / nullif(count_if(sla_status <> 'Open Within SLA'), 0) AS sla_miss_rate,
  count_if(NOT is_closed AND aging_bucket IN {_AGED}) AS aging_backlog_count,
  count_if(NOT is_closed AND aging_bucket IN {_AGED}) / nullif(count_if(NOT is_closed), 0)
    AS aged_share_of_backlog"""
_SLICED = """borough IN ('ASIA', 'EUROPE', 'Unspecified')
  AND open_data_channel_type IN ('PHONE', 'MOBILE')
  AND (aging_bucket IS NULL OR aging_bucket IN ('91-180 days', '180+ days'))"""


def _month_over_month(dims: str = "") -> str:
    keys = f"{dims}, " if dims else ""
    group = f"GROUP BY {keys}created_month"
    return f"""SELECT {keys}created_month, coalesce(sum(n), 0)::BIGINT AS total_requests,
  sum(earlier)::BIGINT AS requests_previous_month,
  (coalesce(sum(n), 0) - sum(earlier)) / nullif(sum(earlier), 0) AS mom_change
FROM (SELECT {keys}created_month, n, NULL AS earlier FROM months
  UNION ALL SELECT {keys}CAST(created_month + INTERVAL 1 MONTH AS DATE), NULL, n FROM months)
WHERE created_month <= (SELECT max(created_month) FROM months) {group}""", (
        f"SELECT {keys}created_month, count(*) AS n FROM facts {group}"
    )


def _whatif(key: str, weights: tuple[float, float, float, float]) -> str:
    v, b, m, a = (f"CAST({w} AS DOUBLE)" for w in weights)
    return f"""SELECT {key}, round(score, 4) AS dynamic_score,
  dense_rank() OVER (ORDER BY score DESC NULLS LAST) AS dynamic_rank FROM (
  SELECT {key}, round(({v} * avg(volume_percentile) + {b} * avg(backlog_percentile)
    + {m} * coalesce(avg(sla_miss_rate), 0) + {a} * avg(aged_share_of_open))
    / nullif({v} + {b} + {m} + {a}, 0), 9) AS score FROM scores GROUP BY {key})"""


# A sample of the sheet: the smallest seeded hashes.
_DRAWN = """
  SELECT s.* FROM sheet s JOIN (SELECT unique_key FROM requests
    ORDER BY md5('42:' || unique_key), unique_key LIMIT 1000) USING (unique_key)"""
_FACTOR = "(SELECT count(*) / least(count(*), 1000.0)::DOUBLE FROM requests)"


def _scenarios() -> str:
    base = {"volume": 0.30, "backlog": 0.25, "miss": 0.25, "aged": 0.20}
    rows = []
    for slider in base:
        for step in range(21):
            weights = {**base, slider: step / 20}
            cells = ", ".join(f"CAST({w} AS DOUBLE)" for w in weights.values())
            rows.append(f"('{slider}', {step}, {cells})")
    return ", ".join(rows)


def _pivoted(value: str, boroughs=(*_BOROUGHS, "Unspecified")) -> str:
    return ", ".join(
        f"{value.format(b=b)} AS {b.lower().replace(' ', '_')}" for b in boroughs
    )


def _open_31(weeks: int) -> str:
    day = f"(DATE '{_SNAP}' - INTERVAL {7 * weeks} DAY)"
    return f"""count_if((closed_date IS NULL OR closed_date < created_date
    OR closed_date >= {day} + INTERVAL 1 DAY)
    AND date_diff('day', created_date, {day}) > 30) AS weeks_ago_{weeks}"""


_HISTORY = f"""
  SELECT complaint_type, borough, {_open_31(0)}, {_open_31(1)}, {_open_31(2)}
  FROM requests WHERE borough <> 'Unspecified' GROUP BY complaint_type, borough"""

_EARLIER = "2001-05-01"


def _rewound(day: str) -> str:
    return f"""
  SELECT * REPLACE (CASE WHEN closed_date < TIMESTAMP '{day}' + INTERVAL 1 DAY
    THEN closed_date END AS closed_date)
  FROM requests WHERE created_date < TIMESTAMP '{day}' + INTERVAL 1 DAY"""


def _new_hotspots() -> str:
    def facts_at(source: str, day: str) -> str:
        return (
            _facts(source, fractional=False)
            .replace(f"TIMESTAMP '{_SNAP}'", f"TIMESTAMP '{day}'")
            .replace(f"TIMESTAMP '{_AFTER}'", f"TIMESTAMP '{day}' + INTERVAL 1 DAY")
        )

    extra = {
        "known_now": _rewound(_SNAP),
        "facts_now": facts_at("known_now", _SNAP),
        "known_then": _rewound(_EARLIER),
        "facts_then": facts_at("known_then", _EARLIER),
        **_score_steps("facts_now", "_now"),
        **_score_steps("facts_then", "_then"),
    }
    body = """SELECT priority_rank, complaint_type, borough, priority_score FROM scores_now n
WHERE priority_rank <= 10 AND NOT EXISTS (SELECT 1 FROM scores_then t WHERE t.priority_rank <= 10
  AND t.complaint_type = n.complaint_type AND t.borough = n.borough)"""
    return _sql(body, **extra)


_NEVER = "4-NOT SPECIFIED / FURNITURE"
_FROZEN = {
    "frozen": f"""
  SELECT * REPLACE (CASE WHEN complaint_type = '{_NEVER}' THEN NULL ELSE closed_date END
    AS closed_date) FROM requests""",
    "frozen_facts": _facts("frozen", fractional=False),
    "never_closed": """
  SELECT complaint_type, min(agency) AS primary_agency, count(*) AS total_requests,
    count_if(NOT is_closed) AS open_requests
  FROM frozen_facts GROUP BY complaint_type HAVING count(*) >= 50 AND count_if(is_closed) = 0""",
}


def _lines() -> str:
    figures = f"""count(*) AS total_requests, count_if(is_closed) AS closed_requests,
  count_if(NOT is_closed) AS open_requests,
  round(count_if(sla_status IN ('Missed', 'Open Past SLA'))
    / nullif(count_if(sla_status <> 'Open Within SLA'), 0), 4) AS sla_miss_rate,
  count_if(NOT is_closed AND aging_bucket IN {_AGED}) AS aged_open_30d_plus"""
    return f"""SELECT CASE WHEN complaint_type IN (SELECT complaint_type FROM never_closed)
  THEN complaint_type ELSE 'citywide excluding listed' END AS line, {figures}
FROM frozen_facts GROUP BY 1
UNION ALL SELECT 'citywide', {figures} FROM frozen_facts"""


_MONTHS, _MONTHS_STEP = _month_over_month()
_TYPE_MONTHS, _TYPE_MONTHS_STEP = _month_over_month("complaint_type")
_OTHER = (0.10, 0.40, 0.05, 0.60)
_SCORE_LINE = """SELECT priority_rank, complaint_type, borough, agency, total_requests,
  open_requests, sla_miss_rate, aged_share_of_open, priority_score FROM scores"""
_LABEL = "left(complaint_type, 22) || ' · ' || borough"

ORACLE: dict[str, str] = {
    "slice_activity": _sql(_raw(_IN_WINDOW)),
    "slice_backlog": _sql(_raw(_IN_BACKLOG)),
    "slice_reconciliation": _sql(
        """SELECT slice, count(*) AS expected_rows, count(*) AS landed_rows, 0 AS difference,
  'complete' AS state FROM landed GROUP BY slice"""
    ),
    "slice_reconciliation_torn": _sql(
        f"""SELECT slice, 0 AS expected_rows, count(*) AS landed_rows, count(*) AS difference,
  'unexpected' AS state FROM landed WHERE slice = '{_BACKLOG}' GROUP BY slice
UNION ALL SELECT slice, count(*) + 1, count(*), -1, 'short' FROM landed
  WHERE slice = '{_ACTIVITY}' GROUP BY slice
UNION ALL SELECT 'lost slice', count(*), 0, -count(*), 'short' FROM landed
  WHERE slice = '{_ACTIVITY}'"""
    ),
    "clean_requests": _sql("SELECT * FROM unique_rows"),
    "csv_ingest": _sql("SELECT * FROM unique_rows"),
    "csv_ingest_torn_lines": _sql("SELECT * FROM unique_rows"),
    "csv_torn_lines": _sql(
        f"""SELECT slice, unique_key || ',' || created_date AS torn_line FROM landed
WHERE slice = '{_ACTIVITY}' ORDER BY torn_line LIMIT 3"""
    ),
    "csv_reconciliation_torn_lines": _sql(
        f"""SELECT slice, landed_rows + torn_rows AS expected_rows, landed_rows,
  -torn_rows AS difference, torn_rows, IF(torn_rows > 0, 'torn', 'complete') AS state
FROM (SELECT slice, count(*) AS landed_rows,
  IF(slice = '{_ACTIVITY}', least(count(*), 3), 0) AS torn_rows FROM landed GROUP BY slice)"""
    ),
    "extract_metadata": _sql(
        """SELECT slice AS item, CAST(count(*) AS DOUBLE) AS value FROM landed GROUP BY slice
UNION ALL SELECT 'total_after_dedup', CAST(count(*) AS DOUBLE) FROM unique_rows
UNION ALL SELECT 'snapshot_date', 20010805.0
UNION ALL SELECT 'sample_rows', least(count(*), 1000.0) FROM unique_rows
UNION ALL SELECT 'scaling_factor', count(*) / least(count(*), CAST(1000 AS DOUBLE)) FROM unique_rows"""
    ),
    "raw_preview": _sql(
        f"""{_raw(_IN_WINDOW)} ORDER BY unique_key, created_date, closed_date NULLS LAST, status,
  incident_zip LIMIT 2000"""
    ),
    "sample_requests": _sql(
        "SELECT * FROM requests ORDER BY md5('42:' || unique_key), unique_key LIMIT 1000"
    ),
    "closure_quantiles_fractional": _sql(
        f"""SELECT complaint_type, round(quantile_cont(closure_days, 0.5), 6) AS median_closure_days,
  round(quantile_cont(closure_days, 0.9), 6) AS p90_closure_days
FROM ({_facts("requests", fractional=True)}) GROUP BY complaint_type"""
    ),
    "dim_date": _sql(
        """SELECT day AS date, CAST(date_trunc('week', day) AS DATE) AS week_start,
  CAST(date_trunc('month', day) AS DATE) AS month_start, strftime(day, '%a') AS weekday
FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))
  AS DATE) AS day FROM orders)"""
    ),
    "requests_with_calendar": _sql(
        """SELECT unique_key, created_date_only, date, week_start, month_start, weekday
FROM with_days"""
    ),
    "dq_checks": _sql(_gate("requests")),
    "dq_checks_raw_lines": _sql(_gate("tidy")),
    "requests_enriched": _sql("SELECT * FROM facts"),
    "requests_enriched_fractional": _sql("SELECT * FROM sheet"),
    "requests_enriched_from_file": _sql("SELECT * FROM facts"),
    "kpi_by_agency": _sql("SELECT * FROM by_agency"),
    "kpi_by_complaint_type": _sql("SELECT * FROM by_type"),
    "kpi_by_borough": _sql("SELECT * FROM by_borough"),
    "kpi_weekly": _sql("SELECT * FROM weekly"),
    "backlog_aging": _sql("SELECT * FROM aging"),
    "priority_scores": _sql("SELECT * FROM scores"),
    "priority_scores_min_100": _sql(
        "SELECT * FROM scores_100", **_score_steps("facts", "_100", least=100)
    ),
    "n01_demand_concentration": _sql(
        """SELECT complaint_type, primary_agency, total_requests,
  round(100.0 * total_requests / (SELECT count(*) FROM facts), 1) AS pct_of_all
FROM by_type ORDER BY total_requests DESC, complaint_type LIMIT 15"""
    ),
    "n02_agency_pace": _sql(
        """SELECT * EXCLUDE (aged_open_30d_plus) FROM by_agency
ORDER BY total_requests DESC, agency LIMIT 15"""
    ),
    "n03_borough_pressure": _sql("SELECT * FROM by_borough ORDER BY total_requests DESC, borough"),
    "n04_weekly_rhythm": _sql("SELECT * FROM weekly ORDER BY created_week"),
    "n05_aging_backlog": _sql(
        """SELECT aging_bucket, count(*) AS open_requests,
  round(100.0 * count(*) / (SELECT count(*) FROM facts WHERE NOT is_closed), 1) AS pct_of_backlog
FROM facts WHERE NOT is_closed GROUP BY aging_bucket"""
    ),
    "n06_worst_sla": _sql(
        f"""SELECT complaint_type, primary_agency, total_requests, sla_miss_rate, avg_closure_days,
  open_requests FROM by_type WHERE total_requests >= 50
ORDER BY sla_miss_rate DESC NULLS LAST, complaint_type LIMIT 15"""
    ),
    "n06_worst_sla_floor_590": _sql(
        """SELECT complaint_type, primary_agency, total_requests, sla_miss_rate, avg_closure_days,
  open_requests FROM by_type WHERE total_requests >= 590
ORDER BY sla_miss_rate DESC NULLS LAST, complaint_type LIMIT 15"""
    ),
    "n07_hotspots": _sql(f"{_SCORE_LINE} WHERE priority_rank <= 20"),
    "n08_oldest_in_hotspots": _sql(
        """SELECT unique_key, complaint_type, borough, agency, CAST(created_date AS DATE) AS created,
  age_days, aging_bucket, status FROM facts
WHERE NOT is_closed AND (complaint_type, borough) IN
  (SELECT (complaint_type, borough) FROM scores WHERE priority_rank <= 10)
ORDER BY age_days DESC NULLS LAST, unique_key LIMIT 25"""
    ),
    "n09_channel_mix": _sql(
        """SELECT open_data_channel_type, count(*) AS requests,
  round(100.0 * count(*) / (SELECT count(*) FROM facts), 1) AS pct
FROM facts GROUP BY open_data_channel_type"""
    ),
    "n10_monthly_change": _sql(
        """SELECT borough, created_month, n AS requests,
  round(100.0 * (n - earlier) / nullif(earlier, 0), 1) AS mom_change_pct
FROM (SELECT *, lag(n) OVER (PARTITION BY borough ORDER BY created_month) AS earlier FROM busy)""",
        busy=f"""
  SELECT borough, created_month, count(*) AS n FROM facts
  WHERE slice = '{_ACTIVITY}' AND borough <> 'Unspecified' GROUP BY borough, created_month""",
    ),
    "sla_block_agency": _sql(_block("agency", tail="ORDER BY total DESC, agency LIMIT 12")),
    "sla_block_borough": _sql(
        _listed("borough", [f"'{b}'" for b in (*_BOROUGHS, "Unspecified")])
    ),
    "sla_block_type": _sql(
        _block("complaint_type", tail="ORDER BY total DESC, complaint_type LIMIT 15")
    ),
    "sla_block_month": _sql(
        _listed("created_month", [f"DATE '2001-0{m}-01'" for m in (5, 6, 7)])
    ),
    "sla_overall": _sql(
        """SELECT count(*) AS total,
  count_if(sla_status IN ('Missed', 'Open Past SLA')) AS sla_missed,
  count_if(sla_status <> 'Open Within SLA') AS sla_known,
  round(count_if(sla_status IN ('Missed', 'Open Past SLA'))
    / nullif(count_if(sla_status <> 'Open Within SLA'), 0), 4) AS sla_miss_rate,
  round(count_if(sla_status IN ('Missed', 'Open Past SLA'))::DOUBLE * any_value(factor), 0)
    AS estimated_missed
FROM drawn CROSS JOIN scale""",
        drawn=_DRAWN, scale=f"SELECT {_FACTOR} AS factor",
    ),
    "backlog_overall": _sql(
        """SELECT count_if(NOT is_closed) AS open_requests,
  round(count_if(NOT is_closed) / nullif(count(*), 0), 4) AS share_open,
  count_if(NOT is_closed AND age_days > 30) AS open_31_plus,
  count_if(NOT is_closed AND age_days > 90) AS open_91_plus,
  count_if(NOT is_closed AND age_days > 180) AS open_181_plus,
  round(avg(age_days) FILTER (WHERE NOT is_closed), 1) AS avg_age_days,
  round(count_if(NOT is_closed)::DOUBLE * any_value(factor), 0) AS estimated_open
FROM drawn CROSS JOIN scale""",
        drawn=_DRAWN, scale=f"SELECT {_FACTOR} AS factor",
    ),
    "aging_by_borough": _sql(
        f"""SELECT label AS aging_bucket, {_pivoted("count_if(borough = '{b}')")},
  count(unique_key) AS total
FROM (SELECT unnest(['0-7 days', '8-30 days', '31-90 days', '91-180 days', '180+ days']) AS label)
LEFT JOIN sheet ON aging_bucket = label GROUP BY label"""
    ),
    "weekly_flow": _sql(
        """SELECT week AS created_week, count(unique_key) AS created,
  count_if(is_closed) AS closed_by_snapshot, count_if(NOT is_closed) AS still_open
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2001-04-30', TIMESTAMP '2001-07-30',
  INTERVAL 7 DAY)) AS DATE) AS week) LEFT JOIN sheet ON created_week = week GROUP BY week"""
    ),
    "oldest_open": _sql(
        """SELECT age_days, unique_key, complaint_type, borough, agency,
  row_number() OVER (ORDER BY age_days DESC NULLS LAST, unique_key) AS rank
FROM sheet WHERE NOT is_closed QUALIFY rank <= 20"""
    ),
    "priority_grid": _sql("SELECT * FROM grid"),
    "action_list": _sql(
        """SELECT row_number() OVER (ORDER BY priority_rank, complaint_type, borough) AS position,
  complaint_type, borough, priority_score, open, sla_miss_rate FROM grid QUALIFY position <= 10"""
    ),
    "headline_kpis": _sql(
        """SELECT count(*) AS total_requests, count_if(NOT is_closed) AS open_requests,
  round(count_if(sla_status IN ('Missed', 'Open Past SLA'))
    / nullif(count_if(sla_status <> 'Open Within SLA'), 0), 4) AS sla_miss_rate,
  count_if(NOT is_closed AND age_days > 30) AS open_31_plus FROM sheet"""
    ),
    "pivot_agency": _sql(_pivot("agency", _SHARE + _MEAN)),
    "pivot_type_top15": _sql(_pivot("complaint_type", _SHARE + _MEAN, top=15)),
    "pivot_borough": _sql(_pivot("borough", _SHARE + _MEAN)),
    "pivot_month": _sql(_pivot("created_month", _SHARE)),
    "pivot_week": _sql(_pivot("created_week", "")),
    "pivot_sla_status": _sql(_pivot("sla_status", _SHARE)),
    "top_agencies": _sql(
        """SELECT agency, count(*) AS requests FROM requests GROUP BY agency
ORDER BY requests DESC, agency LIMIT 12"""
    ),
    "requests_per_day": _sql(
        "SELECT date, count(*) AS requests FROM with_days GROUP BY date"
    ),
    "daily_requests": _sql(
        f"""SELECT CAST(created_date AS DATE) AS created_day, count(*) AS requests FROM requests
WHERE slice = '{_ACTIVITY}' GROUP BY 1"""
    ),
    "weekly_by_borough": _sql(
        "SELECT week_start, borough, count(*) AS requests FROM with_days GROUP BY week_start, borough"
    ),
    "weekly_top_types": _sql(
        """SELECT week_start, complaint_type, count(*) AS requests,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY week_start), 1) AS pct_of_week
FROM with_days WHERE complaint_type IN (SELECT complaint_type FROM with_days
  GROUP BY complaint_type ORDER BY count(*) DESC, complaint_type LIMIT 5)
GROUP BY week_start, complaint_type"""
    ),
    "closure_histogram": _sql(
        """SELECT CAST(i AS INTEGER) AS bin, round(low + (high - low) / 30 * i, 4) AS from_days,
  round(low + (high - low) / 30 * (i + 1), 4) AS to_days, count(days) AS requests
FROM ends CROSS JOIN range(30) r(i)
LEFT JOIN capped ON least(floor((days - low) * 30 / (high - low)), 29) = i GROUP BY ALL""",
        capped="SELECT least(closure_days, 60) AS days FROM facts WHERE closure_days IS NOT NULL",
        ends="SELECT CAST(min(days) AS DOUBLE) AS low, CAST(max(days) AS DOUBLE) AS high FROM capped",
    ),
    "closed_by_5_day_bins": _sql(
        """SELECT closure_days // 5 * 5 AS from_days, count(*) AS closed_requests FROM facts
WHERE is_closed GROUP BY 1"""
    ),
    "score_matrix": _sql(
        f"""SELECT complaint_type, max(priority_score) AS max_score,
  {_pivoted("avg(priority_score) FILTER (WHERE borough = '{b}')", _BOROUGHS)}
FROM scores GROUP BY complaint_type ORDER BY max_score DESC, complaint_type LIMIT 10"""
    ),
    "open_by_bucket": _sql(
        """SELECT aging_bucket, count(*) AS open_requests, CASE aging_bucket WHEN '0-7 days' THEN 1
  WHEN '8-30 days' THEN 2 WHEN '31-90 days' THEN 3 WHEN '91-180 days' THEN 4 ELSE 5 END
  AS bucket_order FROM facts WHERE NOT is_closed AND aging_bucket IS NOT NULL GROUP BY aging_bucket"""
    ),
    "high_risk_backlog": _sql(
        """SELECT unique_key, complaint_type, borough, agency, created_date, age_days, status
FROM facts WHERE NOT is_closed AND aging_bucket = '180+ days'"""
    ),
    "hotspot_labels": _sql(
        f"SELECT priority_rank, {_LABEL} AS label, priority_score FROM scores WHERE priority_rank <= 5"
    ),
    "hotspot_table": _sql(
        f"""SELECT complaint_type, borough, agency, total_requests, open_requests, sla_miss_rate,
  dynamic_score, dynamic_rank FROM scores JOIN (
  {_whatif("complaint_type, borough", (0.10, 0.40, 0.05, 0.60))})
  USING (complaint_type, borough) WHERE dynamic_rank <= 10"""
    ),
    "static_score_by_type": _sql(
        """SELECT complaint_type, max(priority_score) AS priority_score FROM scores
GROUP BY complaint_type"""
    ),
    "score_components": _sql(
        """SELECT priority_rank, complaint_type, borough, open_requests, sla_miss_rate,
  volume_percentile, backlog_percentile, aged_share_of_open, priority_score
FROM scores WHERE priority_rank <= 10"""
    ),
    "busiest_agencies_by_miss_rate": _sql(
        """SELECT agency, total_requests, sla_miss_rate FROM by_agency
ORDER BY total_requests DESC, agency LIMIT 12"""
    ),
    "worst_types": _sql(
        f"""SELECT complaint_type, total_requests, sla_miss_rate FROM by_type
WHERE total_requests >= 50
ORDER BY sla_miss_rate DESC NULLS LAST, complaint_type LIMIT 10"""
    ),
    "placed_boroughs": _sql(
        "SELECT borough, total_requests FROM by_borough WHERE borough <> 'Unspecified'"
    ),
    "measures_overall": _sql(f"SELECT {_MEASURES} FROM facts"),
    "measures_by_type": _sql(
        f"SELECT complaint_type, {_MEASURES} FROM facts GROUP BY complaint_type"
    ),
    "measures_top_types": _sql(
        f"""SELECT complaint_type, total_requests, median_closure_days, sla_miss_rate
FROM (SELECT complaint_type, {_MEASURES} FROM facts GROUP BY complaint_type)
ORDER BY total_requests DESC, complaint_type LIMIT 15"""
    ),
    "measures_by_agency_sliced": _sql(
        f"SELECT agency, {_MEASURES} FROM facts WHERE {_SLICED} GROUP BY agency"
    ),
    "measures_by_week": _sql(
        """SELECT week_start, count(*) AS total_requests, count_if(is_closed) AS closed_requests
FROM with_days GROUP BY week_start"""
    ),
    "share_by_borough": _sql(
        """SELECT borough, count(*) AS total_requests,
  count(*) / (SELECT count(*) FROM facts) AS share_of_total FROM facts GROUP BY borough"""
    ),
    "share_by_channel_sliced": _sql(
        f"""SELECT open_data_channel_type, count(*) AS total_requests,
  count(*) / (SELECT count(*) FROM facts WHERE {_SLICED}) AS share_of_total
FROM facts WHERE {_SLICED} GROUP BY open_data_channel_type"""
    ),
    "month_over_month": _sql(_MONTHS, months=_MONTHS_STEP),
    "month_over_month_by_type": _sql(_TYPE_MONTHS, months=_TYPE_MONTHS_STEP),
    "whatif_default": _sql(_whatif("complaint_type, borough", (0.30, 0.25, 0.25, 0.20))),
    "whatif_other_weights": _sql(_whatif("complaint_type, borough", _OTHER)),
    "whatif_by_type": _sql(_whatif("complaint_type", _OTHER)),
    "weight_sensitivity": _sql(
        """SELECT slider, step, complaint_type, borough, round(score, 4) AS dynamic_score,
  dense_rank() OVER (PARTITION BY slider, step ORDER BY score DESC) AS dynamic_rank,
  dense_rank() OVER (PARTITION BY slider, step ORDER BY score DESC) - priority_rank AS rank_change
FROM tried""",
        tried=f"""
  SELECT s.*, slider, step, round((v * volume_percentile + b * backlog_percentile
      + m * coalesce(sla_miss_rate, 0) + a * aged_share_of_open) / (v + b + m + a), 9) AS score
  FROM scores s CROSS JOIN (VALUES {_scenarios()}) w(slider, step, v, b, m, a)""",
    ),
    "escalate_missing_targets": _sql(
        """SELECT priority_rank, complaint_type, borough, agency, sla_miss_rate FROM scores
WHERE priority_rank <= 10 AND sla_miss_rate > 0.60"""
    ),
    "escalate_growing_backlog": _sql(
        """SELECT priority_rank, s.complaint_type, s.borough, weeks_ago_2, weeks_ago_1, weeks_ago_0,
  weeks_ago_0 > weeks_ago_1 AND weeks_ago_1 > weeks_ago_2 AS escalate
FROM scores s JOIN history h ON s.complaint_type = h.complaint_type AND s.borough = h.borough
WHERE priority_rank <= 10""",
        history=_HISTORY,
    ),
    "aged_open_history": _sql("SELECT * FROM history", history=_HISTORY),
    "escalate_past_limit": _sql(
        """SELECT unique_key, complaint_type, borough, agency, age_days, sla_status FROM facts
WHERE NOT is_closed AND age_days > 180"""
    ),
    "escalate_unspecified_share": _sql(
        """SELECT count_if(borough = 'Unspecified') AS unspecified, count(*) AS total,
  round(count_if(borough = 'Unspecified') / count(*), 6) AS share,
  count_if(borough = 'Unspecified') / count(*) > 0.005 AS escalate FROM requests"""
    ),
    "new_hotspots": _new_hotspots(),
    "artifact_candidates": _sql("SELECT * FROM never_closed", **_FROZEN),
    "separate_lines": _sql(_lines(), **_FROZEN),
    "totals_reconciliation": _sql(
        """SELECT unnest(['agency', 'complaint_type', 'borough']) AS rollup,
  (SELECT count(*) FROM orders) AS total, true AS matches"""
    ),
    "export_manifest": _sql(
        f"""SELECT 'fact_service_requests' AS table_name, 'parquet' AS format, count(*) AS row_count
  FROM facts
UNION ALL SELECT 'kpi_by_agency', 'csv', count(*) FROM by_agency
UNION ALL SELECT 'kpi_by_complaint_type', 'csv', count(*) FROM by_type
UNION ALL SELECT 'kpi_by_borough', 'csv', count(*) FROM by_borough
UNION ALL SELECT 'kpi_weekly', 'csv', count(*) FROM weekly
UNION ALL SELECT 'backlog_aging', 'csv', count(*) FROM aging
UNION ALL SELECT 'priority_scores', 'csv', count(*) FROM scores
UNION ALL SELECT 'dim_sla_targets', 'csv', {len(_TARGET_DAYS) + 1}
UNION ALL SELECT 'dim_date', 'csv', date_diff('day', DATE '{_OLD}', DATE '{_TO}')"""
    ),
    "exported_kpi_by_agency": _sql("SELECT * FROM by_agency"),
    "exported_fact": _sql("SELECT * FROM facts"),
}

# The same results by another plan.
ORACLE |= {
    f"one_scan_{name}": ORACLE[name]
    for name in ("kpi_by_agency", "kpi_by_complaint_type", "kpi_by_borough", "kpi_weekly",
                 "backlog_aging", "priority_scores")
}
ORACLE |= {
    f"{name}_stored": ORACLE[name]
    for name in ("measures_overall", "measures_by_agency_sliced", "share_by_channel_sliced",
                 "month_over_month_by_type")
}
ORACLE |= {
    "requests_in_chosen_weeks": _sql(
        """SELECT borough, weekday, count(*) AS requests FROM with_days
WHERE week_start IN (DATE '2001-05-14', DATE '2001-05-21') GROUP BY borough, weekday"""
    ),
    "aged_open_by_week": _sql(
        f"""SELECT complaint_type, borough, snapshot, count_if(
  (closed_date IS NULL OR closed_date < created_date
   OR closed_date >= snapshot + INTERVAL 1 DAY)
  AND date_diff('day', CAST(created_date AS DATE), snapshot) > 30) AS aged_open
FROM requests, (SELECT CAST(DATE '{_SNAP[:10]}' - INTERVAL (7 * w) DAY AS DATE) AS snapshot
                FROM range(52) AS weeks(w))
WHERE borough <> 'Unspecified' GROUP BY complaint_type, borough, snapshot"""
    ),
}
