"""Run the whole analysis: ``python -m caselens --activity a.csv --backlog b.csv --out folder``.

Everything is written whole, as tables below the output folder.
"""

from __future__ import annotations

import argparse
from datetime import date

from caselens.params import Params
from caselens.plans import reports
from caselens.plans.analysis import answers
from caselens.plans.export import export_all, prepare, write_all
from caselens.session import build_session
from caselens.sources import raw, sla


def main() -> None:
    parser = argparse.ArgumentParser(prog="caselens", description=__doc__)
    parser.add_argument("--activity", required=True, help="raw CSV of the activity window")
    parser.add_argument("--backlog", required=True, help="raw CSV of the older open requests")
    parser.add_argument("--targets", help="SLA target CSV; the published targets if omitted")
    parser.add_argument("--out", required=True, help="output folder shared by all executors")
    parser.add_argument("--snapshot", type=date.fromisoformat, default=Params().snapshot_date)
    parser.add_argument(
        "--expected", action="append", default=[], metavar="SLICE=ROWS",
        help="rows of a slice that the source reported; given once per slice",
    )
    parser.add_argument("--multiline", action="store_true", help="fields may hold line breaks")
    args = parser.parse_args()

    spark = build_session("caselens")
    params = Params(snapshot_date=args.snapshot)
    if args.targets:
        targets = sla.read_targets(spark, args.targets, params.default_sla_days)
    else:
        targets = sla.published_targets(spark, params.default_sla_days)
    prepared = prepare(
        raw.read_extract(spark, args.activity, multiline=args.multiline),
        raw.read_extract(spark, args.backlog, multiline=args.multiline),
        params,
        f"{args.out}/processed",
    )
    exports = f"{args.out}/exports"
    exported = export_all(prepared.requests, targets, params, exports)
    fact, made = exported.fact, exported.rollups
    expected = {name: int(rows) for name, _, rows in (e.partition("=") for e in args.expected)}
    reconciled = raw.reconcile_counts(prepared.slice_counts, expected, prepared.torn_lines)
    factor = prepared.metadata.filter("item = 'scaling_factor'").select("value").scalar()
    write_all({"manifest": exported.manifest}, exports)
    write_all({"torn_lines": prepared.torn_lines}, f"{args.out}/quarantine")
    write_all(answers(fact, params, made), f"{args.out}/answers")
    write_all(
        reports.gate(prepared.requests, reconciled, made, params), f"{args.out}/quality"
    )
    write_all(
        reports.escalations(prepared.requests, fact, made, targets, params),
        f"{args.out}/escalation",
    )
    write_all(
        reports.workbook_tables(prepared.sample, targets, params, factor), f"{args.out}/workbook"
    )
    write_all(reports.dashboard_tables(fact, made), f"{args.out}/dashboard")


if __name__ == "__main__":
    main()
