"""Raw text rows: CSV scan, cleaning, de-duplication, metadata, samples."""

import csv
import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caselens.functions import round_half, strip_text, title_text
from caselens.operators import cleaning, ranking
from caselens.operators.quality import dq_checks
from caselens.params import ACTIVITY, BACKLOG
from caselens.plans.export import EXPORTS, export, prepare, read_export
from caselens.sources import raw, schemas, sla, tables
from fixtures import PARAMS, at, days_before, frame, row


def raw_row(key, **other):
    base = dict.fromkeys(schemas.RAW_COLUMNS)
    base.update(unique_key=key, created_date="2026-04-02T10:00:00.000", **other)
    return tuple(base[name] for name in schemas.RAW_COLUMNS)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW)


def write_extract(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file)
        writer.writerow(schemas.RAW_COLUMNS)
        writer.writerows(["" if v is None else v for v in r] for r in rows)
    return str(path)


@pytest.mark.parametrize(
    "text", ["o'neil-ray 3rd", "ÉCOLE d'été", "  a  b ", "x_y z9z", "STATEN ISLAND", "", "ab1cd"]
)
def test_title_text_follows_python(spark, text):
    value = spark.range(1).select(title_text(F.lit(text))).first()[0]
    assert value == text.title()


@pytest.mark.parametrize("text", ["\t a b \n", "\xa0x ", "\x1c\x85y", None, "   "])
def test_strip_text_follows_python(spark, text):
    value = spark.range(1).select(strip_text(F.lit(text).cast("string"))).first()[0]
    assert value == (text or "").strip()


def test_round_half_scales_in_binary(spark):
    values = [0.285, 1.005, 2.5, -2.5, 0.125, 1e15 + 0.3, None]
    digits = [2, 2, 0, 0, 2, 1, 2]
    got = [
        spark.range(1).select(round_half(F.lit(v).cast("double"), d)).first()[0]
        for v, d in zip(values, digits)
    ]
    assert got == [0.28, 1.0, 3.0, -3.0, 0.13, 1e15 + 0.3, None]


def test_csv_scan_keeps_text_and_missing_values(spark, tmp_path):
    rows = [
        raw_row("0001", descriptor='say "hi", twice', incident_zip="00501", agency="NA"),
        raw_row("2", descriptor=" NA ", borough="N/A", status="None"),
        raw_row("3", descriptor="", location_type="nan"),
    ]
    scanned = raw.read_raw_csv(spark, write_extract(tmp_path / "a.csv", rows))
    got = {r["unique_key"]: r for r in scanned.collect()}
    assert got["0001"]["descriptor"] == 'say "hi", twice'
    assert got["0001"]["incident_zip"] == "00501" and got["0001"]["agency"] is None
    assert got["2"]["descriptor"] == " NA " and got["2"]["borough"] is None
    assert got["3"]["descriptor"] is None and got["3"]["location_type"] is None


def test_csv_scan_with_line_breaks(spark, tmp_path):
    path = write_extract(tmp_path / "a.csv", [raw_row("1", descriptor="two\nlines"), raw_row("2")])
    scanned = raw.read_raw_csv(spark, path, multiline=True)
    assert scanned.filter("unique_key = '1'").first()["descriptor"] == "two\nlines"
    assert scanned.count() == 2


def test_wrong_header_is_refused(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(reversed(schemas.RAW_COLUMNS)) + "\n" + "," * 11 + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_raw_csv(spark, str(path)).collect()


def test_cleaning(spark):
    rows = [
        raw_row("1", borough="  STATEN ISLAND ", incident_zip="11201-1234", closed_date="garbage"),
        raw_row("2", borough="", incident_zip=" 1120", agency="  DPR\t"),
        raw_row("3", borough=None, incident_zip=None),
        raw_row("4", borough=" unspecified "),
    ]
    cleaned = cleaning.clean(raw_frame(spark, rows).withColumn("slice", F.lit(ACTIVITY)))
    got = {r["unique_key"]: r for r in cleaned.collect()}
    assert cleaned.schema.names == schemas.REQUESTS.names
    assert [got[k]["borough"] for k in "1234"] == ["Staten Island"] + ["Unspecified"] * 3
    assert [got[k]["incident_zip"] for k in "123"] == ["11201", "1120", ""]
    assert got["1"]["created_date"] == datetime(2026, 4, 2, 10) and got["1"]["closed_date"] is None
    assert got["2"]["agency"] == "DPR" and got["3"]["agency"] == ""
    flagged = {r["check_name"][:2]: r["records_flagged"] for r in dq_checks(cleaned, PARAMS).collect()}
    assert flagged["09"] == 1 and flagged["07"] == 3 and flagged["08"] == 4


def test_slices(spark):
    rows = [
        ("in", "2026-04-01T00:00:00.000", "Closed"), ("last", "2026-06-30T23:59:59.000", "Open"),
        ("end", "2026-07-01T00:00:00.000", "Open"), ("old", "2026-03-31T23:59:00.000", "Open"),
        ("old closed", "2026-03-31T00:00:00.000", "Closed"), ("too old", "2024-12-31", "Open"),
        ("no status", "2026-01-05T00:00:00.000", None), ("no date", "x", "Open"),
    ]
    source = spark.createDataFrame(rows, "unique_key string, created_date string, status string")
    for name in schemas.RAW_COLUMNS:
        if name not in source.columns:
            source = source.withColumn(name, F.lit("").cast("string"))
    wide = source.withColumn("unused", F.lit(1))
    activity, backlog = raw.activity_slice(wide, PARAMS), raw.backlog_slice(wide, PARAMS)
    assert {r[0] for r in activity.collect()} == {"in", "last"}
    assert {r[0] for r in backlog.collect()} == {"old"}
    assert tuple(activity.columns) == schemas.RAW_COLUMNS
    stacked, labelled = raw.stack_slices(activity, backlog), raw.label_slices(wide, PARAMS)
    assert sorted(stacked.collect(), key=str) == sorted(labelled.collect(), key=str)


def test_activity_row_wins_over_backlog(spark):
    rows = [
        row("k", at("04-02"), slice=BACKLOG, agency="A"),
        row("k", at("04-03"), slice=ACTIVITY, agency="Z"),
        row("k", at("04-05"), slice=ACTIVITY, agency="Y"),
        row("n", None, slice=BACKLOG),
    ]
    kept = cleaning.deduplicate(frame(spark, rows))
    assert kept.columns == schemas.REQUESTS.names
    assert {(r["unique_key"], r["slice"], r["agency"]) for r in kept.collect()} == {
        ("k", ACTIVITY, "Z"), ("n", BACKLOG, "AG")
    }


def test_deduplicate_hot_key(spark):
    """A third of all rows share one key."""
    rng = random.Random(7)
    rows = [
        row("hot" if i % 3 == 0 else f"k{rng.randrange(400)}", days_before(rng.randrange(200)),
            agency=f"A{rng.randrange(50)}", slice=rng.choice([ACTIVITY, BACKLOG]))
        for i in range(3_000)
    ]
    best = {}
    names = schemas.REQUESTS.names
    where = names.index("slice")
    for r in rows:
        rank = (r[where] != ACTIVITY, r[1], r[2] or "", *r[3:])
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    kept = cleaning.deduplicate(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in kept) == sorted(r for _, r in best.values())


def test_quality_counts_missing_keys_as_duplicates(spark):
    rows = [row(None, at("06-01")), row(None, at("06-01")), row("a", at("06-01")),
            row("a", at("06-02")), row("b", None, at("07-07"), status=None)]
    result = {r["check_name"][:2]: r for r in dq_checks(frame(spark, rows), PARAMS).collect()}
    assert result["01"]["records_flagged"] == 3 and result["01"]["pct_of_total"] == 60.0
    assert result["02"]["records_flagged"] == 1
    assert result["04"]["records_flagged"] == 0
    assert result["06"]["records_flagged"] == 1


def test_quality_future_check_is_strict(spark):
    rows = [row("edge", at("07-01"), at("07-06")), row("past", at("07-01"), at("07-06 00:01"))]
    result = {r["check_name"][:2]: r for r in dq_checks(frame(spark, rows), PARAMS).collect()}
    assert result["06"]["records_flagged"] == 1


def test_quality_on_no_rows(spark):
    result = dq_checks(frame(spark, []), PARAMS).collect()
    assert len(result) == 9
    assert {(r["records_flagged"], r["pct_of_total"]) for r in result} == {(0, None)}


def _keys(size):
    """Keys that all share ten leading characters, many of them equal, empty or missing."""
    rng = random.Random(size)
    return [f"2026-07-05{rng.choice(['100', '200', 'ab'])}{rng.randrange(10**rng.randrange(1, 6))}"
            for _ in range(600)] + ["2026-07-05100123"] * 300 + [""] * 50 + [None] * 50


@pytest.mark.parametrize("size", [1, 5, 100, 999, 1_000, 5_000])
def test_preview_and_sample_are_exact_limits(spark, size):
    keys = _keys(size)
    numbered = spark.createDataFrame(list(enumerate(keys)), "n int, unique_key string").repartition(5)
    got = ranking.preview(numbered, size).collect()
    assert [r["unique_key"] or "" for r in got] == sorted(k or "" for k in keys)[:size]
    drawn = ranking.sample_exact(numbered, "unique_key", size, 42).collect()

    def draw(key):
        return hashlib.md5(f"42:{key or ''}".encode()).hexdigest()

    wanted = sorted(map(draw, keys))[:size]
    assert sorted(draw(r["unique_key"]) for r in drawn) == wanted
    assert len({r["n"] for r in drawn}) == min(size, len(keys))


def test_unparsed_dates_lose_against_parsed_ones(spark):
    rows = [row("a", None), row("a", at("06-02")), row("a", at("06-03")), row("b", None),
            row("c", at("06-04"), slice=BACKLOG), row("c", None), row(None, at("06-05")),
            row(None, at("06-06")), row("d", None), row("d", None)]
    kept = cleaning.deduplicate(frame(spark, rows)).collect()
    assert sorted((r["unique_key"] or "", r["created_date"], r["slice"]) for r in kept
                  if r["created_date"]) == [
        ("", at("06-05"), ACTIVITY), ("a", at("06-02"), ACTIVITY)]
    assert sorted(r["unique_key"] for r in kept if not r["created_date"]) == ["b", "c", "d"]


def test_sample_is_exact_and_reproducible(spark):
    requests = frame(spark, [row(str(i), at("06-01")) for i in range(500)])
    first = {r["unique_key"] for r in ranking.sample_exact(requests, "unique_key", 60, 42).collect()}
    again = ranking.sample_exact(requests.repartition(7), "unique_key", 60, 42).collect()
    other = ranking.sample_exact(requests, "unique_key", 60, 43).collect()
    assert len(first) == 60 == len(other)
    assert first == {r["unique_key"] for r in again}
    assert first != {r["unique_key"] for r in other}
    assert ranking.sample_exact(requests, "unique_key", 501, 42).count() == 500


def test_prepare_and_export(spark, tmp_path):
    activity = [
        raw_row(str(i), closed_date="2026-04-09T08:00:00.000" if i % 2 else None, agency="DPR",
                agency_name="Parks", complaint_type="Rodent, live", borough="QUEENS",
                status="Closed" if i % 2 else "Open", open_data_channel_type="PHONE")
        for i in range(40)
    ]
    older = [
        (*raw_row(str(i))[:1], "2026-01-05T09:00:00.000", *raw_row(str(i))[2:])
        for i in range(38, 45)
    ]
    prepared = prepare(
        raw.read_raw_csv(spark, write_extract(tmp_path / "a.csv", activity)),
        raw.read_raw_csv(spark, write_extract(tmp_path / "b.csv", older)),
        PARAMS,
        str(tmp_path / "processed"),
        sample_rows=10,
    )
    assert prepared.requests.count() == 45
    assert prepared.sample.count() == 10 and prepared.preview.count() == 40
    assert {r["item"]: r["value"] for r in prepared.metadata.collect()} == {
        ACTIVITY: 40, BACKLOG: 7, "total_after_dedup": 45, "sample_rows": 10, "scaling_factor": 4.5,
        "snapshot_date": float(f"{PARAMS.snapshot_date:%Y%m%d}"),
    }
    targets = sla.published_targets(spark, PARAMS.default_sla_days)
    out = str(tmp_path / "exports")
    counts = {r["table_name"]: r["row_count"] for r in export(prepared.requests, targets, PARAMS, out).collect()}
    assert set(counts) == set(EXPORTS)
    assert counts["fact_service_requests"] == 45
    assert counts["dim_sla_targets"] == 31 and counts["dim_date"] == 546
    for name, (_, schema) in EXPORTS.items():
        assert read_export(spark, out, name).schema.names == schema.names
    agency = {r["agency"]: r for r in read_export(spark, out, "kpi_by_agency").collect()}
    assert agency["DPR"]["total_requests"] == 40 and agency["DPR"]["agency_name"] == "Parks"
    assert agency[""]["total_requests"] == 5 and agency[""]["agency_name"] == ""


def test_targets_file(spark, tmp_path):
    path = tables.write_csv(sla.published_targets(spark, 14).frame, str(tmp_path / "targets"))
    targets = sla.read_targets(spark, path, 99)
    assert (targets.frame.count(), targets.default_days) == (31, 14)
    assert dict(targets.frame.select("complaint_type", "sla_days").collect())["Graffiti"] == 60
    assert dict(targets.frame.dtypes)["sla_days"] == "int"


def test_reconcile_counts(spark):
    landed = frame(
        spark, [row("a"), row("b"), row("c", slice=BACKLOG), row("d", slice="surprise")]
    )
    result = raw.reconcile_counts(
        raw.slice_counts(landed), {ACTIVITY: 2, BACKLOG: 3, "other": 1}
    )
    assert {r["slice"]: (r["difference"], r["state"]) for r in result.collect()} == {
        ACTIVITY: (0, "complete"), BACKLOG: (-2, "short"), "other": (-1, "short"),
        "surprise": (1, "unexpected"),
    }
    assert {r["state"] for r in raw.reconcile_counts(raw.slice_counts(landed), {}).collect()} == {
        "unexpected"
    }
