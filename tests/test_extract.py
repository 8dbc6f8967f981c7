"""Torn lines of an extract are set apart and counted; samples keep the order of the extract."""

import random

from pyspark.sql import functions as F

from caselens.operators import ranking
from caselens.params import ACTIVITY, BACKLOG
from caselens.plans.export import prepare
from caselens.sources import raw, schemas
from checks import queries
from fixtures import PARAMS
from test_preparation import raw_row, write_extract

TORN = ["7,2026-04-02", '8,"open quote', ",".join(["x"] * 14)]


def extract(path, keys, torn=()):
    """A CSV of these keys in this order, with torn lines among them."""
    write_extract(path, [raw_row(key, borough="QUEENS", status="Open") for key in keys])
    if torn:
        head, *lines = path.read_text().splitlines()
        for i, line in enumerate(torn):
            lines.insert(i * len(lines) // len(torn), line)
        path.write_text("\n".join([head, *lines]) + "\n")
    return str(path)


def shuffled(count):
    keys = [str(i) for i in range(count)]
    random.Random(5).shuffle(keys)
    return keys


def test_torn_lines_are_set_apart(spark, tmp_path):
    keys = shuffled(200)
    scanned = raw.read_extract(spark, extract(tmp_path / "a.csv", keys, TORN))
    tagged = raw.stack_slices(scanned, scanned.limit(0))
    assert sorted(r.torn_line for r in raw.torn_lines(tagged).collect()) == sorted(TORN)
    kept = raw.sound(scanned)
    assert kept.columns == list(schemas.RAW_COLUMNS)
    assert sorted(r.unique_key for r in kept.collect()) == sorted(keys)
    # Also when no other column, or only one, is asked for.
    assert kept.count() == 200 and scanned.filter("torn_line IS NOT NULL").count() == 3
    assert kept.select("agency").count() == 200


def test_an_extract_without_torn_lines_reads_as_before(spark, tmp_path):
    rows = [raw_row("0001", descriptor='say "hi", twice', agency="NA"), raw_row("2", descriptor=" NA ")]
    path = write_extract(tmp_path / "a.csv", rows)
    kept = raw.sound(raw.read_extract(spark, path))
    assert sorted(kept.collect()) == sorted(raw.read_raw_csv(spark, path).collect())
    broken = write_extract(tmp_path / "b.csv", [raw_row("1", descriptor="two\nlines")])
    lines = raw.read_extract(spark, broken, multiline=True).collect()
    assert [(r.descriptor, r.torn_line) for r in lines] == [("two\nlines", None)]


def test_positions_order_rows_however_files_are_split(spark, tmp_path):
    keys = shuffled(3000)
    path = extract(tmp_path / "a.csv", keys)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tasks = set()
    try:
        for size in ("128MB", "20KB", "3KB"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            scanned = raw.read_extract(spark, path)
            tasks.add(scanned.rdd.getNumPartitions())
            assert [r.unique_key for r in scanned.orderBy(*raw.POSITION).collect()] == keys
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(tasks) == 3


def test_prepare_sets_torn_lines_apart_and_keeps_the_order(spark, tmp_path):
    keys, older = shuffled(300), [f"b{i}" for i in shuffled(100)]
    activity = raw.read_extract(spark, extract(tmp_path / "a.csv", [*keys, *keys[:20]], TORN))
    backlog = raw.read_extract(spark, extract(tmp_path / "b.csv", [*older, *keys[:5]]))
    found = prepare(
        activity, backlog, PARAMS, str(tmp_path / "out"), sample_rows=60
    )
    assert found.requests.count() == 400
    assert sorted(r.torn_line for r in found.torn_lines.collect()) == sorted(TORN)
    drawn = [r.unique_key for r in found.sample.collect()]
    again = ranking.sample_exact(found.requests, "unique_key", 60, 42).collect()
    assert sorted(drawn) == sorted(r.unique_key for r in again)
    assert drawn == [key for key in [*keys, *older] if key in set(drawn)]
    assert found.preview.count() == 320
    counts = {r["slice"]: r for r in raw.reconcile_counts(
        found.slice_counts, {ACTIVITY: 323, BACKLOG: 106}, found.torn_lines).collect()}
    assert (counts[ACTIVITY].state, counts[ACTIVITY].torn_rows) == ("torn", 3)
    assert (counts[BACKLOG].state, counts[BACKLOG].torn_rows) == ("short", 0)


def test_a_slice_of_torn_lines_only(spark):
    torn = spark.createDataFrame([("s", "f", "x")], "slice string, source_file string, torn_line string")
    none = spark.createDataFrame([], "slice string, landed_rows long")
    row, = raw.reconcile_counts(none, {"s": 2}, torn).collect()
    assert (row.landed_rows, row.torn_rows, row.difference, row.state) == (0, 1, -2, "short")


def test_written_extracts_are_small_and_come_from_one_pass(spark, data, tmp_path, monkeypatch):
    """What is written, torn lines too, is far less than the text of its lines, and none is lost."""
    monkeypatch.setattr(queries, "shared_folder", lambda _: str(tmp_path))
    landed, sent = queries.torn_source(spark, data)
    lines = spark.read.parquet(f"{tmp_path}/sent")
    bulk = lines.agg(F.sum(F.length(F.concat_ws(",", *schemas.RAW_COLUMNS)))).first()[0]
    files = [p for name in ("activity", "backlog") for p in (tmp_path / name).glob("part-*")]
    assert sum(p.stat().st_size for p in files) < bulk / 4
    counts = dict(raw.slice_counts(lines).collect())
    assert dict(sent.collect()) == {**counts, ACTIVITY: counts[ACTIVITY] + 3}
    assert landed.count() == sum(counts.values()) + 3
    some = ("slice", "unique_key", "created_date")
    assert raw.sound(landed).select(*some).exceptAll(lines.select(*some)).isEmpty()
