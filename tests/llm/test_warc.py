"""Archives and their audit: bytes, offsets, trees, and every kind of damage."""

import gzip
import hashlib
import re
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caselens.llm import warc
from caselens.llm.common import table
from caselens.llm.queries import QUERIES
from caselens.session import shared_folder
from samples import prose

SCHEMA = "page_id long, url string, html string, volume long, record string"


def odd_pages(spark, count=60):
    rows = [(i, f"http://x.org/{i}", f"<p>{prose(i, 20 + i)}</p>", 5, "r") for i in range(count)]
    rows += [(900, None, None, None, None), (901, "", "", 0, ""), (None, "http://n", "no id", 1, ""),
             (902, "http://a\r\nb: c", "a\r\n\r\nb\r\n\r\n\r\n\r\nWARC/1.0\r\n", 1, ""),
             (903, "http://é", "ü" * 1000, 1, ""), (904, "x", "\n\r\n\r\n", 1, "")]
    rows += [(7, "http://x.org/7", f"<p>{prose(7, 27)}</p>", 5, "r")] * 2
    return spark.createDataFrame(rows, SCHEMA)


def contents(path):
    return {
        int(re.search(r"volume=(\d+)", str(p))[1]): gzip.decompress(p.read_bytes())
        for p in Path(path).rglob("*.gz")
    }


def test_records_are_found_again(spark):
    pages, path = odd_pages(spark), shared_folder(spark)
    warc.write_archive(pages, path, volume_bytes=1 << 12)
    found, volumes = warc.read_records(spark, path).collect(), contents(path)
    assert len(volumes) > 1
    assert sorted(str(r.page_id) for r in found) == sorted(str(r.page_id) for r in pages.collect())
    html = {r.page_id: r.html for r in pages.collect()}
    for r in found:
        record = volumes[r.volume][r.begin : r.end]
        assert bytes(r.digest) == hashlib.sha256(b"\0" + record).digest()
        head, _, body = record.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.0\r\n") and body.endswith(b"\r\n\r\n")
        assert body[:-4].decode() == (html[r.page_id] or "")
    for volume, content in volumes.items():
        spans = sorted((r.begin, r.end) for r in found if r.volume == volume)
        assert [b for b, _ in spans] == [0, *(e for _, e in spans[:-1])]
        assert spans[-1][1] == len(content)


def plain_root(digests, fanout):
    while len(digests) > 1:
        digests = [
            hashlib.sha256(b"\1" + b"".join(digests[i : i + fanout])).digest()
            for i in range(0, len(digests), fanout)
        ]
    return digests[0]


@pytest.mark.parametrize("fanout", [2, 32])
def test_tree_is_that_of_plain_hashing(spark, fanout):
    rows = [(0, i, i, 10 * i, 10 * i + 10, hashlib.sha256(bytes([i])).digest()) for i in range(37)]
    leaves = spark.createDataFrame(rows, warc._SCHEMA)
    inner = warc._height(37, fanout)
    nodes = warc.tree(leaves, inner, 0, fanout).collect()
    top = [n for n in nodes if n.level == inner]
    assert len(top) == 1 and (top[0].begin, top[0].end) == (0, 370)
    assert bytes(top[0].digest) == plain_root([r[5] for r in rows], fanout)


def archived_twice(spark, value=None):
    out = shared_folder(spark)
    warc.write_archive(odd_pages(spark), f"{out}/a", volume_bytes=1 << 12)
    warc.copy_archive(spark, f"{out}/a", f"{out}/b", value)
    return f"{out}/a", f"{out}/b"


def test_a_copy_is_intact_and_stops_at_the_root(spark, monkeypatch):
    a, b = archived_twice(spark)
    assert contents(a) == contents(b)
    levels = []
    below = warc._below
    monkeypatch.setattr(warc, "_below", lambda n, w, level: levels.append(level) or below(n, w, level))
    rows = warc.audited(spark, a, b, fanout=4).collect()
    assert len(rows) == odd_pages(spark).count() and {r.status for r in rows} == {"intact"}
    assert levels == []


@pytest.mark.parametrize("fanout", [2, 32])
def test_changed_bytes_are_located(spark, fanout):
    value = F.when(F.col("body").startswith("<p>w1"), F.expr("concat(left(body, length(body) - 1), '!')"))
    a, b = archived_twice(spark, value.otherwise(F.col("body")))
    before, after = contents(a), contents(b)
    rows = warc.audited(spark, a, b, fanout).collect()
    for r in rows:
        same = before[r.volume][r.begin : r.end] == after[r.volume][r.begin : r.end]
        assert r.status == ("intact" if same else "corrupt")
    assert {r.status for r in rows} == {"intact", "corrupt"}


@pytest.mark.parametrize("end", ["\r\n", "\r", "\n", "\r\n\r\n", "\r\n\r\n\r\n", ""])
def test_bodies_may_end_in_line_breaks(spark, end):
    """In every place of a volume, the last one too, and before headers."""
    out = shared_folder(spark)
    rows = [(i, f"http://h/{i}", f"<p>{i}" * (i % 3) + end) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archive(pages, f"{out}/a", volume_bytes=64)
    warc.copy_archive(spark, f"{out}/a", f"{out}/b")
    assert contents(f"{out}/a") == contents(f"{out}/b")
    found = warc.audited(spark, f"{out}/a", f"{out}/b").collect()
    assert sorted(r.page_id for r in found) == list(range(60))
    assert {r.status for r in found} == {"intact"}


def test_values_rejoin_to_the_volume():
    good = b"WARC/1.0\r\nX-Page-Id: 1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n\r\n"
    for content in (good * 3, b"garbage" + good, good + b"x\r\n\r\n" + good, b"odd\r\n\r\n" + good):
        batch = pa.record_batch({"volume": [0], "content": [gzip.compress(content)]})
        parts = [(h.as_py(), b.as_py()) for out in warc._values(iter([batch]))
                 for h, b in zip(out.column("head"), out.column("body"))]
        assert b"".join(h + b + b"\r\n\r\n" for h, b in parts) == content
        assert (b"abc\r\n" in [b for _, b in parts])


def test_lost_and_added_volumes(spark):
    out = shared_folder(spark)
    warc.write_archive(odd_pages(spark, 400), f"{out}/a", volume_bytes=1 << 13)
    spark.read.text(f"{out}/a", lineSep="\r\n\r\n").filter("volume % 2 = 0").coalesce(1).write.partitionBy(
        "volume").option("lineSep", "\r\n\r\n").option("compression", "gzip").text(f"{out}/b")
    found = warc.audited(spark, f"{out}/a", f"{out}/b")
    assert {r.status for r in found.filter("volume % 2 = 1").collect()} == {"missing"}
    turned = warc.audited(spark, f"{out}/b", f"{out}/a")
    assert {r.status for r in turned.filter("volume % 2 = 1").collect()} == {"extra"}


def test_no_pages(spark):
    out = shared_folder(spark)
    warc.write_archive(odd_pages(spark).limit(0), f"{out}/a")
    warc.copy_archive(spark, f"{out}/a", f"{out}/b")
    assert warc.audited(spark, f"{out}/a", f"{out}/b").collect() == []


def test_broken_headers_do_not_hide_what_follows():
    good = b"WARC/1.0\r\nX-Page-Id: 1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    spans = list(warc._cut(good + b"garbage\r\n\r\n" + good))
    assert [p for _, _, p in spans] == [1, None, 1]
    assert list(warc._cut(good[:-5])) == [(0, len(good) - 5, 1)]


def test_query(spark, data):
    rows = QUERIES["op9_warc_audit"](spark, data).collect()
    pages = table(spark, data, "pages")
    chosen = pages.filter("pmod(xxhash64(html), 100) = 0 AND html <> ''").select("page_id")
    assert sorted(r.page_id for r in rows) == sorted(r.page_id for r in pages.collect())
    assert {r.page_id for r in rows if r.status == "corrupt"} == {r[0] for r in chosen.collect()}
