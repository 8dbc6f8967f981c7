"""Shards: whole, near equal, gapless, and groups cut only where they must be."""

import zlib
from collections import defaultdict

import pytest

from caselens.llm import sharding
from caselens.llm.common import table
from caselens.llm.queries import QUERIES
from samples import none, odd, prose


def check(rows, shards, largest):
    """``rows``: (shard, slot, size)."""
    total = sum(size for _, _, size in rows)
    slots, sizes = defaultdict(list), defaultdict(int)
    for shard, slot, size in rows:
        assert 0 <= shard < shards
        slots[shard].append(slot)
        sizes[shard] += size
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    near = total / shards
    for shard in range(shards):
        assert abs(sizes[shard] - near) <= 2 * max(largest, near * sharding.TOLERANCE) + 1


def test_odd_rows(spark):
    docs = odd(spark)
    out = sharding.sharded(docs, 3)
    assert set(out.columns) == {*docs.columns, "size", "shard", "slot"}
    rows = out.collect()
    before, after = docs.collect(), [(r.doc_id, r.text) for r in rows]
    assert sorted(map(str, after)) == sorted(str((r.doc_id, r.text)) for r in before)
    assert all(r["size"] == len((r.text or "").encode()) + 1 for r in rows)
    check([(r.shard, r.slot, r["size"]) for r in rows], 3, max(r["size"] for r in rows))
    assert sharding.sharded(none(spark)).collect() == []


@pytest.mark.parametrize("first_bits", [16, 4])
def test_a_hot_group_is_cut_and_others_are_not(spark, monkeypatch, first_bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", first_bits)
    rows = [(i, prose(1, 20)) for i in range(4000)]
    rows += [(10_000 + i, prose(i // 3, 10 + i % 40)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.sharded(docs).collect()
    check([(r.shard, r.slot, r["size"]) for r in found], 16, max(r["size"] for r in found))
    of = defaultdict(set)
    for r in found:
        of[r.text].add(r.shard)
    assert len(of[rows[0][1]]) > 4
    assert sum(len(s) > 1 for s in of.values()) <= 16


def test_equal_rows_get_different_slots(spark):
    docs = spark.createDataFrame([(1, "same")] * 500 + [(2, "x")], "doc_id long, text string")
    rows = sharding.sharded(docs, 4).collect()
    assert len({(r.shard, r.slot) for r in rows}) == 501


@pytest.mark.parametrize("first_bits", [16, 3])
def test_equal_rows_are_cut_by_position(spark, monkeypatch, first_bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", first_bits)
    rows = [(7, "one text of many")] * 3000 + [(i, prose(i, 1 + i % 3)) for i in range(1000)]
    found = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    kept = found.collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(rows)
    largest = max(r["size"] for r in kept)
    bytes_of, slots = defaultdict(int), defaultdict(list)
    for r in kept:
        bytes_of[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert sorted(bytes_of) == list(range(16))
    near = sum(bytes_of.values()) / 16
    assert all(abs(size - near) <= largest + near * sharding.TOLERANCE for size in bytes_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # The same rows in the same places when the result is read again.
    assert sorted(map(str, found.collect())) == sorted(map(str, kept))


def test_keys_that_differ_in_their_last_bits_are_still_split(spark, monkeypatch):
    """More rounds than bits of a range number would allow if it only grew."""
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "MORE", 1)
    rows = [(i, "same") for i in range(300)] + [(1000 + i, prose(i, 2)) for i in range(50)]
    found = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    check([(r.shard, r.slot, r["size"]) for r in found], 5, max(r["size"] for r in found))


def test_written_shards(spark, data, tmp_path):
    docs = table(spark, data, "documents")
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 16


def test_query(spark, data):
    texts = {r.doc_id: r.text for r in table(spark, data, "documents").collect()}
    rows = QUERIES["op4_sharding"](spark, data).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        text = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        assert r.law == "bytes" and r.grown_shard is None
    check([(r.shard, r.slot, r["size"]) for r in rows], 16, max(r["size"] for r in rows))
