"""Exact de-duplication: state, locators, byte checks and resumption."""

import hashlib
import os
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import functions as F

from caselens.llm import exactdedup
from caselens.llm.queries import ORACLE, QUERIES
from caselens.session import shared_folder
from oracle_compare import differences, oracle_connection
from samples import GAP, none, odd, prose


def body(text):
    return GAP.sub(" ", text or "")


def wanted(rows):
    """``(doc_id, keep_id, group_size, sha256)`` by plain grouping."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[body(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        same = groups[body(text)]
        keep = min((i for i in same if i is not None), default=None)
        out.append((doc_id, keep, len(same), hashlib.sha256(body(text).encode()).hexdigest()))
    return sorted(map(str, out))


def written(spark, frame, files=1):
    path = shared_folder(spark)
    frame.repartition(files).write.parquet(path)
    return path


def test_odd_rows(spark):
    docs = odd(spark)
    found = exactdedup.exact_groups(spark, written(spark, docs, 3)).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found]
    assert sorted(map(str, got)) == wanted(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found})
    assert all(r.doc_id == r.keep_id for r in kept)
    assert exactdedup.exact_groups(spark, written(spark, none(spark))).collect() == []


def test_kept_rows_keep_columns(spark):
    docs = odd(spark)
    kept = exactdedup.kept_rows(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({body(r.text) for r in docs.collect()})
    assert len({body(r.text) for r in rows}) == len(rows)
    assert exactdedup.kept_rows(none(spark)).collect() == []


def test_hits_are_checked_byte_by_byte(spark, monkeypatch):
    """A digest of three bits stands for many texts; groups are still those of equal texts."""
    monkeypatch.setattr(exactdedup, "ROWS_PER_SALT", 16)
    rows = [(i, prose(i % 60, 30) if i % 3 else "hot \t text") for i in range(600)]
    path = written(spark, spark.createDataFrame(rows, "doc_id long, text string"), 5)

    def weak(text):
        return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(8))

    found = exactdedup.exact_groups(spark, path, weak).collect()
    got = sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in found)
    plain = defaultdict(list)
    for i, t in rows:
        plain[body(t)].append(i)
    assert got == sorted(str((i, min(plain[body(t)]), len(plain[body(t)]))) for i, t in rows)
    assert sum(r.kept for r in found) == len(plain)


def test_state_survives_and_takes_only_new_files(spark):
    path, checkpoint = shared_folder(spark), shared_folder(spark)
    schema = "doc_id long, text string"
    first = spark.createDataFrame([(5, "a  b"), (6, "c"), (7, "a b")], schema)
    first.repartition(3).write.parquet(path)
    parsed = first.schema
    exactdedup.remember(spark, path, parsed, checkpoint, files_at_once=1)
    spark.createDataFrame([(1, "a\nb"), (9, "d")], schema).write.mode("append").parquet(path)
    for _ in range(2):
        exactdedup.remember(spark, path, parsed, checkpoint, files_at_once=1)
        state = exactdedup.remembered(spark, checkpoint).collect()
        assert sorted((r["first"].doc_id, r["size"]) for r in state) == [(1, 3), (6, 1), (9, 1)]


def test_a_late_file_with_an_old_date_is_read(spark):
    path, checkpoint = shared_folder(spark), shared_folder(spark)
    first = spark.createDataFrame([(5, "a"), (6, "b")], "doc_id long, text string")
    first.coalesce(1).write.parquet(path)
    exactdedup.remember(spark, path, first.schema, checkpoint)
    before = set(Path(path).glob("*.parquet"))
    first.limit(1).selectExpr("doc_id - 4 AS doc_id", "text").write.mode("append").parquet(path)
    month_ago = time.time() - 31 * 86400
    for file in set(Path(path).glob("*.parquet")) - before:
        os.utime(file, (month_ago, month_ago))
    exactdedup.remember(spark, path, first.schema, checkpoint)
    state = exactdedup.remembered(spark, checkpoint).collect()
    assert sorted((r["first"].doc_id, r["size"]) for r in state) == [(1, 2), (6, 1)]


def test_query_matches_sql(spark, data):
    name = "op7_exact_dedup"
    assert differences(QUERIES[name](spark, data), oracle_connection(data), ORACLE[name]) == ""
