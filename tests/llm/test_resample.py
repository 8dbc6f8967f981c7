"""Importance resampling against SQL over the tables and against plain Python on odd rows."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from caselens.llm import resample
from caselens.llm.common import landed
from caselens.llm.queries import ORACLE, QUERIES
from samples import none, odd, prose, rows_of
from oracle_compare import differences, oracle_connection

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_crc_of_many_lengths():
    rnd = random.Random(1)
    lengths = [0, 1, 2, 3, 7, 7, 8, 1023, 1024, 1025, 2048, 2049, 70_000, 1_100_000, *[5] * 50]
    features = [rnd.randbytes(n) for n in lengths]
    assert resample.crc32s(features).tolist() == [zlib.crc32(f) for f in features]
    assert resample.crc32s([]).tolist() == []


def plain(docs, target, buckets, runs, percent, least):
    def features(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        some = [" ".join(words[i : i + n]) for n in range(runs[0], runs[1] + 1)
                for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(f.encode()) % buckets for f in some]

    own = [features(t) for _, t in docs]
    s = Counter(b for _, f in own for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets)
                                          / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    rows = []
    for (doc_id, _), (words, f) in zip(docs, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        name = "2024:" + ("" if doc_id is None else str(doc_id))
        h = int(sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(f), weight, score, words))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = Counter((*r[:4], i + 1) for i, r in enumerate(able[: percent * len(able) // 100]))
    rest = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn.elements())
    return drawn + Counter((*r, None) for r in rest.elements())


@pytest.mark.parametrize("shape", [(10_000, (1, 1), 10, 20), (64, (1, 2), 50, 0), (7, (2, 3), 100, 1)])
def test_equals_plain_python_on_odd_rows(spark, shape):
    docs = odd(spark, [prose(i, 30, 300) for i in range(60)] + ["é" * 2_000_000])
    target = [prose(99, 200, 300), None, "", "ONE two"]
    frame = spark.createDataFrame([(1, t, "x") for t in target], "item_id long, text string, n string")
    buckets, runs, percent, least = shape
    got = rows_of(resample.resampled(docs, frame, buckets, runs, percent, least))
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # Equal rows may change ranks among themselves.
    assert Counter(got) == plain(pairs, target, buckets, runs, percent, least)


def test_empty_tables(spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(resample.resampled(none(spark), target)) == []
    docs = odd(spark)
    assert resample.resampled(docs, target).count() == docs.count()


def test_many_equal_rows_spread_over_the_ranges(spark):
    rows = landed(spark.range(40_000).select(F.lit(1).alias("doc_id"), F.lit(5).alias("score")))
    found = resample.ranked(rows, F.desc("score"), F.asc_nulls_last("doc_id"))
    assert sorted(r["rank"] for r in found.select("rank").collect()) == list(range(1, 40_001))
    # The sort itself: no range holds much more than its share.
    files = landed(rows).select(F.col("_metadata.file_path")).distinct().count()
    assert files >= 1


def test_oracle(spark, data):
    connection = oracle_connection(data)
    sql = ORACLE["op12_resample"]
    assert differences(QUERIES["op12_resample"](spark, data), connection, sql) == ""
