"""Histogram sort into shards of near equal bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.llm.common import landed, text_or_empty

SHARDS = 16
# The first probes cut the key space into 2**FIRST_BITS ranges; a refined range is cut into 2**MORE.
FIRST_BITS, MORE = 16, 8
# A splitter is good once the bytes below it are within this share of a shard of the wanted number.
TOLERANCE = 0.0005
# What a sharded table has more than its input.
NEW = {"size": "long", "shard": "int", "slot": "long"}
# A range with more than this share of all bytes is refined, so that no task sorts much more; equal
# rows beyond it are numbered in parts.
RANGE_SHARE = 1 / 2048


def _keys(text: Column) -> dict[str, Column]:
    """Rows are sorted by a 63-bit hash of the text, then one of doc_id: equal texts lie together, and
    a group of them can still be cut anywhere."""
    return {
        "size": (F.octet_length(text) + 1).cast("long"),
        "h": F.shiftrightunsigned(F.xxhash64(text), 1),
        "g": F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string")), 1),
    }


def _histogram(rows: DataFrame) -> dict[str, np.ndarray]:
    """Exact bytes, rows and key bounds of each range; one bounded row per range reaches the driver."""
    found = (
        rows.groupBy("at")
        .agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
            F.min("h").alias("h0"), F.max("h").alias("h1"),
            F.min("g").alias("g0"), F.max("g").alias("g1"),
        )
        .toArrow()
        .sort_by("at")
    )
    return {c: found.column(c).to_numpy().astype(np.int64) for c in found.column_names}


def _wanted(total: int, shards: int) -> np.ndarray:
    return np.array([total * k // shards for k in range(1, shards)], np.int64)


def _to_refine(hist: dict[str, np.ndarray], shards: int) -> np.ndarray:
    """Which ranges are too heavy, or hold a splitter that neither of their ends is close to."""
    ends = np.cumsum(hist["bytes"])
    starts, total = ends - hist["bytes"], int(ends[-1])
    heavy = hist["bytes"] > max(1, total * RANGE_SHARE)
    allowed = total / shards * TOLERANCE
    wanted = _wanted(total, shards)
    holds = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
    far = np.minimum(wanted - starts[holds], ends[holds] - wanted) > allowed
    chosen = heavy.copy()
    chosen[holds[far]] = True
    return np.flatnonzero(chosen & ~_single(hist) & (hist["rows"] > 1))


def _probes(hist: dict[str, np.ndarray], chosen: np.ndarray) -> list[tuple]:
    """For each refined range its index, whether it is cut by g, its lowest key, and the shift to 2**MORE parts."""
    out = []
    for i in chosen.tolist():
        by_g = bool(hist["h0"][i] == hist["h1"][i])
        low, high = (hist["g0"][i], hist["g1"][i]) if by_g else (hist["h0"][i], hist["h1"][i])
        shift = max(0, (int(high) - int(low)).bit_length() - MORE)
        out.append((i, by_g, int(low), shift))
    return out


def _refined(rows: DataFrame, hist: dict[str, np.ndarray], probes: list[tuple]) -> DataFrame:
    """Ranges are numbered anew, each with room for 2**MORE parts; only the probed ones use it.

    The table has one row per range, so it is broadcast.
    """
    ranges = len(hist["at"])
    by_g, low, shift = np.zeros(ranges, bool), np.zeros(ranges, np.int64), np.zeros(ranges, np.int32)
    probed = np.zeros(ranges, bool)
    for i, *probe in probes:
        probed[i], (by_g[i], low[i], shift[i]) = True, probe
    base = np.arange(ranges, dtype=np.int64) << MORE
    table = rows.sparkSession.createDataFrame(
        list(zip(*(c.tolist() for c in (hist["at"], base, probed, by_g, low, shift)))),
        "at long, base long, probed boolean, by_g boolean, low long, shift int",
    )
    part = F.expr("IF(probed, shiftright(IF(by_g, g, h) - low, shift), 0L)")
    return rows.join(F.broadcast(table), "at").select(
        *(c for c in rows.columns if c != "at"), (F.col("base") + part).alias("at")
    )


def _single(hist: dict[str, np.ndarray]) -> np.ndarray:
    return (hist["h0"] == hist["h1"]) & (hist["g0"] == hist["g1"])


def _placement(hist: dict[str, np.ndarray], shards: int) -> list[tuple]:
    """Each range's shard, the slot of its first row, the number of parts in which its rows are
    numbered, and the places in it (from 0) where further shards start."""
    ends = np.cumsum(hist["bytes"])
    wanted = _wanted(int(ends[-1]), shards)
    holds = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
    size, count = hist["bytes"][holds], hist["rows"][holds]
    into = wanted - (ends[holds] - size)
    # A splitter goes to the closest boundary between ranges, or between two of many equal rows.
    at_an_end = np.where(into <= size - into, 0, count)
    among_equals = np.rint(into / (size / count)).astype(np.int64)
    below = np.cumsum(hist["rows"]) - hist["rows"]
    cuts = np.sort(below[holds] + np.where(_single(hist)[holds], among_equals, at_an_end))
    shard = np.searchsorted(cuts, below, side="right")
    inside = np.searchsorted(cuts, below + hist["rows"], side="left")
    starts = np.concatenate([[0], cuts])
    share = np.ceil(hist["bytes"] / max(1, int(ends[-1]) * RANGE_SHARE))
    crowded = _single(hist) & (hist["rows"] > 1) & (share > 1)
    parts = np.where(crowded, share, 1).astype(np.int64)
    further = [
        (cuts[a:b] - first).tolist() for a, b, first in zip(shard, np.maximum(shard, inside), below)
    ]
    columns = (hist["at"], shard, below - starts[shard], parts)
    return list(zip(*(c.tolist() for c in columns), further))


def _numbered_in_parts(equals: DataFrame) -> DataFrame:
    """``n``, the place from 0 of each row among its equals, which no key tells apart.

    The rows are dealt at random over the parts of their range. They are written with their part, so
    that it stays the same when a task runs again; counts of the parts say where each one starts.
    """
    dealt = landed(equals.withColumn("part", F.floor(F.rand() * F.col("parts"))))
    counts = dealt.groupBy("at", "part").agg(F.count(F.lit(1)).alias("in_part"))
    upto = F.sum("in_part").over(Window.partitionBy("at").orderBy("part"))
    starts = counts.select("at", "part", (upto - F.col("in_part")).alias("start"))
    place = F.row_number().over(Window.partitionBy("at", "part").orderBy("h"))
    return (
        dealt.withColumn("place", place).join(starts, ["at", "part"])
        .withColumn("n", F.col("start") + F.col("place") - 1)
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text plus 1), ``shard`` and ``slot``.

    Shards hold nearly the same number of bytes: each splitter is within 0.05 % of a shard of its
    place, or a row. Rows are ordered by a hash of the text and one of doc_id; slots count from 0 in
    that order without gaps. Equal texts share a shard unless a splitter falls into their group.

    Only key hashes and sizes are read to find the splitters; each round counts exact bytes between
    probes, and refines the ranges that hold a splitter or too many bytes, until none is left. The
    rows themselves are exchanged once, by range, so that a shard is sorted by many tasks. Rows with
    equal doc_id and text are told apart by no key: a splitter cuts between any two of them, and if
    they are many they are written once and numbered in parts by many tasks. A NULL text has size 1
    and sorts as the empty one, a NULL doc_id is a value. Very long texts are rows like others. Input
    columns called ``size``, ``shard`` or ``slot`` are replaced. No rows give none.
    """
    spark = docs.sparkSession
    row = F.struct(*(docs[c] for c in docs.columns if c not in NEW))
    keyed = docs.select(row.alias("row"), text_or_empty().alias("t"), "doc_id").select(
        "row", *(c.alias(n) for n, c in _keys(F.col("t")).items())
    )
    start = F.shiftright("h", 63 - FIRST_BITS)
    rows = landed(keyed.select("size", "h", "g")).withColumn("at", start)
    placed = keyed.withColumn("at", start)
    hist = _histogram(rows)
    if not len(hist["at"]):
        return docs.limit(0).select(row.alias("row")).select(
            "row.*", *(F.lit(0).cast(t).alias(n) for n, t in NEW.items())
        )
    while len(chosen := _to_refine(hist, shards)):
        probes = _probes(hist, chosen)
        rows, placed = _refined(rows, hist, probes), _refined(placed, hist, probes)
        hist = _histogram(rows)
    places = _placement(hist, shards)
    # One row per range, at most 2**FIRST_BITS and what was refined: broadcast.
    table = spark.createDataFrame(
        places, "at long, shard int, base long, parts long, cuts array<long>"
    )
    found = placed.join(F.broadcast(table), "at")
    order = F.row_number().over(Window.partitionBy("at").orderBy("h", "g", "row.doc_id"))
    numbered = found.filter("parts = 1").withColumn("n", order - 1)
    if any(parts > 1 for _, _, _, parts, _ in places):
        equals = _numbered_in_parts(found.filter("parts > 1"))
        numbered = numbered.unionByName(equals.select(numbered.columns))
    passed = F.expr("filter(cuts, cut -> cut <= n)")
    first = F.when(F.size(passed) == 0, -F.col("base")).otherwise(F.array_max(passed))
    return numbered.select(
        "row.*", "size", (F.col("shard") + F.size(passed)).cast("int").alias("shard"),
        (F.col("n") - first).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """One folder per shard, ``shard=0`` to the last, with its rows and their slots."""
    sharded(docs, shards).write.partitionBy("shard").parquet(path)
