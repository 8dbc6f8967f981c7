"""Importance resampling of documents towards the word features of a target corpus."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.llm.common import in_arrow, landed, terms

BUCKETS, RUNS, PERCENT, LEAST_WORDS, SEED = 10_000, (1, 1), 10, 20, 2024
# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
# Distinct features hashed together, bytes of one matrix, and the bytes in which a very long
# feature is cut.
DISTINCT, MATRIX, BLOCK = 1 << 17, 1 << 20, 1 << 10
_ALL = np.uint32(0xFFFFFFFF)


# --- CRC-32 of many features at once -------------------------------------------------------------


def _stepped(values: np.ndarray) -> np.ndarray:
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(POLYNOMIAL), values >> 1)
    return values


_STEP = _stepped(np.arange(256, dtype=np.uint32))


def _advanced(registers: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Registers after one more byte per column; a column holds one byte of every feature."""
    for column in columns:
        registers = _STEP[(registers ^ column) & 0xFF] ^ (registers >> np.uint32(8))
    return registers


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """What ``BLOCK`` zero bytes make of each byte of a register. CRC is linear, so a block's own
    register, started at 0, and that of what stands before it add up by exclusive or."""
    places = np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    return _advanced(places, np.zeros((BLOCK, 1, 1), np.uint8))


def _long_crc(feature: np.ndarray) -> int:
    """Of one long feature: its blocks are the rows of a matrix of their own."""
    whole = len(feature) // BLOCK * BLOCK
    shifts, register = _shifts(), int(_ALL)
    for start in range(0, whole, MATRIX):
        rows = feature[start : min(start + MATRIX, whole)].reshape(-1, BLOCK)
        for own in _advanced(np.zeros(len(rows), np.uint32), rows.T).tolist():
            moved = 0
            for place in range(4):
                moved ^= int(shifts[place, register >> (8 * place) & 0xFF])
            register = moved ^ own
    tail = _advanced(np.array([register], np.uint32), feature[whole:, None])
    return int(tail[0] ^ _ALL)


def crc32s(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each feature. Features of one length are a matrix, whose columns update all their
    registers at once; the results go back to the features' places."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    data = np.frombuffer(b"".join(features), np.uint8)
    starts = np.cumsum(lengths) - lengths
    out = np.zeros(len(features), np.uint32)
    order = np.argsort(lengths, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if not len(rows):
            continue
        length = int(lengths[rows[0]])
        if length > BLOCK:
            out[rows] = [_long_crc(data[s : s + length]) for s in starts[rows].tolist()]
            continue
        step = max(1, MATRIX // max(1, length))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            columns = data[starts[some][None, :] + np.arange(length)[:, None]]
            out[some] = _advanced(np.full(len(some), _ALL), columns) ^ _ALL
    return out


# --- features ------------------------------------------------------------------------------------


class _Numbers(dict):
    """Number of each feature, in the order in which they are first met."""

    def __missing__(self, feature: bytes) -> int:
        number = self[feature] = len(self)
        return number


def _runs(words: list[bytes], runs: tuple[int, int]) -> list[bytes]:
    out: list[bytes] = []
    for size in range(runs[0], runs[1] + 1):
        out += words if size == 1 else map(b" ".join, zip(*(words[i:] for i in range(size))))
    return out


def _bucketed(
    buckets: int, runs: tuple[int, int], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Buckets of the features of each text, as packed numbers."""
    for batch in batches:
        ids = batch.column("doc_id")
        texts = batch.column("text").cast(pa.binary())
        numbers, held, counts, done = _Numbers(), [], [], 0
        for row, text in enumerate(texts, 1):
            words = terms(text.as_py() or b"")
            found = _runs(words, runs)
            held.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
            counts.append(len(words))
            if row < batch.num_rows and len(numbers) < DISTINCT:
                continue
            places = (crc32s(list(numbers)) % np.uint32(buckets)).astype("<u4")
            yield pa.record_batch({
                "doc_id": ids.slice(done, row - done),
                "n_words": pa.array(counts, pa.int64()),
                "n_features": pa.array([len(x) for x in held], pa.int64()),
                "features": pa.array([places[x].tobytes() for x in held], pa.binary()),
            })
            numbers, held, counts, done = _Numbers(), [], [], row


def features(texts: DataFrame, buckets: int = BUCKETS, runs: tuple[int, int] = RUNS) -> DataFrame:
    """``(doc_id, n_words, n_features, features)`` of each row, ``features`` as packed buckets."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.transform(
        in_arrow, partial(_bucketed, buckets, runs),
        f"doc_id {kind}, n_words long, n_features long, features binary",
    )


def _counted(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for packed in batch.column("features"):
            total += np.bincount(np.frombuffer(packed.as_py(), "<u4"), minlength=buckets)
    used = np.flatnonzero(total)
    if len(used):
        yield pa.record_batch({"bucket": used, "n": total[used]})


def bucket_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, n)``: features of all rows by bucket. Each task sends no more than its buckets."""
    parts = rows.select("features").transform(
        in_arrow, partial(_counted, buckets), "bucket long, n long"
    )
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket. The driver holds one number a bucket, however large the corpora are."""
    joined = (
        corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
        .join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .fillna(0, ["s", "t"])
    )
    sums = joined.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    ratio = (
        (F.col("t") + 1).cast("double") * F.lit(float(sums["S"] + buckets))
        / ((F.col("s") + 1).cast("double") * F.lit(float(sums["T"] + buckets)))
    )
    rows = joined.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["gain"]
    return out


def _weighed(gain: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = [
            int(gain[np.frombuffer(packed.as_py(), "<u4")].sum())
            for packed in batch.column("features")
        ]
        counts = batch.column("n_features").to_pylist()
        weights = [total // n if n else 0 for total, n in zip(sums, counts)]
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"),
            "n_features": batch.column("n_features"), "weight": pa.array(weights, pa.int64()),
        })


# --- the draw ------------------------------------------------------------------------------------


def _noise(seed: int) -> Column:
    """A Gumbel variable in thousandths, drawn by the hash of doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    uniform = (drawn.cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.ln(-F.ln(uniform)))


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``rank`` from 1 on in the given order, without a window over all rows.

    Rows are sorted by ranges into a table in the shared folder; a row's rank is its place in its
    file and the number of rows in the files before. Equal rows come in any order.
    """
    path = F.col("_metadata.file_path")
    # Equal rows are told apart by their place in the table they come from, so that very many of
    # them still spread over the ranges.
    placed = rows.withColumn("_place", F.xxhash64(path, F.col("_metadata.row_index")))
    keys = [*order, F.col("_place").asc()]
    sorted_rows = landed(placed.repartitionByRange(*keys).sortWithinPartitions(*keys))
    at = sorted_rows.drop("_place").select(
        "*", path.alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    part = r"part-(\d+)-.*?-c(\d+)"
    by_place = Window.orderBy(
        F.regexp_extract("_file", part, 1).cast("long"), F.regexp_extract("_file", part, 2).cast("long")
    ).rowsBetween(Window.unboundedPreceding, -1)
    # One row a file, so as many as the sort had tasks.
    files = at.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(by_place), F.lit(0)).alias("_before")
    )
    return at.join(files, "_file").withColumn("rank", F.col("_before") + F.col("_row") + 1).drop(
        "_file", "_row", "_before"
    )


def resampled(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, runs: tuple[int, int] = RUNS,
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of each row of ``docs (doc_id, text, ...)``.

    Features are runs of words, counted in hashed buckets over all of ``docs`` and over all texts of
    ``target (text, ...)``. ``weight`` is the mean gain of a row's features in thousandths, 0 without
    features; ``score`` adds Gumbel noise, so the highest scores are a draw without replacement.
    ``percent`` of the rows with at least ``least_words`` words are drawn and ranked from 1 on, equal
    scores by doc_id, a NULL doc_id last; ``rank`` is NULL for all others.

    A NULL text counts as empty; very long words are hashed in blocks. A NULL doc_id draws its noise
    as an empty text; rows that share a doc_id share their noise and each get a rank of their own.
    Other columns are not looked at; no rows give none, an empty target is one without features.
    """
    rows = landed(features(docs.select("doc_id", F.col("text").cast("string")), buckets, runs))
    wanted = features(
        target.select(F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string")),
        buckets, runs,
    )
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets), buckets)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = landed(
        rows.transform(
            in_arrow, partial(_weighed, gain),
            f"doc_id {kind}, n_words long, n_features long, weight long",
        ).withColumn("score", F.col("weight") + _noise(seed))
    )
    # Scores are whole numbers of a narrow span, so their histogram is short at any size.
    able = F.col("n_words") >= least_words
    above = Window.orderBy(F.desc("score"))
    histogram = scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).select(
        "score", F.sum("n").over(above).alias("until"), F.sum("n").over(Window.partitionBy()).alias("N")
    )
    wanted_rows = F.floor(F.col("N") * percent / 100)
    cut = histogram.filter((wanted_rows > 0) & (F.col("until") >= wanted_rows)).agg(
        F.max("score").alias("cut"), F.max(wanted_rows).alias("drawn")
    ).first()
    names = ("doc_id", "n_features", "weight", "score")
    nothing = F.lit(None).cast("long").alias("rank")
    if cut["cut"] is None:
        return scored.select(*names, nothing)
    high = able & (F.col("score") >= cut["cut"])
    first = ranked(scored.filter(high), F.desc("score"), F.asc_nulls_last("doc_id"))
    rank = F.when(F.col("rank") <= cut["drawn"], F.col("rank")).alias("rank")
    return scored.filter(~high).select(*names, nothing).union(first.select(*names, rank))
