"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.llm.common import in_arrow, landed, per_batch
from caselens.llm.components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
# Shingles whose bits are counted at once, and pairs verified at once, by one task.
SHINGLES_AT_ONCE, PAIRS_AT_ONCE = 1 << 15, 1 << 21
# A bucket with more pairs than this is not verified but indexed again by the bits left over.
PAIRS_PER_BUCKET = 1 << 16
_ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _spans(text: bytes, size: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The lowered words of a text with one space between, and where each shingle lies in them."""
    words = text.translate(_ASCII_LOWER).split()
    joined = b" ".join(words)
    if not words:
        return joined, []
    if len(words) <= size:
        return joined, [(0, len(joined))]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    return joined, list(zip(starts, ends[size - 1 :].tolist()))


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """64 bits of a UTF-8 text, as a signed number: those set in over half of the shingles' hashes;
    0 without words."""
    joined, spans = _spans(text, size)
    if not spans:
        return 0
    ones = 0
    for start in range(0, len(spans), SHINGLES_AT_ONCE):
        some = spans[start : start + SHINGLES_AT_ONCE]
        hashes = b"".join([xxhash.xxh64_digest(joined[a:b], SEED) for a, b in some])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(len(some), -1), axis=1)
        ones = ones + bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(spans))
    return int.from_bytes(packed.tobytes(), "big", signed=True)


def _fingerprints(size: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column("text").cast(pa.binary())
    prints = [fingerprint(text.as_py() or b"", size) for text in texts]
    return batch.drop_columns("text").append_column("print", pa.array(prints, pa.int64()))


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, mark, print)`` per row; a NULL or wordless text has print 0. ``mark`` is a hash of
    the text, which tells rows of one doc_id apart."""
    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"),
        text.alias("text"),
    )
    return narrow.transform(
        in_arrow, per_batch(partial(_fingerprints, size)), "doc_id long, mark long, print long"
    )


# --- the index -----------------------------------------------------------------------------------
#
# A fingerprint falls into two halves. Of two fingerprints within three bits one half differs in at
# most one bit, so a half and its one-bit flips, looked up among the exact halves, find every pair.
# Of a pair that differs in a half, the one with the 0 bit flips it, which halves the lookups.
# A bucket of too many pairs (many near copies of one text) is indexed again in the same way by the
# bits that its key does not hold: first 32 of them, then 16. A row keeps how many bits it may still
# differ; rows that never flipped (left = 3) are the table, all rows of a bucket look into it.


def _lookups(width: int) -> str:
    """SQL: array of (key, rest, left) of a row whose ``rest`` has two halves of ``width`` bits."""
    mask = (1 << width) - 1
    halves = (
        (0, f"shiftrightunsigned(rest, {width})", f"rest & {mask}L"),
        (1, f"rest & {mask}L", f"shiftrightunsigned(rest, {width})"),
    )
    arrays = []
    for place, value, other in halves:
        base = f"shiftleft(key, {width + 1}) | {place << width}L"
        arrays.append(
            f"""transform(
                filter(
                    array_prepend(transform(sequence(0, {width - 1}), i -> shiftleft(1L, i)), 0L),
                    bit -> bit = 0 OR (left >= 2 AND (left < {RADIUS} OR (({value}) & bit) = 0))
                ),
                bit -> struct(({base}) | (({value}) ^ bit) AS key, {other} AS rest,
                              CAST(IF(bit = 0, left, left - 1) AS TINYINT) AS left)
            )"""
        )
    return f"concat({', '.join(arrays)})"


def _indexed(rows: DataFrame, width: int) -> DataFrame:
    found = rows.select("print", F.explode(F.expr(_lookups(width))).alias("at"))
    return found.select("print", "at.*")


def _near_in(
    keys: np.ndarray, prints: np.ndarray, table: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs as places (table row, row). Rows are sorted by bucket, table rows first. Every
    table row of a bucket is compared with every row of it."""
    rows = len(keys)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, rows])
    first = np.repeat(starts, sizes)
    known = np.repeat(np.add.reduceat(table.astype(np.int64), starts), sizes)
    until = np.cumsum(known)
    start = 0
    while start < rows:
        done = until[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(until, done + PAIRS_AT_ONCE, "right")))
        some = known[start:end]
        right = np.repeat(np.arange(start, end), some)
        left = np.arange(len(right)) - np.repeat(until[start:end] - some - done, some) + first[right]
        differ = (prints[left] ^ prints[right]).view(np.uint64)
        near = np.bitwise_count(differ) <= RADIUS
        near &= left != right
        yield left[near], right[near]
        start = end


def _links_in(keys: np.ndarray, prints: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Label of each row: the first row of its bucket that links lead to. Rows are sorted by bucket,
    table rows first."""
    labels = np.arange(len(keys))
    left, right = (np.concatenate(x) for x in zip(*_near_in(keys, prints, table)))
    while len(left):
        low = np.minimum(labels[left], labels[right])
        moved = labels.copy()
        np.minimum.at(moved, left, low)
        np.minimum.at(moved, right, low)
        moved = moved[moved]
        if np.array_equal(moved, labels):
            break
        labels = moved
    return labels


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect the linked rows of each bucket; one bucket is held at a time at least."""
    held = None
    for batch in batches:
        some = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "print", "left")]
        held = some if held is None else [np.concatenate(x) for x in zip(held, some)]
        last = int(np.searchsorted(held[0], held[0][-1], "left")) if len(held[0]) else 0
        if last:
            yield from _edges([x[:last] for x in held])
            held = [x[last:] for x in held]
    if held is not None and len(held[0]):
        yield from _edges(held)


def _edges(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    keys, prints, left = columns
    labels = _links_in(keys, prints, left == RADIUS)
    tied = np.flatnonzero(labels != np.arange(len(labels)))
    if len(tied):
        yield pa.record_batch({"a": prints[tied], "b": prints[labels[tied]]})


def links(prints: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints ``print`` (distinct) within three bits.

    Not every link is an edge, but fingerprints are connected by edges just when they are by links.
    """
    whole = F.lit(RADIUS).cast("byte")
    rows = prints.select(
        "print", F.lit(0).cast("long").alias("key"), F.col("print").alias("rest"), whole.alias("left")
    )
    edges = None
    for width in (32, 16, 8):
        found = _indexed(rows, width)
        sizes = found.groupBy("key").agg(
            F.count_if(F.col("left") == RADIUS).alias("known"), F.count(F.lit(1)).alias("size")
        )
        crowded = (F.col("known") * F.col("size") > PAIRS_PER_BUCKET) & F.lit(width > 8)
        useful = landed(
            sizes.filter("known > 0 AND size > 1").select("key", crowded.alias("crowded"))
        )
        verified = (
            found.join(useful.filter("NOT crowded").select("key"), "key")
            .select("key", "print", "left")
            .repartition("key")
            .sortWithinPartitions("key", F.desc("left"))
            .transform(in_arrow, _links, "a long, b long")
        )
        edges = verified if edges is None else edges.union(verified)
        again = useful.filter("crowded").select("key")
        if again.isEmpty():
            break
        rows = landed(found.join(again, "key"))
    return edges


def _classes(marked: DataFrame, first: Column) -> DataFrame:
    """``(print, first)``: the smallest ``first`` of the rows whose prints links lead to."""
    nodes = landed(marked.groupBy("print").agg(F.min(first).alias("first")))
    tied = components(links(nodes.select("print")))
    rooted = nodes.join(tied, F.col("print") == F.col("node"), "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("print", "root").join(named, "root").select("print", "first")


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, print, component_id)`` for each row of ``docs (doc_id, text, ...)``.

    ``component_id`` is the smallest doc_id that links of at most three bits lead to. Equal
    fingerprints are one node, so copies are never paired. Rows with a NULL or wordless text have
    print 0 and are linked like any other. A repeated doc_id gives a row each time; a NULL doc_id
    gets the component of its fingerprint and never names one unless it is alone. No rows give none.
    Texts count whole, however long, a part of their shingles at a time; other columns are not
    looked at, whatever their names.
    """
    marked = landed(fingerprints(docs, size))
    classes = _classes(marked, F.col("doc_id"))
    return marked.join(classes, "print").select(
        "doc_id", "print", F.col("first").alias("component_id")
    )


def kept_rows(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest doc_id.

    A NULL doc_id comes last; of rows with one doc_id, the one with the smallest hash of its text
    stays, and equal rows stay together. All columns stay as they are; no rows give none. Only the
    identifiers of rows that go are joined to the whole rows, so few of them make a broadcast.
    """
    marked = landed(fingerprints(docs, size))
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    gone = landed(
        marked.join(_classes(marked, own), "print")
        .filter(own != F.col("first"))
        .select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"))
        .distinct()
    )
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    rows = docs.select(
        row, docs["doc_id"].cast("long").alias("own_id"),
        F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("own_mark"),
    )
    same = F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_mark") == F.col("gone_mark"))
    return rows.join(gone, same, "left_anti").select("row.*")
