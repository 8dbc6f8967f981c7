"""Best-fit packing of token sequences, in bulk-synchronous sweeps over sorted lengths and gaps."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.llm.common import in_arrow, landed, text_or_empty
from caselens.llm.tokens import id_batches

CAPACITY = 1024
END = 2
_ROWS_OUT = 2048


def _pieces(
    path: str, capacity: int, end: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    names = ("doc_id", "piece", "start", "length", "ids")
    rows: list[tuple] = []
    for doc_id, ids in id_batches(path, batches):
        whole = ids.tobytes() + end.to_bytes(4, "little")
        total = len(ids) + 1
        first = total % capacity or capacity
        begin, stop, piece = 0, first, 0
        while begin < total:
            rows.append((doc_id, piece, begin, stop - begin, whole[4 * begin : 4 * stop]))
            begin, stop, piece = stop, stop + capacity, piece + 1
            if len(rows) == _ROWS_OUT:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), _SCHEMA)
                rows = []
    if rows:
        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows))), _SCHEMA)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids", pa.binary())]
)


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: each text's ids and ``end``, cut to the capacity.

    ``ids`` holds little-endian 32-bit numbers. Only longer sequences are cut; all pieces but the
    first are full. A NULL text counts as empty and gives ``end`` alone.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return narrow.transform(
        in_arrow,
        partial(_pieces, path, capacity, end),
        "doc_id long, piece int, start long, length long, ids binary",
    )


class _Gaps:
    """Open sequences by what they have left; equal ones are kept as runs (first number, how many)."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if count and gap:
            if gap not in self.runs:
                insort(self.sizes, gap)
                self.runs[gap] = []
            self.runs[gap].append((first, count))

    def successor(self, length: int) -> tuple[int, int, int] | None:
        """Takes out a run of the smallest gap that the length fits."""
        at = bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, count = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap]
            self.sizes.pop(at)
        return gap, first, count


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Best fit, longest first, over runs of pieces of one length and runs of gaps of one size.

    ``(length, from_rank, to_rank, first sequence, pieces per sequence, offset)``: the pieces of a
    length with these ranks go in order to these sequences. Each step matches a run with its
    successor among the gaps; where more pieces than gaps meet, the lower ranks win and the others
    look for the next gap; the gaps shrink and the sweep goes on. What fits nowhere opens sequences.
    """
    gaps, opened, plan = _Gaps(), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            found = gaps.successor(length)
            if found is None:
                each = capacity // length
                found = (capacity, opened, -(-left // each))
                opened += found[2]
            gap, first, room = found
            each = gap // length
            taken = min(left, room * each)
            plan.append((length, rank, rank + taken - 1, first, each, capacity - gap))
            full, rest = divmod(taken, each)
            gaps.add(gap - each * length, first, full)
            if rest:
                gaps.add(gap - rest * length, first + full, 1)
            used = full + bool(rest)
            gaps.add(gap, first + used, room - used)
            rank, left = rank + taken, left - taken
    return plan


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces (doc_id, piece, length, ...)`` with ``sequence_id`` and ``offset``.

    Pieces are range-sorted by length, so that one of equal length spreads over tasks however many
    there are. Lengths and gaps are at most ``capacity`` different numbers and those of one size are
    interchangeable, so a sweep matches runs instead of single rows; it sees one count per length,
    never rows. Each piece then finds its run by its rank. Lengths must be from 1 to the capacity.
    Repeated rows are packed each; no rows give none.
    """
    spark = pieces.sparkSession
    order = [F.desc("length"), "doc_id", "piece"]
    spread = (
        landed(pieces).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )
    rows = landed(spread)
    # One row per task and length, at most tasks + capacity rows as the tasks are ranges.
    found = rows.groupBy("_part", "length").count().toArrow().to_pylist()
    counts: dict[int, int] = {}
    for row in found:
        counts[row["length"]] = counts.get(row["length"], 0) + row["count"]
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    bases, seen = [], dict.fromkeys(counts, 0)
    first_of: dict[int, int] = {}
    for row in sorted(found, key=lambda r: (r["_part"], -r["length"])):
        part, length, count = row["_part"], row["length"], row["count"]
        bases.append((part, length, seen[length] - first_of.get(part, 0)))
        first_of[part] = first_of.get(part, 0) + count
        seen[length] += count
    # Both tables are bounded by tasks and capacity, as said above.
    base = F.broadcast(spark.createDataFrame(bases, "_part int, length long, _base long"))
    plan = F.broadcast(
        spark.createDataFrame(
            sweep(counts, capacity),
            "length long, _from long, _to long, _first long, _each long, _offset long",
        )
    )
    ranked = rows.join(base, ["_part", "length"]).withColumn("_rank", F.col("_at") + F.col("_base"))
    run = (ranked["length"] == plan["length"]) & ranked["_rank"].between(plan["_from"], plan["_to"])
    place = F.col("_rank") - F.col("_from")
    return ranked.join(plan, run).select(
        *(ranked[c] for c in pieces.columns),
        (F.col("_first") + F.expr("(_rank - _from) DIV _each")).alias("sequence_id"),
        (F.col("_offset") + place % F.col("_each") * ranked["length"]).alias("offset"),
    )
