"""Ranked lexical search: best-first over document intervals, bounded by range maxima."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselens.llm.common import in_arrow, landed, terms

TOP = 10
# Fixed values of the score: percentages of the length norm, and the scale of an impact.
LENGTH_PERCENT, IMPACT = 75, 1_000_000_000
# Bits of the filter of the queries' terms, postings of one block of documents, intervals split at
# once, and terms times documents searched at once.
FILTER_BITS, BLOCK, AT_ONCE, AREA = 1 << 20, 1 << 20, 512, 1 << 22
# Terms of the queries that tasks get at once; more queries than that take another pass.
QUERY_TERMS = 200_000
_LAST = np.iinfo(np.int64).max


# --- postings ------------------------------------------------------------------------------------


def _counted(wanted: bytes | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each text and how often they occur, and the number of all its terms."""
    for batch in batches:
        sizes, found, times, lengths = [], [], [], []
        for text in batch.column("text").cast(pa.binary()):
            counts = Counter(terms(text.as_py() or b""))
            sizes.append(sum(counts.values()))
            some = [
                t for t in counts if wanted is None or wanted[(h := _place(t)) >> 3] >> (h & 7) & 1
            ]
            found += some
            times += [counts[t] for t in some]
            lengths.append(len(some))
        offsets = pa.array(np.r_[0, np.cumsum(lengths)], pa.int32())
        yield pa.record_batch({
            "id": batch.column("id"),
            "n": pa.array(sizes, pa.int64()),
            "terms": pa.ListArray.from_arrays(offsets, pa.array(found, pa.binary())),
            "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
        })


def _place(term: bytes) -> int:
    return crc32(term) % FILTER_BITS


def postings(texts: DataFrame, wanted: bytes | None = None) -> DataFrame:
    """``(id, n, terms, times)`` of each row of ``texts (id, text)``; ``n`` counts all its terms.

    ``wanted`` leaves out terms whose bit is not set; it always has the same size.
    """
    kind = texts.schema["id"].dataType.simpleString()
    return texts.transform(
        in_arrow, partial(_counted, wanted),
        f"id {kind}, n long, terms array<binary>, times array<long>",
    )


def _filter_of(queries: DataFrame) -> bytes:
    place = F.pmod(F.crc32("term"), F.lit(FILTER_BITS))
    bits = np.zeros(FILTER_BITS, np.uint8)
    for row in queries.select(place.alias("place")).distinct().collect():
        bits[row["place"]] = 1
    return np.packbits(bits, bitorder="little").tobytes()


# --- search of one block -------------------------------------------------------------------------


@dataclass
class Query:
    """``terms`` are numbers in the pass's vocabulary; the best documents found so far are sorted."""

    number: int
    terms: np.ndarray
    weights: np.ndarray
    scores: np.ndarray
    ids: np.ndarray
    known: np.ndarray

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray, top: int) -> None:
        scores, ids, known = (
            np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.known, known))
        )
        first = np.lexsort((ids, ~known, -scores))[:top]
        self.scores, self.ids, self.known = scores[first], ids[first], known[first]


class Block:
    """Posting lists of a block of documents, one behind the other, with their range maxima.

    ``keys`` are term times documents plus place, so that one search finds a place in many lists.
    Documents are in the order of their ids, so of equal scores the first place wins.
    """

    def __init__(
        self, ids: np.ndarray, known: np.ndarray, norms: np.ndarray,
        places: np.ndarray, numbers: np.ndarray, times: np.ndarray,
    ):
        order = np.lexsort((ids, ~known))
        self.ids, self.known, self.size = ids[order], known[order], len(ids)
        moved = np.empty(len(ids), np.int64)
        moved[order] = np.arange(len(ids))
        keys = numbers * self.size + moved[places]
        sort = np.argsort(keys)
        self.keys, times, norms = keys[sort], times[sort], norms[places][sort]
        self.impacts = (IMPACT * times) // (1000 * times + 8 * norms)
        # Where the greatest impact of each run of 1, 2, 4, ... postings lies. Runs that reach over
        # the end of a list are never asked for.
        longest = int(np.bincount(numbers).max()) if len(numbers) else 1
        level = np.arange(len(keys), dtype=np.int32)
        self.maxima = [level]
        for half in (1 << j for j in range(longest.bit_length() - 1)):
            level = self.maxima[-1].copy()
            ahead = level[half:]
            behind = level[: len(ahead)]
            level[: len(ahead)] = np.where(
                self.impacts[ahead] > self.impacts[behind], ahead, behind
            )
            self.maxima.append(level)
        self.table = np.stack(self.maxima)

    def _bounds(self, query: Query, low: np.ndarray, high: np.ndarray):
        """For each interval the sum of its terms' greatest weighted impacts, and the place of the
        document with the greatest of them."""
        base = (query.terms * self.size)[:, None]
        start = np.searchsorted(self.keys, base + low)
        size = np.searchsorted(self.keys, base + high) - start
        some = size > 0
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        start = np.where(some, start, 0)
        left = self.table[level, start]
        right = self.table[level, np.where(some, start + size - (1 << level), 0)]
        best = np.where(self.impacts[left] >= self.impacts[right], left, right)
        values = np.where(some, query.weights[:, None] * self.impacts[best], 0)
        widest = best[values.argmax(axis=0), np.arange(len(low))]
        return values.sum(axis=0), self.keys[widest] % self.size

    def _scores(self, query: Query, places: np.ndarray) -> np.ndarray:
        wanted = (query.terms * self.size)[:, None] + places
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        values = np.where(self.keys[at] == wanted, query.weights[:, None] * self.impacts[at], 0)
        return values.sum(axis=0)

    def _useful(self, query: Query, low: np.ndarray, bound: np.ndarray, top: int) -> np.ndarray:
        """Whether an interval can hold a document that belongs to the best ones."""
        if len(query.scores) < top:
            return bound > 0
        worst = query.scores[-1]
        before = self.known[low] & ~query.known[-1]
        before |= (self.known[low] == query.known[-1]) & (self.ids[low] < query.ids[-1])
        return (bound > worst) | ((bound == worst) & before)

    def search(self, query: Query, top: int) -> None:
        """Add this block's best documents to the query's."""
        if not len(self.keys) or not len(query.terms):
            return
        step = max(1, AREA // len(query.terms))
        for start in range(0, self.size, step):
            self._best_first(query, start, min(start + step, self.size), top)

    def _best_first(self, query: Query, start: int, stop: int, top: int) -> None:
        """Split the most promising intervals at their documents of greatest impact, score those, and
        go on with what remains left and right of them, until no bound reaches the worst result."""
        width = max(1, min(AT_ONCE, AREA // (16 * len(query.terms))))
        low, high = np.array([start]), np.array([stop])
        bound, split = self._bounds(query, low, high)
        while True:
            keep = self._useful(query, low, bound, top)
            low, high, bound, split = low[keep], high[keep], bound[keep], split[keep]
            if not len(low):
                return
            now = np.ones(len(low), bool)
            if len(low) > width:
                now[np.argpartition(-bound, width)[width:]] = False
            places = split[now]
            query.add(self._scores(query, places), self.ids[places], self.known[places], top)
            lows = np.concatenate([low[now], places + 1])
            highs = np.concatenate([places, high[now]])
            filled = lows < highs
            lows, highs = lows[filled], highs[filled]
            bounds, splits = self._bounds(query, lows, highs)
            low, high, bound, split = (
                np.concatenate([old[~now], new])
                for old, new in ((low, lows), (high, highs), (bound, bounds), (split, splits))
            )


def _block_of(
    batches: list[pa.RecordBatch], vocabulary: dict[bytes, int], documents: int, length: int
) -> Block:
    table = pa.Table.from_batches(batches).combine_chunks()
    ids, lists = table.column("id").combine_chunks(), table.column("terms").combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
    sizes = table.column("n").to_numpy()
    coded = lists.flatten().dictionary_encode()
    names = [vocabulary.get(t, -1) for t in coded.dictionary.to_pylist()]
    term = np.array(names, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
    places = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
    times = table.column("times").combine_chunks().flatten().to_numpy()
    used = term >= 0
    norms = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * sizes * documents) // max(length, 1)
    return Block(numbers, known, norms, places[used], term[used], times[used])


def _searched(
    vocabulary: dict[bytes, int], queries: list[tuple[int, list[int], list[int]]],
    documents: int, length: int, top: int, batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for each query. A block's result bounds the next one's search."""
    none = np.zeros(0, np.int64)
    asked = [
        Query(number, np.array(t, np.int64), np.array(w, np.int64), none, none, none.astype(bool))
        for number, t, w in queries
    ]

    def search(held: list[pa.RecordBatch]) -> None:
        block = _block_of(held, vocabulary, documents, length)
        for query in asked:
            block.search(query, top)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("terms").flatten())
        if size >= BLOCK:
            search(held)
            held, size = [], 0
    if held and sum(b.num_rows for b in held):
        search(held)
    for query in asked:
        if len(query.scores):
            yield pa.record_batch({
                "query": np.full(len(query.scores), query.number),
                "id": pa.array(query.ids, pa.int64(), mask=~query.known),
                "score": query.scores,
            })


# --- search over all documents -------------------------------------------------------------------


def _passes(weighed: DataFrame) -> Iterator[tuple[dict, list]]:
    """The queries in parts of about ``QUERY_TERMS`` terms: vocabulary, and terms and weights of
    each query by its number."""
    total = weighed.count()
    parts = -(-2 * total // QUERY_TERMS) if total > QUERY_TERMS else 1
    for part in range(parts):
        rows = weighed.filter(F.pmod(F.xxhash64("query"), F.lit(parts)) == part).collect()
        vocabulary: dict[bytes, int] = {}
        queries: dict[int, tuple[list, list]] = {}
        for row in rows:
            number = vocabulary.setdefault(bytes(row["term"]), len(vocabulary))
            found = queries.setdefault(row["query"], ([], []))
            found[0].append(number)
            found[1].append(row["weight"])
        if queries:
            yield vocabulary, [(q, *found) for q, found in sorted(queries.items())]


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the best rows of ``docs (doc_id, text, ...)`` for each row
    of ``items (item_id, text, ...)``, all rows with a score above 0 if there are fewer than ``top``.

    One pass over the texts makes postings of the terms that some item has; they stay where they
    are. Each task builds range maxima over its blocks of documents and searches them for every
    item; only a task's best rows travel. Items go to the tasks in parts of bounded size.

    Equal scores go by doc_id, a NULL doc_id last; rows with one doc_id are ranked each. A NULL or
    wordless text has no terms: such an item has no results, such a document is never one. A repeated
    item_id is ranked each time, a NULL one too. Other columns are not looked at; no documents or
    items give no rows.
    """
    asked = landed(
        items.select("item_id", F.col("text").cast("string").alias("text"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    listed = landed(
        postings(asked.select("id", "text"))
        .select(F.col("id").alias("query"), F.explode(F.arrays_zip("terms", "times")).alias("at"))
        .select("query", F.col("at.terms").alias("term"), F.col("at.times").alias("times"))
    )
    index = landed(
        postings(
            docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string")),
            _filter_of(listed),
        )
    )
    whole = index.agg(F.count_if(F.col("n") > 0).alias("N"), F.sum("n").alias("L")).first()
    documents, length = whole["N"], whole["L"] or 0
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")
    )
    share = F.lit(2.0 * documents + 2.0) / (2 * F.col("df") + 1).cast("double")
    weighed = landed(
        listed.join(held, "term")
        .select("query", "term", (F.col("times") * F.floor(1000 * F.ln(share))).alias("weight"))
        .filter("weight > 0")
    )
    schema = "query long, id long, score long"
    found = docs.sparkSession.createDataFrame([], schema)
    for vocabulary, queries in _passes(weighed):
        found = found.union(
            index.transform(
                in_arrow, partial(_searched, vocabulary, queries, documents, length, top), schema
            )
        )
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .join(asked.select(F.col("id").alias("query"), "item_id"), "query")
        .select("item_id", "rank", F.col("id").alias("doc_id"), "score")
    )
