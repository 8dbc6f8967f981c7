"""Quality classifier: random-indexing word vectors, pooled per document, and a small network."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens.llm.common import in_arrow, text_or_empty

# Words are hashed to this many rows of vectors with this many dimensions. A row's index vector has
# a few signed entries; a word's context are the words up to this far on either side.
ROWS, DIMENSIONS, ENTRIES, REACH = 1 << 13, 48, 2, 2
WIDTH = 2 * DIMENSIONS + 3
# Rows of the matrix that travel together when the tasks' sums are added up.
BLOCK = 256
# Labelled documents that the network is fitted on at most: those with the smallest hashes.
SAMPLE = 20_000
# First bits of the hashes, by which the draw of that sample is narrowed.
_DRAW_BITS = 16
HIDDEN, EPOCHS, STEP, RATE, SEED = 32, 40, 256, 0.005, 7
THRESHOLD = 0.7
# Words looked at together, and distinct words a worker remembers before it starts anew.
AT_ONCE, REMEMBERED = 1 << 18, 1 << 19
_TOKEN = re.compile(r"\w+|[^\w\s]+")


# --- words ---------------------------------------------------------------------------------------


class _Rows(dict):
    """Row of each word, hashed when first met."""

    def __missing__(self, word: str) -> int:
        row = self[word] = crc32(word.encode()) % ROWS
        return row

    def of(self, text: str) -> np.ndarray:
        """Rows of the words of a text: runs of letters and digits, and runs of other signs."""
        if len(self) > REMEMBERED:
            self.clear()
        found = _TOKEN.findall(text.lower())
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Where the entries of each row's index vector are, and their signs."""
    random = np.random.default_rng(SEED)
    places = random.integers(0, DIMENSIONS, (ROWS, ENTRIES))
    return places, random.choice([-1.0, 1.0], (ROWS, ENTRIES))


def add_contexts(
    words: np.ndarray, total: np.ndarray, places: np.ndarray, signs: np.ndarray
) -> None:
    """Add the index vectors of each word's neighbours to its row. -1 separates documents."""
    for step in range(1, REACH + 1):
        for start in range(0, len(words) - step, AT_ONCE):
            stop = min(start + AT_ONCE, len(words) - step)
            left, right = words[start:stop], words[start + step : stop + step]
            same = (left >= 0) & (right >= 0)
            for word, near in ((left[same], right[same]), (right[same], left[same])):
                flat = (word[:, None] * DIMENSIONS + places[near]).ravel()
                total += np.bincount(flat, signs[near].ravel(), ROWS * DIMENSIONS)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    total, rows = np.zeros(ROWS * DIMENSIONS), _Rows()
    held: list[np.ndarray] = []
    size, gap = 0, np.full(REACH, -1)
    for batch in batches:
        for text in batch.column("text"):
            words = rows.of(text.as_py())
            held += [words, gap]
            size += len(words)
            if size > AT_ONCE:
                add_contexts(np.concatenate(held), total, places, signs)
                held, size = [], 0
    if held:
        add_contexts(np.concatenate(held), total, places, signs)
    parts = total.astype("<f8").reshape(-1, BLOCK * DIMENSIONS)
    used = [i for i, part in enumerate(parts) if part.any()]
    if used:
        yield pa.record_batch({"block": used, "sums": [parts[i].tobytes() for i in used]})


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal blocks, one after the other: a task holds each of its blocks once."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("sums")):
            values = np.frombuffer(part.as_py(), "<f8")
            sums[block] = sums[block] + values if block in sums else values
    if sums:
        yield pa.record_batch({"block": list(sums), "sums": [s.tobytes() for s in sums.values()]})


def word_vectors(texts: DataFrame) -> np.ndarray:
    """Context vectors of all word rows over all texts, of length 1 each; unseen rows are 0.

    Each task adds up its part; the parts, whose size does not depend on the corpus, are added up
    by block. The result is one matrix of fixed size. The sums are whole numbers, so they do not
    depend on the order of adding.
    """
    kind = "block long, sums binary"
    parts = texts.transform(in_arrow, _contexts, kind)
    added = parts.repartition(ROWS // BLOCK, "block").transform(in_arrow, _added, kind)
    blocks = added.collect()
    matrix = np.zeros((ROWS // BLOCK, BLOCK * DIMENSIONS))
    for row in blocks:
        matrix[row["block"]] = np.frombuffer(row["sums"], "<f8")
    matrix = matrix.reshape(ROWS, DIMENSIONS)
    return (matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1)).astype("f4")


def pooled(words: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One document: mean and spread of its words' vectors, how many words there are, and the shares
    of different ones and of ones that repeat the word before."""
    if not len(words):
        return np.zeros(WIDTH, "f4")
    counts = np.bincount(words, minlength=ROWS)
    used = np.flatnonzero(counts)
    weights = (counts[used] / len(words)).astype("f4")
    own = vectors[used]
    mean = weights @ own
    spread = np.sqrt(np.maximum(weights @ (own * own) - mean * mean, 0))
    again = np.count_nonzero(words[1:] == words[:-1]) / len(words)
    return np.r_[mean, spread, np.log1p(len(words)), len(used) / len(words), again].astype("f4")


# --- the network ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Network:
    """Two layers on standardised inputs; the logit is divided by the temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, inputs: np.ndarray) -> np.ndarray:
        hidden = np.tanh((inputs - self.centre) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(inputs) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def fit(inputs: np.ndarray, labels: np.ndarray) -> Network:
    """Adam on a fixed shuffle; every fifth row is left out to set the temperature.

    With one class only, or no rows, the network gives the share of label 1 (a half without rows).
    """
    width = inputs.shape[1]
    random = np.random.default_rng(SEED)
    centre = inputs.mean(axis=0) if len(inputs) else np.zeros(width)
    scale = np.maximum(inputs.std(axis=0), 1e-3) if len(inputs) else np.ones(width)
    if len(np.unique(labels)) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        flat = np.zeros((width, 1)), np.zeros(1), np.zeros(1)
        return Network(centre, scale, *flat, float(np.log(share / (1 - share))), 1.0)
    standard = (inputs - centre) / scale
    order = random.permutation(len(labels))
    checked, taught = order[::5], np.delete(order, np.s_[::5])
    weights = [
        random.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
    ]
    means = [[np.zeros_like(w) for w in weights] for _ in range(2)]
    step = 0
    for epoch in range(EPOCHS):
        mixed, rate = random.permutation(taught), RATE * (1 - epoch / EPOCHS)
        for start in range(0, len(mixed), STEP):
            some = mixed[start : start + STEP]
            x, y = standard[some], labels[some]
            hidden = np.tanh(x @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-(hidden @ weights[2] + weights[3]))) - y) / len(some)
            back = np.outer(error, weights[2]) * (1 - hidden * hidden)
            slopes = [x.T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for i, slope in enumerate(slopes):
                if weights[i].ndim == 2 or i == 2:
                    slope = slope + 1e-3 * weights[i]
                means[0][i] = 0.9 * means[0][i] + 0.1 * slope
                means[1][i] = 0.999 * means[1][i] + 0.001 * slope * slope
                weights[i] = weights[i] - rate * (means[0][i] / (1 - 0.9**step)) / (
                    np.sqrt(means[1][i] / (1 - 0.999**step)) + 1e-8
                )
    raw = Network(centre, scale, *weights[:3], float(weights[3][0]), 1.0)
    logits = raw.logits(inputs[checked])
    tried = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
    best = min(tried, key=lambda t: _loss(logits / t, labels[checked]))
    return Network(centre, scale, *weights[:3], float(weights[3][0]), float(best))


# --- over tables ---------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _features(vectors, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _Rows()
    for batch in batches:
        found = [pooled(rows.of(t.as_py()), vectors.value).tobytes() for t in batch.column("text")]
        yield pa.record_batch(
            {"doc_id": batch.column("doc_id"), "label": batch.column("label"),
             "features": pa.array(found, pa.binary())}
        )


def _smallest(known: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` rows, those with the smallest hashes of their doc_id.

    The first bits of the hashes are counted, which tells how far the draw reaches, so the sort gets
    little more than ``sample`` rows, not that many from every task.
    """
    drawn = known.withColumn("draw", F.xxhash64("doc_id"))
    prefix = F.shiftright("draw", 64 - _DRAW_BITS)
    sizes = drawn.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    reach = sizes.select("prefix", seen.alias("seen")).filter(F.col("seen") < sample)
    needed = drawn.filter(prefix <= reach.agg(F.max("prefix")).scalar())
    return needed.orderBy("draw", "doc_id", "label").limit(sample).drop("draw")


def learned(docs: DataFrame, labels: DataFrame, vectors, sample: int = SAMPLE) -> Network:
    """A network fitted on at most ``sample`` labelled rows that are not held out."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label")
    )
    # Bounded by ``sample`` pairs of numbers, so this side is broadcast.
    chosen = _smallest(known, sample)
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    rows = texts.transform(
        in_arrow, partial(_features, vectors), "doc_id long, label int, features binary"
    ).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("features", "ascending")])
    inputs = np.frombuffer(b"".join(rows["features"].to_pylist()), "f4").reshape(-1, WIDTH)
    return fit(inputs.astype("f8"), rows["label"].to_numpy().astype("f8"))


def _scored(vectors, network, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _Rows()
    for batch in batches:
        inputs = [pooled(rows.of(t.as_py()), vectors.value) for t in batch.column("text")]
        if inputs:
            scores = network.value.scores(np.array(inputs, "f8"))
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                 "score": scores}
            )


def _model(docs: DataFrame, labels: DataFrame) -> tuple[Broadcast, Broadcast]:
    """Word vectors and network, of fixed size, as broadcast values."""
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs.select(text_or_empty().alias("text"))))
    return vectors, context.broadcast(learned(docs, labels, vectors))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs (doc_id, text, ...)``.

    ``labels (doc_id, quality)`` say which documents are good (1). Vectors come from all texts; only
    text is an input of a score. A NULL text counts as empty and is scored; a NULL doc_id is not
    held out and finds no label; other labels than 0 and 1 and unknown doc_ids are passed over.
    Repeated rows stay repeated; without any label all scores are a half; no rows give none.
    """
    rows = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), text_or_empty().alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.transform(
        in_arrow, partial(_scored, *_model(docs, labels)),
        f"doc_id {kind}, held_out boolean, score double",
    )
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _kept(vectors, network, threshold: float, batches: Iterator[pa.RecordBatch]):
    rows = _Rows()
    for batch in batches:
        texts = [t.as_py() or "" for t in batch.column("text")]
        if texts:
            inputs = np.array([pooled(rows.of(t), vectors.value) for t in texts], "f8")
            yield batch.filter(pa.array(network.value.scores(inputs) >= threshold))


def kept_rows(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    return docs.transform(in_arrow, partial(_kept, *_model(docs, labels), threshold), docs.schema)
