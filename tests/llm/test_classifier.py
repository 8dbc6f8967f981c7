"""Quality classifier: word vectors, network, held-out quality and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselens.llm import classifier
from caselens.llm.common import table
from caselens.llm.queries import QUERIES
from samples import none, odd, prose


def plain_vectors(texts):
    places, signs = classifier.index_vectors()
    total = np.zeros((classifier.ROWS, classifier.DIMENSIONS))
    rows = classifier._Rows()
    for text in texts:
        found = rows.of(text or "")
        for i, word in enumerate(found):
            for k in range(max(0, i - classifier.REACH), min(len(found), i + classifier.REACH + 1)):
                if k != i:
                    np.add.at(total[word], places[found[k]], signs[found[k]])
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)


def test_vectors_are_those_of_all_texts(spark, monkeypatch):
    texts = [prose(i, 40, 50) for i in range(30)] + ["", "one", prose(99, 2000, 300)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    found = classifier.word_vectors(frame)
    assert np.allclose(found, plain_vectors(texts), atol=1e-6)
    monkeypatch.setattr(classifier, "AT_ONCE", 64)
    total = np.zeros(classifier.ROWS * classifier.DIMENSIONS)
    classifier.add_contexts(classifier._Rows().of(texts[-1]), total, *classifier.index_vectors())
    total = total.reshape(classifier.ROWS, -1)
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    assert np.allclose(total, plain_vectors(texts[-1:]))


def test_network_learns_and_is_calibrated():
    random = np.random.default_rng(0)
    inputs = random.normal(size=(4000, 10))
    truth = 1 / (1 + np.exp(-(2 * inputs[:, 0] * inputs[:, 1] + inputs[:, 2])))
    labels = (random.random(4000) < truth).astype(float)
    network = classifier.fit(inputs[:3000], labels[:3000])
    scores = network.scores(inputs[3000:])
    assert np.mean((scores >= 0.5) == (truth[3000:] >= 0.5)) > 0.8
    for low in (0.0, 0.25, 0.5, 0.75):
        some = (scores >= low) & (scores < low + 0.25)
        assert abs(scores[some].mean() - truth[3000:][some].mean()) < 0.08


@pytest.mark.parametrize("labels", [[], [1, 1, 1], [0, 0]])
def test_few_labels_give_a_flat_score(labels):
    inputs = np.ones((len(labels), classifier.WIDTH))
    scores = classifier.fit(inputs, np.array(labels, float)).scores(np.zeros((4, classifier.WIDTH)))
    assert np.allclose(scores, (sum(labels) + 0.5) / (len(labels) + 1))


def test_odd_rows(spark):
    docs = odd(spark)
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(12)] + [(1, None), (None, 1), (2, 7), (99999, 1)],
        "doc_id long, quality int",
    )
    rows = classifier.scored(docs, labels).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(
        str(r.doc_id) for r in docs.collect()
    )
    for r in rows:
        out = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert r.held_out == out and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    assert classifier.scored(none(spark), labels).collect() == []
    assert classifier.scored(docs, labels.limit(0)).filter("score = 0.5").count() == docs.count()
    kept = classifier.kept_rows(docs, labels.limit(0), 0.5)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert classifier.kept_rows(docs, labels.limit(0), 0.6).count() == 0


@pytest.mark.parametrize("sample", [1, 37, 3000, 9999])
def test_sample_is_that_of_a_full_sort(spark, sample):
    known = spark.range(3000).select(
        (F.col("id") % 2500).alias("doc_id"), (F.col("id") % 2).cast("int").alias("label")
    )
    wanted = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample).collect()
    assert sorted(classifier._smallest(known, sample).collect()) == sorted(wanted)


def test_held_out_labels_are_not_learned(spark, data):
    """Turning all held-out labels round changes no score."""
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    turned = labels.withColumn(
        "quality",
        F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(
            F.col("quality")
        ),
    )
    a, b = (
        {r.doc_id: r.score for r in classifier.scored(docs, one).collect()}
        for one in (labels, turned)
    )
    assert a == b


def test_query_tells_held_out_documents(spark, data):
    rows = {r.doc_id: r for r in QUERIES["op6_quality_classifier"](spark, data).collect()}
    known = table(spark, data, "labels").collect()
    assert len(rows) == table(spark, data, "documents").count()
    tested = [(rows[r.doc_id], r.quality) for r in known if rows[r.doc_id].held_out]
    right = sum(one.predicted == quality for one, quality in tested)
    assert len(tested) > 50 and right >= 0.93 * len(tested)
